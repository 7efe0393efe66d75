import gc
import random
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pytest
from hearth.llm import packing
from hearth.llm.packing import first_fit_decreasing, pack, token_bytes
from tokenizers import Tokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")


def plain_ffd(lengths, capacity):
    room, out = [], []
    for n in lengths:
        at = next((i for i, r in enumerate(room) if r >= n), len(room))
        if at == len(room):
            room.append(capacity)
        out.append((at, capacity - room[at]))
        room[at] -= n
    return out


def test_tournament_tree_is_first_fit():
    rng = random.Random(1)
    for n in (0, 1, 2, 7, 300):
        lengths = sorted((rng.randint(1, 100) for _ in range(n)), reverse=True)
        bins, offsets = first_fit_decreasing(np.array(lengths, np.int64), 100)
        assert list(zip(bins.tolist(), offsets.tolist())) == plain_ffd(lengths, 100)


def ids_of(texts):
    tok = Tokenizer.from_file(PATH)
    return [np.array(tok.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]


def made_up(rng, n):
    return ["".join(rng.choices("abcdefghiklmnoprstuvwéü", k=rng.randint(4, 12))) for _ in range(n)]


def test_a_worker_keeps_little_of_many_words():
    packing._LOADED.clear()
    rng = random.Random(2)
    token_bytes(["one"], PATH)
    tracemalloc.start()
    for _ in range(30):
        token_bytes([" ".join(made_up(rng, 1000)) for _ in range(10)], PATH)
    gc.collect()
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    packing._LOADED.clear()
    assert held < 35e6


def test_words_that_leave_the_cache_come_back(monkeypatch):
    packing._LOADED.clear()
    monkeypatch.setattr(packing, "_CACHE_WORDS", 40)
    rng = random.Random(3)
    words = [*made_up(rng, 300), "don't", "'s", "'", "--", "é", "7", "x" * 500, "it's", "#$%", "€", "a1b2"]
    for _ in range(40):
        texts = [" ".join(rng.choices(words, k=rng.randint(0, 30))) for _ in range(rng.randint(0, 5))] + ["x" * 500 + " Ж x"]
        assert token_bytes(texts, PATH) == ids_of(texts)
    packing._LOADED.clear()


def test_pieces_that_cannot_be_cut_go_one_by_one():
    packing._LOADED.clear()
    tok, ends, _ = packing._tokenizer(PATH)
    words = made_up(random.Random(4), 1500)
    assert [*packing._encode_words(tok, ends, words)] == [*packing._encode_words(tok, np.zeros_like(ends), words)] == ids_of(words)


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_pieces_are_the_tokenizers_ids(docs, doc_rows, name):
    path = public_tokenizers.path(name)
    tok = Tokenizer.from_file(path)
    ids = [[*tok.encode(t or "", add_special_tokens=False).ids, 1] for _, t, *_ in doc_rows]
    want = sorted(((d, s, len(x[s:s + 2048]), zlib.crc32(np.array(x[s:s + 2048], "<u4").tobytes()), len(x))
                   for (d, *_), x in zip(doc_rows, ids) for s in range(0, len(x), 2048)), key=str)
    rows = pack(docs, path, group_size=300, ids=True).collect()
    assert sorted(((r["id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in rows), key=str) == want
    assert all(zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] for r in rows)
    held = {}
    for r in rows:
        held.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in held.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 2048
    assert sum(map(len, ids)) / (2048 * len(held)) > 0.93


def test_empty_table(no_docs):
    assert pack(no_docs, PATH).collect() == []
