"""Packing token pieces into sequences: first-fit decreasing in randomised groups of documents.

A document's ids (and its end id) are cut at multiples of the sequence length; whole pieces are
sequences of their own, so each document brings at most one shorter piece to the packing. The
shorter pieces are dealt by a seeded hash into groups of about ``group_size`` documents, whatever
the number of documents, and every group packs its own: longest piece first, each into the first
open sequence with room, found in a tournament tree whose inner nodes hold the largest room below.
"""

from __future__ import annotations

import os
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearth.llm.common import materialize, row_key

# Texts of these characters only are split here as the tokenizer would: ASCII without the rarer
# control characters, Latin letters that no normal form changes, and common punctuation.
_PLAIN = re.compile("[\t\n\r -~¡-§©«-®°-±¶-·»¿-įıĴ-ľŁ-ňŊ-ž‐-‧€]*")
_LETTERS = "a-zÀ-ÖØ-öø-ž"
# the tokenizer's own split pattern (fixed values), with its classes written out for these characters
_SPLIT = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^ \t\n\r{_LETTERS}0-9]+")
# A worker outlives its task and holds what it has loaded while other stages run beside it, so
# pieces are kept in two generations of about so many, the longest ones not at all.
_CACHE_WORDS = 65_536
_CACHE_CHARS = 64
_JOINED = 512
_LOADED: dict[str, tuple] = {}


def _tokenizer(path: str):
    """The tokenizer of a worker, its ids that end a word, and two generations of pieces seen."""
    if path not in _LOADED:
        # a task has one core; a thread for each core of the machine would hold memory of its own
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        tok = Tokenizer.from_file(path)
        vocab = tok.get_vocab()
        ends = np.zeros(max(vocab.values()) + 1, bool)
        ends[[i for w, i in vocab.items() if w.endswith("</w>")]] = True
        _LOADED[path] = (tok, ends, [{}, {}])
    return _LOADED[path]


def _encode_words(tok, ends: np.ndarray, words: list[str]):
    """Ids of each piece: many are encoded as one text and cut after the ids that end a word."""
    for at in range(0, len(words), _JOINED):
        part = words[at:at + _JOINED]
        ids = np.array(tok.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, "<u4")
        stops = np.flatnonzero(ends[ids]) + 1
        if len(stops) == len(part) and stops[-1] == len(ids):
            raw, start = ids.tobytes(), 0
            for stop in (4 * stops).tolist():
                yield raw[start:stop]
                start = stop
        else:
            for e in tok.encode_batch_fast(part, add_special_tokens=False):
                yield np.array(e.ids, "<u4").tobytes()


def _word_level(path: str) -> bool:
    return path.endswith("word_bpe_49k.json")


def token_bytes(texts: list[str], path: str) -> list[bytes]:
    """Ids of each text as little-endian unsigned 32-bit integers, no special tokens added.

    The ids are those of the tokenizer file. For the word-level file, where pieces between splits
    are encoded one by one, pieces seen before come from a bounded cache, from which those go
    first that were not met for the longest; a text with characters outside the plain set, or with
    a special token's text, goes to the tokenizer whole.
    """
    tok, ends, kept = _tokenizer(path)
    if not _word_level(path):
        return [np.array(e.ids, "<u4").tobytes() for e in tok.encode_batch_fast(texts, add_special_tokens=False)]
    out: list = [None] * len(texts)
    odd, split, new = [], [], set()
    for i, t in enumerate(texts):
        if _PLAIN.fullmatch(t) and "<|" not in t:
            words = _SPLIT.findall(t.lower())
            split.append((i, words))
            new.update(words)
        else:
            odd.append(i)
    if len(kept[0]) > _CACHE_WORDS:
        kept[:] = {}, kept[0]
    seen, before = kept
    new.difference_update(seen)
    for w in new & before.keys():
        seen[w] = before.pop(w)
    new = [w for w in new if w not in seen]
    seen.update(zip(new, _encode_words(tok, ends, new)))
    for i, words in split:
        out[i] = b"".join(map(seen.__getitem__, words))
    for w in new:
        if len(w) > _CACHE_CHARS:
            del seen[w]
    for at in range(0, len(odd), 16):
        part = odd[at:at + 16]
        for i, e in zip(part, tok.encode_batch_fast([texts[i] for i in part], add_special_tokens=False)):
            out[i] = np.array(e.ids, "<u4").tobytes()
    return out


def pieces(docs: DataFrame, path: str, length: int = 2048, end_id: int = 1, ids: bool = False,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, start, length, ids_crc32, doc_tokens`` (and ``ids``) of every piece of every row."""
    end = np.array([end_id], "<u4").tobytes()

    def work(batches):
        for batch in batches:
            own, texts = batch.column(0), batch.column(1)
            for at in range(0, len(own), 256):
                part = texts.slice(at, 256).fill_null("").to_pylist()
                row, start, size, crc, total, raw = [], [], [], [], [], []
                for i, b in enumerate(token_bytes(part, path)):
                    b += end
                    for s in range(0, len(b), 4 * length):
                        piece = b[s:s + 4 * length]
                        row.append(at + i)
                        start.append(s // 4)
                        size.append(len(piece) // 4)
                        crc.append(zlib.crc32(piece))
                        total.append(len(b) // 4)
                        if ids:
                            raw.append(np.frombuffer(piece, "<i4"))
                cols = {"id": own.take(pa.array(row, pa.int64())), "start": pa.array(start, pa.int64()), "length": pa.array(size, pa.int64()),
                        "ids_crc32": pa.array(crc, pa.int64()), "doc_tokens": pa.array(total, pa.int64())}
                if ids:
                    cols["ids"] = pa.array(raw, pa.list_(pa.int32()))
                yield pa.record_batch(cols)
        pa.default_memory_pool().release_unused()  # the worker stays idle beside later stages

    fields = [T.StructField("id", docs.schema[id_col].dataType)] + [T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32", "doc_tokens")]
    fields += [T.StructField("ids", T.ArrayType(T.IntegerType()))] if ids else []
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).mapInArrow(work, T.StructType(fields))


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """``(bin, offset)`` of each length, given in decreasing order.

    ``room[1]`` is the root of a tournament tree over the bins; a node holds the largest room of
    the bins below it, so the leftmost bin with enough room is found in one descent.
    """
    leaves = 1
    while leaves < len(lengths):
        leaves *= 2
    room = [capacity] * (2 * leaves)
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for i, need in enumerate(lengths.tolist()):
        node = 1
        while node < leaves:
            node *= 2
            if room[node] < need:
                node += 1
        bins[i], offsets[i] = node - leaves, capacity - room[node]
        room[node] -= need
        while node > 1:
            node //= 2
            room[node] = max(room[2 * node], room[2 * node + 1])
    return bins, offsets


def pack(docs: DataFrame, path: str, length: int = 2048, end_id: int = 1, group_size: int = 4096, seed: int = 42,
         ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The pieces of all rows with ``sequence_id`` and ``offset`` (gapless from 0 in a sequence).

    ``path`` is a tokenizer file that every executor can read. Every row, repeated ones too, brings
    its ids and one ``end_id``; a null or empty text brings the end id alone. Ids of any type may
    repeat or be null. With ``ids`` the token ids come along. Other columns are not used.
    """
    cut = materialize(row_key(pieces(docs, path, length, end_id, ids, id_col, text_col)), "pieces")
    short = cut.filter(F.col("length") < length).select("_row", "length")
    groups = max(1, -(-short.count() // group_size))
    short = short.withColumn("group", F.pmod(F.xxhash64(F.lit(seed), "_row"), F.lit(groups)))

    def fill(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["length", "_row"], ascending=[False, True])
        bins, offsets = first_fit_decreasing(part["length"].to_numpy(), length)
        return pd.DataFrame({"_row": part["_row"].to_numpy(), "sequence_id": (part["group"].to_numpy() << 32) + bins, "offset": offsets})

    placed = short.groupBy("group").applyInPandas(fill, "_row long, sequence_id long, offset long")
    whole = cut.filter(F.col("length") == length).select("_row", (F.lit(1 << 62) + F.col("_row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return cut.join(placed.unionByName(whole), "_row").drop("_row")
