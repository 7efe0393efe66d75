import re
from collections import Counter, defaultdict

import numpy as np

from hearth.llm.mixing import draw, mix, permuted, targets

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_targets_share_out_what_is_above():
    sizes, weights = [10, 1000, 0, 500, 90], [1, 2, 3, 1, 2]
    got = targets(sizes, weights, 3)
    assert abs(sum(got) - 1600) < 1e-9 and got[0] == 30 and got[2] == 0 and all(t <= 3 * s + 1e-9 for t, s in zip(got, sizes))
    free = [(t / w) for t, s, w in zip(got, sizes, weights) if t < 3 * s]
    assert max(free) - min(free) < 1e-9


def test_draws_place_every_slot():
    slots = [1000, 0, 1, 7, 300]
    got = draw(slots, 7, 1)
    assert got.sum(0).tolist() == slots and np.ptp(got.sum(1)) <= 1 and (got >= 0).all()
    assert (got == draw(slots, 7, 1)).all() and (got != draw(slots, 7, 2)).any()
    assert draw([0, 0], 3, 1).sum() == 0


def test_permutations():
    for n in (1, 2, 3, 4, 5, 17, 1000, 4096):
        one = permuted(np.arange(n), n, 5)
        assert sorted(one.tolist()) == list(range(n))
    assert (permuted(np.arange(1000), 1000, 5) != permuted(np.arange(1000), 1000, 6)).any()


def test_mix(spark, docs, doc_rows):
    found = mix(docs, shards=5, block=32, texts=True)
    rows = found.taken().collect()
    sizes = Counter()
    for _, text, _, source in doc_rows:
        sizes[source] += len(WORD.findall(text or ""))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    goal = dict(zip(order, targets([sizes[s] for s in order], [1.0 + i % 3 for i in range(len(order))], 3)))
    assert sorted(((r["id"], r["size"], r["source"], r["source_size"], r["target"]) for r in rows), key=str) == sorted(
        ((d, len(WORD.findall(t or "")), s, sizes[s], goal[s]) for d, t, _, s in doc_rows), key=str)
    taken = Counter()
    for r in rows:
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - goal[s]) <= 64 for s in order)
    # pieces fill their slots, and words come in rounds
    pieces = found.texts().collect()
    slots = defaultdict(int)
    uses = Counter()
    texts = {r["row"]: WORD.findall(r["text"] or "") for r in found.rows.collect()}
    size = {r["row"]: (r["source"], r["size"]) for r in found.rows.collect()}
    for p in pieces:
        slots[p["shard"], p["slot"]] += p["words"]
        assert p["text"] == " ".join(texts[p["row"]][p["begin"]:p["begin"] + p["words"]])
        for w in range(p["begin"], p["begin"] + p["words"]):
            uses[p["row"], w] += 1
    per = Counter(s for s, _ in slots)
    assert max(per.values()) - min(per.values()) <= 1 and all(sorted(k for s, k in slots if s == x) == list(range(per[x])) for x in per)
    assert all(v <= 32 for v in slots.values())
    times = defaultdict(set)
    for row, (source, n) in size.items():
        times[source].update(uses[row, w] for w in range(n))
    assert all(max(t) - min(t) <= 1 for t in times.values() if t)


def test_same_mix_again(docs):
    def told(frame):
        return sorted(((r["id"], r["size"], r["taken"]) for r in mix(frame, shards=3, block=32).taken().collect()), key=str)
    first = told(docs)
    assert first == told(docs.repartition(9)) and first == told(docs)


def test_empty_and_wordless(spark, no_docs):
    assert mix(no_docs).taken().collect() == []
    blank = spark.createDataFrame([(1, None, "s"), (2, " ", None), (3, "", "t")], "doc_id long, text string, source string")
    rows = mix(blank, shards=2).taken().collect()
    assert len(rows) == 3 and all((r["size"], r["source_size"], r["target"], r["taken"]) == (0, 0, 0.0, 0) for r in rows)
