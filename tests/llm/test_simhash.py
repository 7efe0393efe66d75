import random

import numpy as np
import pytest
import xxhash
from hearth.llm.components import connected_components
from hearth.llm.simhash import fingerprint, links, near_duplicates
from pyspark.sql import functions as F


def brute_fp(text):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        w = w.replace(c, " ")
    w = [x for x in w.split(" ") if x]
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + 4]).encode(), 42) for i in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, bits):
    seen, left = {}, set(fps)
    while left:
        todo = [left.pop()]
        group = set(todo)
        while todo:
            x = todo.pop()
            near = {y for y in left if (x ^ y).bit_count() <= bits}
            left -= near
            group |= near
            todo += near
        for x in group:
            seen[x] = min(group)
    return seen


def test_equals_brute_force(docs, doc_rows):
    fps = [brute_fp(t) for _, t, *_ in doc_rows if len(t or "") < 100_000]
    assert fingerprint(b"", 4) == 0
    group = brute_components(fps, 4)
    least = {}
    for (d, t, *_), fp in zip([r for r in doc_rows if len(r[1] or "") < 100_000], fps):
        if d is not None:
            least[group[fp]] = min(d, least.get(group[fp], d))
    want = sorted(((d, fp, least.get(group[fp])) for (d, t, *_), fp in zip([r for r in doc_rows if len(r[1] or "") < 100_000], fps)), key=str)
    got = near_duplicates(docs.filter("text is null or length(text) < 100000")).collect()
    assert sorted(((r["id"], r["fp"] % 2**64, r["component_id"]) for r in got), key=str) == want


def test_long_text_in_blocks():
    text = " ".join(str(i % 997) for i in range(70_000))
    assert fingerprint(text.encode(), 4) == brute_fp(text)


@pytest.mark.parametrize("bits,limit", [(4, 512), (4, 3), (3, 2), (5, 3), (0, 512)])
def test_links_span_the_full_graph(spark, bits, limit):
    rng = random.Random(bits * 10 + limit)
    fps = {0}
    for _ in range(12):
        base = rng.getrandbits(64)
        for _ in range(25):
            x = base
            for b in rng.sample(range(64), rng.randint(0, 5)):
                x ^= 1 << b
            fps.add(x)
    signed = [(int(np.uint64(x).view(np.int64)),) for x in fps]
    edges = links(spark.createDataFrame(signed, "fp long"), bits, 3, limit)
    found = [(r["a"] % 2**64, r["b"] % 2**64) for r in edges.collect()]
    assert all((a ^ b).bit_count() <= bits for a, b in found)
    roots = {r["node"] % 2**64: r["root"] for r in connected_components(edges).collect()}
    want, groups = brute_components(fps, bits), {}
    for x in fps:
        groups.setdefault(want[x], set()).add(roots.get(x, ("alone", x)))
    assert all(len(g) == 1 for g in groups.values()) and len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_components_of_chain_star_and_nothing(spark):
    chain = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 50)] + [(5000, 5000)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(301)} | {1000 + i: 1000 for i in range(50)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_empty_table(no_docs):
    assert near_duplicates(no_docs).collect() == []


def test_no_table_that_grows_with_the_rows_is_broadcast(spark, tmp_path):
    # 45 probes and up to 2,081 midpoints a fingerprint: Spark's estimate of an exploded table is that of its source
    fps = spark.range(3000).select(F.xxhash64("id").alias("fp"))
    fps.write.parquet(f"{tmp_path}/fps")
    plan = links(spark.read.parquet(f"{tmp_path}/fps"), 4, 3, 64)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") >= 2
    # only the keys of crowded entries, one for each over bucket_limit fingerprints, may be
    assert all(kind not in line or "LeftAnti" in line or "LeftSemi" in line for line in plan.splitlines() for kind in ("BroadcastHashJoin", "BroadcastNestedLoopJoin"))
