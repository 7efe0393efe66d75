import zlib
from collections import Counter

from hearth.llm.sharding import shard


def test_shards_match_the_mixture(docs, doc_rows):
    rows = shard(docs, 24).collect()
    assert len(rows) == len(doc_rows)
    sizes = Counter(r["shard"] for r in rows)
    assert set(sizes) == set(range(24)) and max(sizes.values()) - min(sizes.values()) <= 1
    for s in range(24):
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sizes[s]))
    assert sorted(r["position"] for r in rows) == list(range(len(rows)))
    # the order is that of the fractions, and ranks in a source follow the seeded shuffle without gaps
    by = sorted(rows, key=lambda r: r["position"])
    assert all(a["fraction"] <= b["fraction"] for a, b in zip(by, by[1:]))
    for source, n in Counter(r["source"] for r in rows).items():
        assert sorted(r["rank"] for r in rows if r["source"] == source) == list(range(1, n + 1))
        held = Counter(r["shard"] for r in rows if r["source"] == source)
        assert all(abs(held[s] - n / 24) <= 2 for s in range(24))
    got = sorted(((r["id"], r["size"], r["text_crc32"]) for r in rows), key=str)
    assert got == sorted(((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t, *_ in doc_rows), key=str)


def test_hot_source_and_seed(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "cast(id % 7 as string) as text", "if(id % 3 = 0, 'hot', concat('s', id % 50)) as source")
    a = {r["id"]: r["position"] for r in shard(docs, 5, seed=1).collect()}
    assert a == {r["id"]: r["position"] for r in shard(docs.repartition(13), 5, seed=1).collect()}
    assert a != {r["id"]: r["position"] for r in shard(docs, 5, seed=2).collect()}


def test_few_rows_and_none(docs, no_docs):
    assert sorted(r["slot"] for r in shard(docs.limit(3), 24).collect()) == [0, 0, 0]
    assert shard(no_docs, 24).collect() == []
