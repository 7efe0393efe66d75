import re
from collections import Counter, defaultdict

import corpus_pipeline as cp
from hearth.llm.decontaminate import decontaminate
from hearth.llm.pii import personal_data
from hearth.llm.quality import judge
from hearth.llm.simhash import near_duplicates
from helpers import SMALL
from pyspark.sql import functions as F

#: names that stages use inside
CLASH = {"_id": "mine", "_key": "mine", "_spans": "mine", "row": "mine", "doc": "mine", "key": "mine", "spans": "mine", "kept": "mine", "root": "mine"}


def clashing(docs):
    told = docs.select("doc_id", "text", "lang", "source", "n_chars")
    return told.withColumns({c: F.lit(v) for c, v in CLASH.items()})


def rows(frame):
    return Counter(map(tuple, frame.collect()))


def test_quality_drops_what_the_operator_rejects(spark, docs):
    mine = clashing(docs)
    kept = cp.quality(spark, mine, SMALL)
    assert kept.columns == mine.columns
    verdict = {(r["id"], r["key"], r["stratum"]): r["kept"] for r in judge(mine, spark.read.parquet(f"{SMALL}/labels.parquet")).collect()}
    told = mine.withColumn("h", F.xxhash64("text")).collect()
    want = Counter(tuple(r)[:-1] for r in told if verdict[r["doc_id"], r["h"], "-" if r["lang"] is None else "=" + r["lang"]])
    assert rows(kept) == want and 0 < sum(want.values()) < len(told)


def test_near_dedup_keeps_the_smallest_id(spark, docs):
    mine = clashing(docs)
    kept = cp.near_dedup(spark, mine, SMALL)
    assert kept.columns == mine.columns
    groups = defaultdict(list)
    for r in near_duplicates(mine).collect():
        groups[r["root"]].append((r["id"] is None, r["id"] if r["id"] is not None else 0))
    assert Counter((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect()) == Counter(min(g) for g in groups.values())
    assert rows(kept) - rows(mine) == Counter()


def test_near_dedup_tells_odd_ids_apart(spark):
    text = "one and the same text of some words"
    odd = spark.createDataFrame([(None, text, "a"), ("null", text, "b"), (None, text, "c"), ("other", "something else entirely in here", "d")], "doc_id string, text string, tag string")
    assert {r["tag"] for r in cp.near_dedup(spark, odd, SMALL).collect()} == {"b", "d"}
    same = spark.createDataFrame([(7, text)] * 5 + [(7, "other words stand in this one here")], "doc_id long, text string")
    assert Counter(r["text"][:3] for r in cp.near_dedup(spark, same, SMALL).collect()) == {"one": 1, "oth": 1}


def test_benchmark_drops_documents_with_windows(spark, docs):
    mine = clashing(docs)
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    hit = {(r["id"], r["key"]) for r in decontaminate(mine, items).filter("n_hit > 0").collect()}
    told = mine.withColumn("h", F.xxhash64("text")).collect()
    want = Counter(tuple(r)[:-1] for r in told if (r["doc_id"], r["h"]) not in hit)
    assert rows(cp.benchmark(spark, mine, SMALL)) == want and hit


def test_personal_replaces_every_span(spark, docs):
    mine = clashing(docs)
    spans = {(r["id"], r["key"]): r["spans"] for r in personal_data(mine).collect()}
    before = mine.withColumn("h", F.xxhash64("text")).collect()
    want = Counter()
    for r in before:
        text, out, at = r["text"], "", 0
        own = spans[r["doc_id"], r["h"]]
        for s in own:
            if s["start"] >= at:
                out += text[at:s["start"]] + f"[{s['kind'].upper()}]"
                at = s["end"]
        new = r.asDict() | ({"text": out + text[at:], "n_chars": len(out + text[at:])} if own else {})
        want[tuple(new[c] for c in mine.columns)] += 1
    got = cp.personal(spark, mine, SMALL)
    assert got.columns == mine.columns and rows(got) == want
    assert any(re.search(r"\[EMAIL\]", r["text"] or "") for r in got.collect())


def test_empty_tables_stay_empty(spark, no_docs):
    for name, stage in cp.STAGES:
        out = stage(spark, clashing(no_docs), SMALL)
        assert out.collect() == [], name
        assert name == "packing" or out.columns == clashing(no_docs).columns


def test_run_is_the_stages_in_turn(spark, tmp_path):
    out = cp.run(spark, "/root/testdata/sf0.001").collect()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for _, stage in cp.STAGES[:-1]:
        docs = cp.materialize(stage(spark, docs, "/root/testdata/sf0.001"), "step")
    left = {r["doc_id"] for r in docs.collect()}
    assert {r["doc_id"] for r in out} == left and out
    per = defaultdict(list)
    for r in out:
        per[r["sequence_id"]].append((r["offset"], r["length"]))
        assert len(r["ids"]) == r["length"]
    for pieces in per.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
