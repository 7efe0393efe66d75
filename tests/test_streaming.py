"""Structured Streaming variants: scoring and windowed PSI over a file source
of the driver's events table."""

import os
import tempfile

from pyspark.sql import functions as F

from hearth.streaming.monitor import reference_shares, score_stream, windowed_psi

SF = "/root/testdata/sf0.001"


def _source(spark):
    d = tempfile.mkdtemp(prefix="hearth-stream-", dir="/tmp")
    src = os.path.join(d, "src")
    ev = spark.read.parquet(f"{SF}/events.parquet")
    ev.filter(F.col("ts") >= "2024-01-16").repartition(3).write.parquet(src)
    return d, src, ev


def test_windowed_psi(spark):
    d, src, ev = _source(spark)
    ref = ev.filter(F.col("ts") < "2024-01-16")
    edges, shares = reference_shares(ref, ["value"], 10)
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = windowed_psi(stream, "ts", ["value"], edges, shares, os.path.join(d, "psi"),
                     os.path.join(d, "ck"), window="5 days", watermark="1 hour")
    q.awaitTermination(300)
    out = spark.read.parquet(os.path.join(d, "psi"))
    rows = out.collect()
    assert rows and all(r["psi"] >= 0 for r in rows)
    assert {r["feature"] for r in rows} == {"value"}


def test_score_stream(spark):
    from hearth.plans.q_score import _fit_ridge
    from hearth.sources.bindings import sales_split
    d = tempfile.mkdtemp(prefix="hearth-stream-", dir="/tmp")
    ref, cur = sales_split(spark, SF)
    model, feats = _fit_ridge(ref)
    src = os.path.join(d, "in")
    cur.drop("price").repartition(2).write.parquet(src)
    stream = spark.readStream.schema(cur.drop("price").schema).parquet(src)
    q = score_stream(model, stream, feats, "id", os.path.join(d, "out"), os.path.join(d, "ck"),
                     "ridge/stream")
    q.awaitTermination(300)
    got = spark.read.parquet(os.path.join(d, "out"))
    assert got.count() == cur.count()
    assert got.filter(F.col("pred_price") < 0).count() == 0
