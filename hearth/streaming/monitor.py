"""Structured Streaming variants of batch operators.

* ``score_stream``: scheduled batch scoring (I1) as a stateless stream, file source to
  Parquet sink, exactly-once through the checkpoint location.
* ``windowed_psi``: PSI (K5) of incoming data per event-time tumbling window against
  reference quantile edges; windowed bin counts are kept in state with a
  watermark, and each finalised window is scored in ``foreachBatch``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.operators.align import align_schema
from hearth.operators.drift import psi_band, psi_edges
from hearth.functions.exprs import unlog


def score_stream(model, stream: DataFrame, features: Sequence[str], id_col: str,
                 sink: str, checkpoint: str, model_id: str, trigger_once: bool = True):
    """I1 on a stream: align -> transform -> append (id, price, log price, model)."""
    aligned, _m, _e = align_schema(stream, list(features), id_col)
    out = model.transform(aligned).select(
        F.col(id_col), unlog("prediction").alias("pred_price"),
        F.col("prediction").alias("pred_log"), F.lit(model_id).alias("model_id"))
    w = (out.writeStream.format("parquet").option("path", sink)
         .option("checkpointLocation", checkpoint).outputMode("append"))
    w = w.trigger(availableNow=True) if trigger_once else w
    return w.start()


def reference_shares(ref: DataFrame, cols: Sequence[str], bins: int = 10) -> tuple[DataFrame,
                                                                                   DataFrame]:
    """Edges (additive variant) and reference share per (feature, bin); both
    are bounded by features x bins and are joined statically into the stream."""
    edges = psi_edges(ref, cols, bins, "additive")
    long = ref.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        [], list(cols), "feature", "x").filter(F.col("x").isNotNull())
    b = _bin(long.join(F.broadcast(edges), "feature"))
    cnt = b.groupBy("feature", "bin").agg(F.count(F.lit(1)).alias("_n"))
    tot = cnt.groupBy("feature").agg(F.sum("_n").alias("_t"))
    shares = cnt.join(tot, "feature").select("feature", "bin", (F.col("_n") / F.col("_t"))
                                             .alias("e"))
    return edges, shares


def _bin(d: DataFrame) -> DataFrame:
    lo, hi = F.element_at("edges", 1), F.element_at("edges", -1)
    idx = F.least(F.size(F.filter("edges", lambda e: e <= F.col("x"))), F.size("edges") - 1)
    return d.filter((F.col("x") >= lo) & (F.col("x") <= hi)).withColumn("bin", idx)


def windowed_psi(stream: DataFrame, ts_col: str, cols: Sequence[str], edges: DataFrame,
                 shares: DataFrame, sink: str, checkpoint: str, window: str = "1 day",
                 watermark: str = "1 hour", trigger_once: bool = True):
    """K5 per tumbling window: counts per (window, feature, bin) with a
    watermark (late rows inside the watermark still count; state for a window
    is dropped once it is final), then PSI of each finalised window against
    the reference shares, appended to ``sink``."""
    # event time must be TIMESTAMP (NTZ columns are read in the session time zone)
    long = (stream.withColumn(ts_col, F.col(ts_col).cast("timestamp"))
            .withWatermark(ts_col, watermark)
            .select(ts_col, *[F.col(c).cast("double").alias(c) for c in cols])
            .unpivot([ts_col], list(cols), "feature", "x").filter(F.col("x").isNotNull()))
    binned = _bin(long.join(F.broadcast(edges), "feature"))
    counts = binned.groupBy(F.window(ts_col, window).alias("w"), "feature", "bin").agg(
        F.count(F.lit(1)).alias("a_n"))

    all_bins = edges.select("feature", F.explode(F.sequence(F.lit(1), F.size("edges") - 1))
                            .alias("bin"))  # features x bins, static

    def score(batch: DataFrame, epoch: int) -> None:
        tot = batch.groupBy("w", "feature").agg(F.sum("a_n").alias("_t"))
        grid = tot.select("w", "feature").join(all_bins, "feature")  # windows x bins
        j = (grid.join(batch, ["w", "feature", "bin"], "left")
             .join(shares, ["feature", "bin"], "left")
             .join(tot, ["w", "feature"]).fillna(0, ["a_n", "e"]))
        a, e = F.col("a_n") / F.col("_t"), F.col("e")
        term = (a - e) * F.log((a + 1e-6) / (e + 1e-6))
        out = j.groupBy("w", "feature").agg(F.sum(term).alias("psi")).select(
            F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
            "feature", "psi", psi_band(F.col("psi")).alias("status"))
        # a batch that runs again after a failure replaces what it wrote
        out.write.mode("overwrite").parquet(f"{sink}/epoch={epoch}")

    w = (counts.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
         .foreachBatch(score))
    w = w.trigger(availableNow=True) if trigger_once else w
    return w.start()
