"""Sharding by proportional stratified interleaving, in DataFrame functions only.

Rows of every source are shuffled by a seeded hash and ranked; rank r of n gets the fraction
(r - 1/2) / n. Sorted by that fraction, every stretch of rows holds the sources in the
proportions of the whole, and cutting the order into equal counts gives shards that all match
the mixture. Neither order needs one task for a whole source or table: rows are put in about
sqrt(rows) buckets that follow the order, buckets are counted, and a row's place is its place in
its bucket plus the rows of earlier buckets.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from hearth.llm.common import materialize


def shard(docs: DataFrame, shards: int = 24, seed: int = 42, id_col: str = "doc_id",
          text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``id, size, text_crc32, source, rank, fraction, position, shard, slot`` for every row.

    Shards hold equal numbers of rows, at most one apart. ``size`` is the text's UTF-8 bytes
    (null: none) plus 8, ``text_crc32`` of the same bytes. A null source is a source of its own.
    Rows that agree in id, text size and checksum are interchangeable; repeated rows each get a
    slot. Equal texts form no group here: the law is the count of rows. With fewer rows than
    shards some shards are empty; an empty table gives no rows. Other columns are not used.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("id"), (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.col(source_col).cast("string").alias("source"))
    rows = rows.withColumn("stratum", F.coalesce(F.concat(F.lit("="), "source"), F.lit("-")))
    rows = materialize(rows.withColumn("shuffled", F.xxhash64(F.lit(seed), "id", "text_crc32")), "rows")
    total = rows.count()
    buckets = max(1, math.isqrt(total))

    def bucket(share: Column) -> Column:
        return F.least(F.floor(share * buckets), F.lit(buckets - 1)).cast("long")

    own = ["shuffled", "id", "text_crc32", "size"]
    rows = rows.withColumn("bucket", bucket((F.col("shuffled").cast("double") + 2.0**63) / 2.0**64))
    before = W.partitionBy("stratum").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = rows.groupBy("stratum", "bucket").agg(F.count("*").alias("held"))
    starts = starts.select("stratum", "bucket", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("start"), F.sum("held").over(W.partitionBy("stratum")).alias("of"))
    ranked = rows.join(starts, ["stratum", "bucket"])
    ranked = ranked.withColumn("rank", F.col("start") + F.row_number().over(W.partitionBy("stratum", "bucket").orderBy(*own)))
    ranked = ranked.withColumn("fraction", (F.col("rank") - 0.5) / F.col("of")).drop("start", "of", "bucket")
    ranked = materialize(ranked.withColumn("bucket", bucket(F.col("fraction"))), "ranked")

    starts = ranked.groupBy("bucket").agg(F.count("*").alias("held"))
    starts = starts.select("bucket", F.coalesce(F.sum("held").over(W.orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("start"))
    order = W.partitionBy("bucket").orderBy("fraction", "stratum", *own)
    placed = ranked.join(starts, "bucket").withColumn("position", F.col("start") + F.row_number().over(order) - 1)
    placed = placed.withColumn("shard", F.expr(f"position * {shards} div {max(total, 1)}").cast("int"))
    first = F.expr(f"(cast(shard as bigint) * {total} + {shards - 1}) div {shards}")
    return placed.withColumn("slot", F.col("position") - first).select(
        "id", "size", "text_crc32", "source", "rank", "fraction", "position", "shard", "slot")
