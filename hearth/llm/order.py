"""Running sums over an order that no single task could hold, in DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hearth.llm.common import materialize


def running(rows: DataFrame, stratum: str, order: Sequence[str], value: str | None = None, label: str = "order") -> DataFrame:
    """``rows`` with ``start``: the sum of ``value`` (None: the number) of the rows before it in
    its stratum, and ``of``: the stratum's sum. ``order`` should tell unlike rows apart.

    Rows are laid out in ranges of (stratum, order) and written with their range and place, so a
    stratum of any size is spread over ranges and equal rows cannot crowd one key. The result does
    not depend on where the ranges end.
    """
    laid = rows.repartitionByRange(stratum, *order).sortWithinPartitions(stratum, *order)
    laid = materialize(laid.withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()), label)
    part = W.partitionBy(stratum, "_part").orderBy("_at").rowsBetween(W.unboundedPreceding, -1)
    if value is None:
        sums = laid.groupBy(stratum, "_part").agg(F.count(F.lit(1)).alias("_held"), F.min("_at").alias("_first"))
        inside = F.col("_at") - F.col("_first")
    else:
        laid = laid.withColumn("_inside", F.coalesce(F.sum(value).over(part), F.lit(0)))
        sums = laid.groupBy(stratum, "_part").agg(F.sum(value).alias("_held"))
        inside = F.col("_inside")
    # one row for each range and stratum
    before = W.partitionBy(stratum).orderBy("_part")
    sums = sums.withColumn("_before", F.coalesce(F.sum("_held").over(before.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    sums = sums.withColumn("of", F.sum("_held").over(W.partitionBy(stratum))).drop("_held")
    told = laid.join(sums, [stratum, "_part"]).withColumn("start", F.col("_before") + inside)
    return told.select(*rows.columns, "start", "of")
