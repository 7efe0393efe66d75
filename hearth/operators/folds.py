"""Folds, holdout splits and samples.

Randomness comes from md5 of the row key, never from a generator, so the
assignment is identical on every partitioning, after executor loss, and in
the SQL oracle.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearth.functions.exprs import hash_bucket, hash_key, right_closed_bin
from hearth.operators.quantiles import with_quantiles


def assign_folds(df: DataFrame, id_col: str, k: int = 5, seed: int = 42,
                 out: str = "fold") -> DataFrame:
    """G1: shuffled K folds, fold = md5(id:seed) mod k (map-only)."""
    return df.withColumn(out, hash_bucket(id_col, seed, k))


def dense_index(df: DataFrame, key: Column, ties: Sequence[str], name: str) -> DataFrame:
    """Dense 0-based index of the rows in the order of ``key`` (uniform 32-bit
    integers) and ``ties``.

    Rows fall into about sqrt(rows) buckets that follow the key, so a row's
    index is its place in its bucket plus the rows of earlier buckets; the
    bucket is a column of the row, never the number of a partition, and no
    task holds more than one bucket or the table of bucket sizes."""
    d = df.withColumn("_k", key)
    buckets = max(1, math.isqrt(df.count()))
    d = d.withColumn("_b", F.floor(F.col("_k") * buckets / F.lit(4294967296.0)))
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)  # one row per bucket
    starts = d.groupBy("_b").agg(F.count(F.lit(1)).alias("_n")).select("_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    place = F.row_number().over(Window.partitionBy("_b").orderBy("_k", *ties)) - 1
    return d.join(starts, "_b").withColumn(name, F.col("_off") + place).drop("_b", "_k", "_off")


def assign_balanced_folds(df: DataFrame, id_col: str, k: int = 5, seed: int = 42,
                          out: str = "fold") -> DataFrame:
    """G1 variant with fold sizes differing by at most one: the rank of the
    row's md5 key modulo k."""
    d = dense_index(df, hash_key(id_col, seed), [id_col], "_i")
    return d.withColumn(out, F.pmod("_i", F.lit(k)).cast("int")).drop("_i")


def holdout_split(df: DataFrame, id_col: str, test_share: float = 0.2,
                  seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Deterministic train/holdout split on md5 buckets of 100."""
    b = F.pmod(hash_key(id_col, seed), F.lit(100))
    cut = int(round(test_share * 100))
    return df.filter(b >= cut), df.filter(b < cut)


def sample_n(df: DataFrame, id_col: str, n: int, seed: int = 42,
             drop: list[str] | None = None) -> DataFrame:
    """O2: n rows without replacement: the n smallest md5(id:seed) values
    (TakeOrdered: each task keeps n rows, no full sort)."""
    out = (df.withColumn("_h", hash_key(id_col, seed))
           .orderBy("_h", id_col).limit(n).drop("_h"))
    return out.drop(*(drop or []))


def stratified_sample(df: DataFrame, id_col: str, target: str, n: int, q: int = 10,
                      seed: int = 42, min_rows: int = 50) -> DataFrame:
    """O1: quantile strata of the target, proportional allocation with floor +
    largest remainder (ties: lower bin first), md5 order within each stratum.

    Falls back to ``sample_n`` when the target is absent, fewer than
    ``min_rows`` rows or fewer than 3 strata.  The per-stratum cut uses a
    window partitioned by stratum; a stratum can be a third of the data, so
    the rank is computed from a range sort inside that partition only."""
    if target not in df.columns:
        return sample_n(df, id_col, n, seed)
    probs = [i / q for i in range(q + 1)]
    stats = with_quantiles(df.filter(F.col(target).isNotNull()), [], [F.count(F.lit(1)).alias("rows")], [(target, probs, "_q")], needs=[]).select(
        "rows", F.sort_array(F.array_distinct("_q")).alias("edges")).first()
    rows, edges = stats["rows"], stats["edges"]
    if rows < min_rows or edges is None or len(edges) < 4:
        return sample_n(df, id_col, n, seed)
    take = min(n, rows)
    edges_col = F.array(*[F.lit(float(e)) for e in edges])
    binned = (df.filter(F.col(target).isNotNull())
              .withColumn("_bin", right_closed_bin(target, edges_col)))
    sizes = binned.groupBy("_bin").agg(F.count(F.lit(1)).alias("_size"))  # <= q rows
    alloc = sizes.select(
        "_bin", "_size",
        (F.lit(float(take)) * F.col("_size") / F.lit(float(rows))).alias("_raw"))
    alloc = alloc.select("_bin", F.floor("_raw").cast("bigint").alias("_floor"),
                         (F.col("_raw") - F.floor("_raw")).alias("_frac"))
    w_all = Window.partitionBy()  # over <= q rows only
    alloc = alloc.withColumn("_left", F.lit(take) - F.sum("_floor").over(w_all))
    alloc = alloc.withColumn(
        "_rank", F.row_number().over(Window.orderBy(F.desc("_frac"), F.asc("_bin"))))
    alloc = alloc.select("_bin", (F.col("_floor") + F.when(F.col("_rank") <= F.col("_left"), 1)
                                  .otherwise(0)).alias("_nb"))
    # The literal bound lets Catalyst plan a partial WindowGroupLimit before
    # the shuffle, so each map task ships at most `take` rows per stratum.
    ranked = binned.withColumn("_h", hash_key(id_col, seed)).withColumn(
        "_r", F.row_number().over(Window.partitionBy("_bin").orderBy("_h", id_col)))
    ranked = ranked.filter(F.col("_r") <= F.lit(take))
    return (ranked.join(F.broadcast(alloc), "_bin")
            .filter(F.col("_r") <= F.col("_nb"))
            .drop("_h", "_r", "_nb", "_bin"))
