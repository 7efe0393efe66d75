"""Ranks on the rows themselves, without a window over all rows and without joins on values.

A sketch gives edges in the order of the values, about the square root of the rows in number.  Every
row lies on an edge or strictly between two.  Rows on an edge all have that value, so the counts of
the buckets alone give their rank; a value that a third of the rows share is always an edge.  Rows
between two edges are ranked inside their bucket: by a window while the edges bound its rows by
``MOST_ROWS``, else by edges of its own, level after level, with prefix sums of the counts of every
level.  Any edges give the same ranks.  The buckets are dealt over as many tasks as the rows need, so
that the memory of a task does not follow the rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearth.functions.exprs import at_or_below
from hearth.session import cut_lineage

MOST_EDGES = 1023
#: rows of a bucket that one window task sorts
MOST_ROWS = 200_000
#: rows of all buckets that one window task sorts, on average
TASK_ROWS = 250_000


def edge_count(rows: int) -> int:
    return max(1, min(MOST_EDGES, math.isqrt(rows) // 4))


def levels_for(rows: int) -> int:
    """Levels of edges below the first that keep buckets of ``rows`` rows within ``MOST_ROWS``; the
    sketch's error makes a gap at most a tenth wider."""
    share, levels = 1.2 * rows / (edge_count(rows) + 1), 0
    while share > MOST_ROWS:
        share, levels = 1.2 * share / (MOST_EDGES + 1), levels + 1
    return levels


def dealt(rows: DataFrame, keys: Sequence[str], count: int | None) -> DataFrame:
    """Rows in tasks of about ``TASK_ROWS`` by ``keys``, ``count`` rows at most in all; an exchange
    without a count would be coalesced to a task a core, whatever the rows."""
    if count is None:
        return rows
    return rows.repartition(max(rows.sparkSession.sparkContext.defaultParallelism, math.ceil(count / TASK_ROWS)), *keys)


def number(c: str | Column) -> Column:
    """The column as double, negative zero as zero, NaN as NULL."""
    x = (F.col(c) if isinstance(c, str) else c).cast("double") + F.lit(0.0)
    return F.when(~F.isnan(x), x)


def edges_of(df: DataFrame, cols: Sequence[str], count: int) -> dict[str, list[float]]:
    """Edges of every column: at most ``count`` finite values each."""
    probs = [i / (count + 1) for i in range(1, count + 1)]
    row = df.agg(*[F.percentile_approx(c, probs, 10 * (count + 1)).alias(c) for c in cols]).first()
    return {c: sorted({e for e in row[c] or [] if math.isfinite(e)}) or [0.0] for c in cols}


def with_buckets(df: DataFrame, edges: dict[str, list[float]], prefix: str = "_b") -> DataFrame:
    """Add ``prefix + column``: even for the gap before edge b / 2, odd for the edge (b - 1) / 2."""
    cols = list(edges)
    cut = Bucketizer(inputCols=cols, outputCols=[f"_cut{c}" for c in cols], handleInvalid="keep",
                     splitsArray=[[-math.inf, *edges[c], math.inf] for c in cols]).transform(df)
    for c in cols:
        at = F.col(f"_cut{c}").cast("int")
        values = F.expr("array(" + ", ".join(f"{e!r}D" for e in edges[c]) + ")")
        cut = cut.withColumn(prefix + c, F.when(F.get(values, at - 1) == F.col(c), 2 * at - 1).otherwise(2 * at))
    return cut.drop(*[f"_cut{c}" for c in cols])


def starts_of(rows: DataFrame, by: Sequence[str], b: str) -> DataFrame:
    """Per group two arrays over the buckets: rows before (``_before``) and rows in (``_in``) each."""
    c = rows.groupBy(*by, F.col(b).alias("_b")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)  # the buckets of a group
    c = c.withColumn("_at", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    g = c.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("_b", F.struct("_at", "_n")))).alias("_m"), F.sum("_n").alias("_rows"))
    every = F.transform(F.sequence(F.lit(0), F.lit(2 * MOST_EDGES + 1)), lambda i: F.col("_m")[i])
    # an empty bucket starts where the next one does
    filled = F.aggregate(F.reverse(every), F.struct(F.array().cast("array<bigint>").alias("x"), F.col("_rows").alias("next")),
                         lambda a, s: F.struct(F.concat(F.array(F.coalesce(s["_at"], a["next"])), a["x"]).alias("x"), F.coalesce(s["_at"], a["next"]).alias("next")),
                         lambda a: a["x"])
    return g.select(*by, filled.alias("_before"), F.transform(every, lambda s: F.coalesce(s["_n"], F.lit(0))).alias("_in"), "_rows")


def with_places(rows: DataFrame, keys: Sequence[str], v: str, w: str, levels: int, count: int | None = None) -> DataFrame:
    """Add ``_less`` and ``_same``: the weight ``w`` of the rows of a bucket (``keys``) below the
    row's value ``v``, plus ``_start``, and of those with this value.

    With ``levels`` the bucket is split by edges of its own: rows on one take their place from
    counts, rows between two from their smaller bucket.  ``count`` as for ``dealt``."""
    keys = list(keys)
    if not levels:
        # both frames in one window: a second one by the value would sort the rows again
        bucket = Window.partitionBy(*keys).orderBy(v)
        upto = F.sum(w).over(bucket.rangeBetween(Window.unboundedPreceding, Window.currentRow))
        same = F.sum(w).over(bucket.rangeBetween(Window.currentRow, Window.currentRow))
        rows = dealt(rows, keys, count).withColumns({"_same": same, "_upto": upto})
        return rows.withColumn("_less", F.col("_start") + F.col("_upto") - F.col("_same")).drop("_upto")
    cell = f"_l{levels}"
    probs = [i / (MOST_EDGES + 1) for i in range(1, MOST_EDGES + 1)]
    edges = rows.groupBy(*keys).agg(F.percentile_approx(v, probs, 10 * (MOST_EDGES + 1)).alias("_e"))
    at = at_or_below(F.col("_e"), F.col(v))
    cut = rows.join(edges.withColumn("_e", F.array_distinct("_e")), keys).withColumn("_at", at)
    cut = cut_lineage(cut.withColumn(cell, F.when(F.get("_e", F.col("_at") - 1) == F.col(v), 2 * F.col("_at") - 1).otherwise(2 * F.col("_at"))).drop("_e", "_at"))
    counts = cut.groupBy(*keys, cell).agg(F.sum(w).alias("_held"))
    before = Window.partitionBy(*keys).orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)  # at most 2,047 cells
    counts = counts.withColumn("_more", F.coalesce(F.sum("_held").over(before), F.lit(0)))
    cut = cut.join(counts, [*keys, cell]).withColumn("_start", F.col("_start") + F.col("_more")).drop("_more")
    on = cut.filter(F.col(cell) % 2 == 1).withColumn("_less", F.col("_start")).withColumn("_same", F.col("_held"))
    between = with_places(cut.filter(F.col(cell) % 2 == 0).drop("_held"), [*keys, cell], v, w, levels - 1, count)
    columns = [*rows.columns, "_less", "_same"]
    return on.select(columns).unionByName(between.select(columns))


def with_average_rank(df: DataFrame, by: Sequence[str], v: str, b: str, out: str, levels: int = 0,
                      count: int | None = None, counted: DataFrame | None = None) -> DataFrame:
    """Rows with their 1-based rank in the group; equal values share the mean of their places.

    ``b`` is the bucket of ``v``; ``by`` has few groups (columns of a table); ``levels`` as
    ``levels_for`` the rows, ``count`` as for ``dealt``; ``counted`` has the buckets of the same rows
    where ``df`` is dear to read twice."""
    cols = [*df.columns, out]
    starts = F.broadcast(starts_of(df if counted is None else counted, by, b))  # one row of bounded arrays per group
    rows = df.join(starts, list(by)) if by else df.join(starts)
    rows = rows.withColumn("_start", F.get("_before", F.col(b))).withColumn("_held", F.get("_in", F.col(b))).drop("_before", "_in", "_rows")
    on = rows.filter(F.col(b) % 2 == 1).withColumn(out, F.col("_start") + (F.col("_held") + 1) / 2)
    between = with_places(rows.filter(F.col(b) % 2 == 0).drop("_held").withColumn("_w", F.lit(1)), [*by, b], v, "_w", levels, count)
    between = between.withColumn(out, F.col("_less") + (F.col("_same") + 1) / 2)
    return on.select(cols).unionByName(between.select(cols))
