"""Profiling / EDA (M1-M7, M14) and feature profiles.

Statistics over many columns are fused into one aggregate and then
unpivoted to (feature, statistic) rows, instead of one job per column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from hearth.operators.ranks import edge_count, edges_of, levels_for, number, with_average_rank, with_buckets
from hearth.session import cut_lineage


def numeric_cols(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NumericType) and f.name not in set(exclude)]


def missing_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """M1: NULL count per column, only columns with missing values, sorted."""
    cols = list(cols or df.columns)
    wide = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in cols])
    long = wide.unpivot([], cols, "feature", "missing")
    return long.filter(F.col("missing") > 0).orderBy("missing", "feature")


def melt(df: DataFrame, cols: Sequence[str], id_cols: Sequence[str] = (),
         var: str = "variable", val: str = "value") -> DataFrame:
    """M2: wide -> long (values cast to a common type by Spark)."""
    return df.unpivot(list(id_cols), list(cols), var, val)


def box_summary(df: DataFrame, c: str, by: str) -> DataFrame:
    """M3: quartiles, median and 1.5*IQR whiskers per level.  Two passes:
    quartiles per level, then the extreme values inside the whisker fences."""
    from hearth.operators.quantiles import with_quantiles
    q = with_quantiles(df, [by], [F.count(F.col(c)).alias("n")], [(c, [0.25, 0.5, 0.75], "_q")], needs=[c])
    q = q.select(by, "n", F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("median"),
                 F.col("_q")[2].alias("q3"))
    q = q.withColumn("_lo", F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))) \
         .withColumn("_hi", F.col("q3") + 1.5 * (F.col("q3") - F.col("q1")))
    # one row per level; AQE broadcasts it when small
    j = df.select(by, c).join(q.select(by, "_lo", "_hi"), by)
    w = j.groupBy(by).agg(
        F.min(F.when(F.col(c) >= F.col("_lo"), F.col(c))).alias("whisker_lo"),
        F.max(F.when(F.col(c) <= F.col("_hi"), F.col(c))).alias("whisker_hi"))
    return q.drop("_lo", "_hi").join(w, by)


def histogram(df: DataFrame, c: str, bins: int = 30, log: bool = False) -> DataFrame:
    """M4: equal-width counts like np.histogram (left-closed bins, last one
    closed), optional log1p of the values, with the median as a marker.

    First min, max and median; then counts per bin.
    Empty bins are included (bins rows from a range)."""
    x = F.log1p(F.col(c)) if log else F.col(c).cast("double")
    d = df.select(x.alias("_x")).filter(F.col("_x").isNotNull() & ~F.isnan("_x"))
    from hearth.operators.quantiles import quantile_columns
    st = quantile_columns(d, [], [F.min("_x").alias("_mn"), F.max("_x").alias("_mx")], [("_x", 0.5, "median")])
    mn, mx = F.col("_mn"), F.col("_mx")
    lo = F.when(mn == mx, mn - 0.5).otherwise(mn)
    hi = F.when(mn == mx, mx + 0.5).otherwise(mx)
    step = (hi - lo) / F.lit(float(bins))
    j = d.join(F.broadcast(st), how="inner").select(
        "_x", lo.alias("_lo"), step.alias("_step"), "median")
    raw = F.floor((F.col("_x") - F.col("_lo")) / F.col("_step")).cast("int")
    idx = F.least(F.greatest(raw, F.lit(0)), F.lit(bins - 1))
    edge = lambda i: i * F.col("_step") + F.col("_lo")
    idx = F.when(F.col("_x") < edge(idx), idx - 1).when(
        (F.col("_x") >= edge(idx + 1)) & (idx != bins - 1), idx + 1).otherwise(idx)
    counts = j.groupBy(idx.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    spark = df.sparkSession
    all_bins = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    out = all_bins.join(counts, "bin", "left").join(F.broadcast(st), how="inner")
    return out.select(
        "bin", (F.col("bin") * step + lo).alias("lo"), ((F.col("bin") + 1) * step + lo).alias("hi"),
        F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count"), "median")


def pearson(df: DataFrame, cols: Sequence[str], target: str, min_pairs: int = 3) -> DataFrame:
    """M5: pairwise-complete Pearson of each column with the target, one
    aggregate for all columns; NULL below ``min_pairs`` pairs."""
    y = F.col(f"`{target}`").cast("double")
    aggs = []
    for c in cols:
        x = F.col(f"`{c}`").cast("double")
        both = x.isNotNull() & y.isNotNull()
        aggs.append(F.struct(
            F.corr(F.when(both, x), F.when(both, y)).alias("r"),
            F.count_if(both).alias("n")).alias(c))
    wide = df.agg(*aggs)
    long = wide.unpivot([], list(cols), "feature", "s")
    return long.select("feature", F.when(F.col("s.n") >= min_pairs, F.col("s.r"))
                       .alias("pearson"), F.col("s.n").alias("n"))


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """M5: full pairwise-complete Pearson matrix in one aggregate, long form."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    aggs = []
    for k, (a, b) in enumerate(pairs):
        x, y = F.col(f"`{a}`").cast("double"), F.col(f"`{b}`").cast("double")
        both = x.isNotNull() & y.isNotNull()
        aggs.append(F.corr(F.when(both, x), F.when(both, y)).alias(f"p{k}"))
    row = df.agg(*aggs)
    long = row.unpivot([], [f"p{k}" for k in range(len(pairs))], "_k", "r")
    names = F.create_map(*[v for k, (a, b) in enumerate(pairs)
                           for v in (F.lit(f"p{k}"), F.array(F.lit(a), F.lit(b)))])
    one = long.select(names[F.col("_k")].alias("_ab"), "r")
    a_b = one.select(F.col("_ab")[0].alias("a"), F.col("_ab")[1].alias("b"), "r")
    b_a = a_b.filter(F.col("a") != F.col("b")).select(
        F.col("b").alias("a"), F.col("a").alias("b"), "r")
    return a_b.unionByName(b_a)


def spearman(df: DataFrame, cols: Sequence[str], target: str, min_pairs: int = 2) -> DataFrame:
    """M6: Spearman rank correlation (average ranks for ties, NULL pairs
    dropped per column) of every column with the target, for all columns in
    one plan: (feature, x, y) pairs, average ranks of x and of y within each
    feature on the pairs themselves, then Pearson on the ranks per feature."""
    wide = df.select(*[number(F.col(f"`{c}`")).alias(f"x{i}") for i, c in enumerate(cols)], number(F.col(f"`{target}`")).alias("y"))
    # read for the edges, the counts and the ranks: written once
    wide = cut_lineage(wide.filter(F.col("y").isNotNull()))
    names = [f"x{i}" for i in range(len(cols))]
    held = wide.agg(F.count(F.lit(1)).alias("y"), *[F.count(x).alias(x) for x in names]).first()
    rows = held["y"]
    levels = levels_for(rows)
    wide = with_buckets(wide, edges_of(wide, [*names, "y"], edge_count(rows)))

    def pairs(frame: DataFrame, own: list[str], *more: str) -> DataFrame:
        cells = F.explode(F.array(*[F.struct(F.lit(cols[int(x[1:])]).alias("feature"), F.col(x).alias("_x"), F.col(f"_b{x}").alias("_bx")) for x in own]))
        return frame.select(cells.alias("_c"), *more).select("_c.*", *more).filter(F.col("_x").isNotNull())

    # columns without gaps pair with all of y, so that y is ranked once for all of them
    full, gaps = [x for x in names if held[x] == rows], [x for x in names if held[x] < rows]
    parts = []
    if full:
        ranked = cut_lineage(with_average_rank(wide.select("y", "_by", *full, *[f"_b{x}" for x in full]), [], "y", "_by", "_ry", levels, rows))
        j = pairs(ranked, full, "_ry")
        parts.append(with_average_rank(j, ["feature"], "_x", "_bx", "_rx", levels, rows * len(full)))
    if gaps:
        count = sum(held[x] for x in gaps)
        j = with_average_rank(pairs(wide, gaps, "y", "_by"), ["feature"], "y", "_by", "_ry", levels, count)
        parts.append(with_average_rank(j, ["feature"], "_x", "_bx", "_rx", levels, count, pairs(wide, gaps)))
    j = parts[0].select("feature", "_rx", "_ry")
    for more in parts[1:]:
        j = j.unionByName(more.select("feature", "_rx", "_ry"))
    g = j.groupBy("feature").agg(F.corr("_rx", "_ry").alias("_r"),
                                 F.count(F.lit(1)).alias("n"))
    spark = df.sparkSession
    names = spark.createDataFrame([(c,) for c in cols], "feature string")
    out = names.join(g, "feature", "left")
    return out.select("feature", F.when(F.col("n") >= max(min_pairs, 2), F.col("_r"))
                      .alias("spearman"), F.coalesce(F.col("n"), F.lit(0)).alias("n"))


def segment_mean_diff(df: DataFrame, cols: Sequence[str], target: str,
                      threshold: float = 200000.0) -> DataFrame:
    """M7: (mean over expensive - mean over cheap) / mean over cheap per
    column, NULL counted as 0; one aggregate with conditional averages."""
    hi = F.col(f"`{target}`") >= threshold
    lo = F.col(f"`{target}`") < threshold
    aggs = []
    for c in cols:
        x = F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0))
        aggs.append(F.struct(F.avg(F.when(hi, x)).alias("h"), F.avg(F.when(lo, x)).alias("l"))
                    .alias(c))
    long = df.agg(*aggs).unpivot([], list(cols), "feature", "s")
    return long.select("feature", F.try_divide(F.col("s.h") - F.col("s.l"), F.col("s.l"))
                       .alias("difference"))


def data_overview(train: DataFrame, test: DataFrame | None, target: str,
                  id_col: str | None = None) -> DataFrame:
    """Row counts, column counts, numeric vs categorical counts."""
    spark = train.sparkSession
    x = [c for c in train.columns if c != target]
    num = [c for c in numeric_cols(train.select(*[F.col(f"`{c}`") for c in x]))
           if c != id_col]
    cat = [f.name for f in train.schema.fields
           if f.name in x and not isinstance(f.dataType, NumericType)]
    n_train = train.count()
    n_test = test.count() if test is not None else None
    return spark.createDataFrame(
        [(n_train, n_test, len(train.columns), len(num), len(cat))],
        "train_rows bigint, test_rows bigint, columns bigint, quantitative bigint, "
        "qualitative bigint")


def feature_profile(df: DataFrame, cols: Sequence[str], min_values: int = 20) -> DataFrame:
    """p05, p50, p95 and IQR (at least 1e-9) per column; columns with
    fewer than ``min_values`` values are skipped.  One aggregate."""
    from hearth.operators.quantiles import with_quantiles
    long = df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in cols]).unpivot(
        [], list(cols), "feature", "_x")
    g = with_quantiles(long, ["feature"], [F.count("_x").alias("n")],
                       [("_x", [0.05, 0.25, 0.5, 0.75, 0.95], "q")])
    return g.filter(F.col("n") >= min_values).select(
        "feature", F.col("q")[0].alias("p05"), F.col("q")[2].alias("p50"),
        F.col("q")[4].alias("p95"),
        F.greatest(F.col("q")[3] - F.col("q")[1], F.lit(1e-9)).alias("iqr"))
