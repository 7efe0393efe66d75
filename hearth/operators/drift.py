"""Drift monitoring.

Every statistic is computed for all columns at once: the frame is unpivoted
to (feature, value) and grouped by feature, so one job covers any number of
columns; the map-side partial aggregate collapses the unpivoted rows before
the shuffle.  Per-feature edge tables (<= bins+1 doubles per feature) are the
only broadcast inputs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearth.functions.exprs import hash_uniform
from hearth.operators.quantiles import exact_quantiles, with_quantiles
from hearth.session import cut_lineage

EPS_STD = 1e-9
MISSING_SCORE = 10.0
# PSI bands.
PSI_WATCH, PSI_ACTION = 0.10, 0.25
# Name fragments of columns that stay non-negative when shifted.
NON_NEGATIVE_HINTS = ["sf", "area", "cars", "bath", "room", "lot", "front", "porch", "deck", "year"]


def _long_num(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    d = df.select(*[F.col(f"`{c}`").try_cast("double").alias(c) for c in cols])
    return d.unpivot([], list(cols), "feature", "x")


def _long_cat(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    d = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in cols])
    return d.unpivot([], list(cols), "feature", "v")


def _num_stats(long: DataFrame, by: Sequence[str]) -> DataFrame:
    """Moments, null rate and three quantiles per group of long rows (..., x)."""
    x = F.col("x")
    return with_quantiles(long, by, [
        F.count(F.lit(1)).alias("rows"), F.count(x).alias("n"), F.avg(x).alias("mean"),
        F.coalesce(F.stddev_samp(x), F.lit(0.0)).alias("std"),
        (1.0 - F.count(x) / F.count(F.lit(1))).alias("na_rate")],
        [("x", [0.05, 0.5, 0.95], "q")])


def _named(stats: DataFrame, p: str) -> DataFrame:
    return stats.select("feature", *[F.col(c).alias(f"{p}_{c}") for c in ("rows", "n", "mean", "std", "na_rate", "q")])


def numeric_drift(ref: DataFrame, cur: DataFrame, cols: Sequence[str]) -> DataFrame:
    """K1: mean, std (ddof 1), q05/q50/q95, null rate on both sides;
    drift_score = |delta mean| / (|ref_std| + 1e-9) + 2 |delta null rate|;
    note 'insufficient numeric data' when either side has no value."""
    long = _long_num(ref, cols).withColumn("side", F.lit("ref")).unionByName(_long_num(cur, cols).withColumn("side", F.lit("cur")))
    both = cut_lineage(_num_stats(long, ["side", "feature"]))  # two rows a column
    return _numeric_scores(_named(both.filter("side = 'ref'"), "ref"), _named(both.filter("side = 'cur'"), "cur"))


def _numeric_scores(r: DataFrame, c: DataFrame) -> DataFrame:
    """K1 of the statistics of two sides, one row a column each."""
    j = r.join(c, "feature")
    ok = (F.col("ref_n") > 0) & (F.col("cur_n") > 0)
    out = j.select(
        "feature", F.lit("numeric").alias("type"),
        F.col("ref_mean"), F.col("cur_mean"),
        F.when(F.col("ref_n") > 1, F.col("ref_std")).otherwise(F.lit(0.0)).alias("ref_std"),
        F.when(F.col("cur_n") > 1, F.col("cur_std")).otherwise(F.lit(0.0)).alias("cur_std"),
        F.col("ref_q")[0].alias("ref_q05"), F.col("cur_q")[0].alias("cur_q05"),
        F.col("ref_q")[1].alias("ref_q50"), F.col("cur_q")[1].alias("cur_q50"),
        F.col("ref_q")[2].alias("ref_q95"), F.col("cur_q")[2].alias("cur_q95"),
        "ref_na_rate", "cur_na_rate", ok.alias("_ok"))
    score = (F.abs(F.col("cur_mean") - F.col("ref_mean")) / (F.abs("ref_std") + EPS_STD)
             + 2.0 * F.abs(F.col("cur_na_rate") - F.col("ref_na_rate")))
    return out.select(
        *[c for c in out.columns if c != "_ok"],
        F.when(F.col("_ok"), score).alias("drift_score"),
        F.when(~F.col("_ok"), F.lit("insufficient numeric data")).alias("note"))


def _level_counts(df: DataFrame, cols: Sequence[str], p: str) -> tuple[DataFrame, DataFrame]:
    long = _long_cat(df, cols)
    lv = (long.filter(F.col("v").isNotNull()).groupBy("feature", "v")
          .agg(F.count(F.lit(1)).alias(f"{p}_cnt")))
    tot = long.groupBy("feature").agg(
        F.count(F.lit(1)).alias(f"{p}_rows"),
        F.avg(F.col("v").isNull().cast("double")).alias(f"{p}_na_rate"),
        F.count("v").alias(f"{p}_nonnull"))
    return lv, tot


def categorical_drift(ref: DataFrame, cur: DataFrame, cols: Sequence[str], top_k: int = 10
                      ) -> DataFrame:
    """K2: l1 shift of level shares on the union of both top-k sets, unknown
    rate (current non-null rows with a level absent from the reference, over
    all current rows), score = l1 + 3 unknown + 2 |delta null rate|.
    Top-k ties: higher count first, then lower value."""
    return _categorical_scores(*_level_counts(ref, cols, "ref"), *_level_counts(cur, cols, "cur"), top_k)


def _categorical_scores(rl: DataFrame, rt: DataFrame, cl: DataFrame, ct: DataFrame, top_k: int) -> DataFrame:
    """K2 of the level counts and totals of two sides."""
    # top-k levels of each side: the literal bound lets Catalyst plan a partial
    # WindowGroupLimit, so a high-cardinality feature ships k rows per task
    w_r = Window.partitionBy("feature").orderBy(F.desc("ref_cnt"), F.asc("v"))
    w_c = Window.partitionBy("feature").orderBy(F.desc("cur_cnt"), F.asc("v"))
    tr = rl.withColumn("_r", F.row_number().over(w_r)).filter(F.col("_r") <= F.lit(top_k))
    tc = cl.withColumn("_r", F.row_number().over(w_c)).filter(F.col("_r") <= F.lit(top_k))
    keys = tr.select("feature", "v").unionByName(tc.select("feature", "v")).distinct()
    # level tables: one row per (feature, level)
    both = rl.join(cl, ["feature", "v"], "full")
    top = keys.join(both, ["feature", "v"], "left")  # <= 2k levels per feature
    top = top.select("feature", "v", F.coalesce("ref_cnt", F.lit(0)).alias("r"),
                     F.coalesce("cur_cnt", F.lit(0)).alias("c"))
    w_f = Window.partitionBy("feature")
    top = top.withColumn("_rs", F.sum("r").over(w_f) + 1e-9) \
             .withColumn("_cs", F.sum("c").over(w_f) + 1e-9)
    l1 = top.groupBy("feature").agg(
        F.sum(F.abs(F.col("r") / F.col("_rs") - F.col("c") / F.col("_cs"))).alias("l1_top_shift"))
    unk = both.groupBy("feature").agg(
        F.sum(F.when(F.col("ref_cnt").isNull(), F.col("cur_cnt")).otherwise(0)).alias("_unk"),
        F.count("ref_cnt").alias("ref_unique"), F.count("cur_cnt").alias("cur_unique"))
    j = rt.join(ct, "feature").join(unk, "feature", "left").join(l1, "feature", "left")
    unknown = F.when(F.col("cur_nonnull") == 0, F.lit(0.0)).otherwise(
        F.coalesce(F.col("_unk"), F.lit(0)) / F.col("cur_rows"))
    j = j.select("feature", F.lit("categorical").alias("type"), "ref_na_rate", "cur_na_rate",
                 unknown.alias("unknown_rate"), F.lit(top_k).alias("top_k"),
                 F.coalesce("l1_top_shift", F.lit(0.0)).alias("l1_top_shift"),
                 F.coalesce("ref_unique", F.lit(0)).alias("ref_unique"),
                 F.coalesce("cur_unique", F.lit(0)).alias("cur_unique"))
    return j.withColumn("drift_score", F.col("l1_top_shift") + 3.0 * F.col("unknown_rate")
                        + 2.0 * F.abs(F.col("cur_na_rate") - F.col("ref_na_rate")))


def drift_report(ref: DataFrame, cur: DataFrame, cols: Sequence[str] | None = None,
                 top_k: int = 10, worst: int = 10) -> tuple[DataFrame, DataFrame, DataFrame]:
    """K3: per column numeric or categorical drift by the reference dtype; a
    column absent from the current frame scores 10.  Returns
    (per-column table, overall one-row summary, worst-10 ranking)."""
    from pyspark.sql.types import NumericType
    cols = list(cols or ref.columns)
    num = [c for c in cols if c in cur.columns and isinstance(ref.schema[c].dataType, NumericType)]
    cat = [c for c in cols if c in cur.columns and c not in num]
    absent = [c for c in cols if c not in cur.columns]
    scored = ([numeric_drift(ref, cur, num)] if num else []) + ([categorical_drift(ref, cur, cat, top_k)] if cat else [])
    return _report(ref.sparkSession, scored, absent, worst)


def drift_from_profile(profile: DataFrame, levels: DataFrame, cur: DataFrame, top_k: int = 10,
                       worst: int = 10) -> tuple[DataFrame, DataFrame, DataFrame]:
    """K3 against a stored reference profile (K4) instead of the reference
    rows: the same three tables.  Columns are typed as in the profile; of a
    profiled column that became text, only what reads as numbers counts."""
    known = {r["feature"]: r["dtype"] for r in profile.select("feature", "dtype").collect()}  # one row a column
    num = [c for c, t in known.items() if t == "numeric" and c in cur.columns]
    cat = [c for c, t in known.items() if t != "numeric" and c in cur.columns]
    scored = []
    if num:
        r = profile.filter(F.col("feature").isin(num)).select(
            "feature", F.col("rows").alias("ref_rows"), F.col("n").alias("ref_n"), F.col("mean").alias("ref_mean"), F.col("std").alias("ref_std"),
            F.col("null_rate").alias("ref_na_rate"), F.array("q05", "q50", "q95").alias("ref_q"))
        scored.append(_numeric_scores(r, _named(_num_stats(_long_num(cur, num), ["feature"]), "cur")))
    if cat:
        rl = levels.filter(F.col("feature").isin(cat)).select("feature", F.col("level").alias("v"), F.col("count").alias("ref_cnt"))
        rt = profile.filter(F.col("feature").isin(cat)).select("feature", F.col("rows").alias("ref_rows"), F.col("null_rate").alias("ref_na_rate"), F.col("n").alias("ref_nonnull"))
        scored.append(_categorical_scores(rl, rt, *_level_counts(cur, cat, "cur"), top_k))
    return _report(cur.sparkSession, scored, [c for c in known if c not in cur.columns], worst)


def write_profile(profile: DataFrame, levels: DataFrame, path: str) -> None:
    """K4 sink: the profile and its level table under one folder."""
    profile.coalesce(1).write.mode("overwrite").parquet(f"{path}/profile")
    levels.write.mode("overwrite").parquet(f"{path}/levels")


def read_profile(spark, path: str) -> tuple[DataFrame, DataFrame]:
    """K4 source: (profile, levels) as written."""
    return spark.read.parquet(f"{path}/profile"), spark.read.parquet(f"{path}/levels")


def write_report(report: tuple[DataFrame, DataFrame, DataFrame], path: str) -> None:
    """K3 sink: the per-column table, the summary and the ranking as JSON."""
    for name, part in zip(("columns", "summary", "ranking"), report):
        part.coalesce(1).write.mode("overwrite").json(f"{path}/{name}")


def _report(spark, scored: Sequence[DataFrame], absent: Sequence[str], worst: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    parts = [s.select("feature", "type", F.lit("ok").alias("status"), "drift_score") for s in scored]
    if absent:
        parts.append(spark.createDataFrame(
            [(c, None, "missing_in_current", MISSING_SCORE) for c in absent],
            "feature string, type string, status string, drift_score double"))
    table = parts[0]
    for p in parts[1:]:
        table = table.unionByName(p)
    overall = table.agg(
        (F.sum(F.coalesce("drift_score", F.lit(0.0))) / F.greatest(F.count(F.lit(1)), F.lit(1)))
        .alias("avg_drift_score"), F.count(F.lit(1)).alias("scored_columns"))
    ranking = table.orderBy(F.desc_nulls_last("drift_score"), F.asc("feature")).limit(worst)
    return table, overall, ranking


def profile_stats(df: DataFrame, cols: Sequence[str] | None = None
                  ) -> tuple[DataFrame, DataFrame]:
    """K4: reference profile so drift needs no raw reference.

    Returns (profile, levels): one profile row per column (rows, values n,
    numeric: mean, std, q05/q50/q95, null rate; categorical: null rate and number of levels)
    and a long level table (feature, level, count).  Levels stay a table, not
    a per-feature map, so a high-cardinality column never becomes one row."""
    from pyspark.sql.types import NumericType
    cols = list(cols or df.columns)
    num = [c for c in cols if isinstance(df.schema[c].dataType, NumericType)]
    cat = [c for c in cols if c not in num]
    spark = df.sparkSession
    parts = []
    levels = spark.createDataFrame([], "feature string, level string, count bigint")
    if num:
        s = _named(_num_stats(_long_num(df, num), ["feature"]), "p")
        parts.append(s.select(
            "feature", F.lit("numeric").alias("dtype"), F.col("p_rows").alias("rows"), F.col("p_n").alias("n"),
            F.col("p_na_rate").alias("null_rate"), F.col("p_mean").alias("mean"),
            F.col("p_std").alias("std"), F.col("p_q")[0].alias("q05"),
            F.col("p_q")[1].alias("q50"), F.col("p_q")[2].alias("q95"),
            F.lit(None).cast("bigint").alias("n_levels")))
    if cat:
        lv, tot = _level_counts(df, cat, "p")
        levels = lv.select("feature", F.col("v").alias("level"), F.col("p_cnt").alias("count"))
        nl = lv.groupBy("feature").agg(F.count(F.lit(1)).alias("n_levels"))
        parts.append(tot.join(nl, "feature", "left").select(
            "feature", F.lit("categorical").alias("dtype"), F.col("p_rows").alias("rows"), F.col("p_nonnull").alias("n"),
            F.col("p_na_rate").alias("null_rate"),
            *[F.lit(None).cast("double").alias(k) for k in ("mean", "std", "q05", "q50", "q95")],
            F.coalesce("n_levels", F.lit(0)).alias("n_levels")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out, levels


def psi_edges(ref: DataFrame, cols: Sequence[str], bins: int = 10,
              smoothing: str = "additive") -> DataFrame:
    """Edges per feature: distinct reference quantiles at i/bins.  For
    'floor', features with fewer than 3 edges fall back to quantiles of the
    distinct reference values (<= bins+1 of them); still fewer -> no edges."""
    probs = [i / bins for i in range(bins + 1)]
    long = _long_num(ref, cols).filter(F.col("x").isNotNull())
    e = exact_quantiles(long, "x", probs, ["feature"], out="_q").select(
        "feature", F.sort_array(F.array_distinct("_q")).alias("edges"))
    if smoothing != "floor":
        return e
    e = _small(e)  # one row per feature
    few = [r["feature"] for r in e.filter(F.size("edges") < 3).collect()]
    if not few:
        return e
    # quantiles of the distinct values at linspace(0, 1, min(bins+1, n_unique)),
    # for the few features whose edges collapse
    dist = _long_num(ref, few).filter(F.col("x").isNotNull()).distinct()
    n_u = dist.groupBy("feature").agg(F.count(F.lit(1)).alias("_nu")).filter(F.col("_nu") >= 3)
    dd = dist.join(n_u, "feature")
    small = dd.filter(F.col("_nu") <= bins + 1).groupBy("feature").agg(
        F.array_sort(F.collect_set("x")).alias("_fb"))  # <= bins+1 values
    big = dd.filter(F.col("_nu") > bins + 1)
    large = exact_quantiles(big, "x", probs, ["feature"], out="_q").select(
        "feature", F.sort_array(F.array_distinct("_q")).alias("_fb"))
    fb = small.unionByName(large)
    out = e.join(fb, "feature", "left").select(
        "feature", F.when(F.size("edges") >= 3, F.col("edges")).otherwise(F.col("_fb"))
        .alias("edges"))
    return out.filter(F.col("edges").isNotNull() & (F.size("edges") >= 3))


def _small(df: DataFrame) -> DataFrame:
    """Materialise a bounded table (features x edges) once, so the several
    consumers below do not re-run the quantile plan."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema)


def psi(ref: DataFrame, cur: DataFrame, cols: Sequence[str], bins: int = 10,
        smoothing: str = "floor") -> DataFrame:
    """K5: population stability index per numeric column.

    'additive': sum (a - e) ln((a + 1e-6) / (e + 1e-6)) over bins of the
    unpadded edges; 'floor': edges padded by 1e-9, zero shares -> 1e-6,
    distinct-value fallback, < 3 edges -> NULL.  Bins are [a, b) with the
    last closed; values outside the edges are ignored."""
    edges = _small(psi_edges(ref, cols, bins, smoothing))
    if smoothing == "floor":
        n = F.size("edges")
        edges = edges.select("feature", F.transform("edges", lambda e, i: F.when(
            i == 0, e - 1e-9).when(i == n - 1, e + 1e-9).otherwise(e)).alias("edges"))
    eb = F.broadcast(edges)  # features x (bins + 1) doubles

    def counts(df: DataFrame, p: str) -> DataFrame:
        long = _long_num(df, cols).filter(F.col("x").isNotNull()).join(eb, "feature")
        lo, hi = F.element_at("edges", 1), F.element_at("edges", -1)
        kept = long.filter((F.col("x") >= lo) & (F.col("x") <= hi))
        idx = F.least(F.size(F.filter("edges", lambda e: e <= F.col("x"))),
                      F.size("edges") - 1)
        return kept.groupBy("feature", idx.alias("bin")).agg(F.count(F.lit(1)).alias(p))

    all_bins = edges.select("feature", F.explode(F.sequence(F.lit(1), F.size("edges") - 1))
                            .alias("bin"))
    j = (all_bins.join(counts(ref, "e_n"), ["feature", "bin"], "left")
         .join(counts(cur, "a_n"), ["feature", "bin"], "left")
         .fillna(0, ["e_n", "a_n"]))
    w = Window.partitionBy("feature")  # <= bins rows per feature
    j = j.withColumn("e", F.col("e_n") / F.greatest(F.sum("e_n").over(w), F.lit(1))) \
         .withColumn("a", F.col("a_n") / F.greatest(F.sum("a_n").over(w), F.lit(1)))
    if smoothing == "floor":
        e = F.when(F.col("e") == 0, F.lit(1e-6)).otherwise(F.col("e"))
        a = F.when(F.col("a") == 0, F.lit(1e-6)).otherwise(F.col("a"))
        term = (a - e) * F.log(a / e)
    else:
        term = (F.col("a") - F.col("e")) * F.log((F.col("a") + 1e-6) / (F.col("e") + 1e-6))
    scored = j.groupBy("feature").agg(F.sum(term).alias("psi"))
    # features without usable edges (or without data on a side) stay NULL
    names = ref.sparkSession.createDataFrame([(c,) for c in cols], "feature string")
    has = _long_num(cur, cols).filter(F.col("x").isNotNull()).select("feature").distinct()
    scored = scored.join(has, "feature")
    return names.join(scored, "feature", "left").withColumn("status", psi_band(F.col("psi")))


def psi_band(p: Column) -> Column:
    """K6: <0.10 stable, <=0.25 watch, >0.25 action, NULL -> none."""
    return (F.when(p.isNull() | F.isnan(p), F.lit("none")).when(p < PSI_WATCH, F.lit("stable"))
            .when(p <= PSI_ACTION, F.lit("watch")).otherwise(F.lit("action")))


def category_shift(ref: DataFrame, cur: DataFrame, c: str, k: int = 8,
                   keep_null: bool = True) -> DataFrame:
    """K7: share of each level on both sides (percent, 2 decimals), absolute
    difference, top-k by difference.  NULL is a level when ``keep_null``."""
    def shares(df: DataFrame, name: str) -> DataFrame:
        d = df if keep_null else df.filter(F.col(c).isNotNull())
        g = d.groupBy(F.col(c).cast("string").alias("category")).agg(
            F.count(F.lit(1)).alias("_n"))
        tot = d.agg(F.count(F.lit(1)).alias("_t"))  # one row
        return g.join(F.broadcast(tot), how="inner").select(
            "category", (F.col("_n") / F.col("_t")).alias(name))

    r, i = shares(ref, "_r"), shares(cur, "_i").withColumnRenamed("category", "_c2")
    j = r.join(i, r.category.eqNullSafe(i._c2), "full")
    j = j.select(F.coalesce("category", "_c2").alias("category"),
                 F.coalesce("_r", F.lit(0.0)).alias("_r"), F.coalesce("_i", F.lit(0.0)).alias("_i"))
    j = j.withColumn("_s", F.abs(F.col("_r") - F.col("_i")))
    return j.orderBy(F.desc("_s"), F.asc_nulls_first("category")).limit(k).select(
        "category", F.round(F.col("_r") * 100, 2).alias("reference_pct"),
        F.round(F.col("_i") * 100, 2).alias("incoming_pct"),
        F.round(F.col("_s") * 100, 2).alias("shift"))


def missing_drift(ref: DataFrame, cur: DataFrame) -> DataFrame:
    """K8: NULL rate per shared column on both sides and the difference, in
    percent; one aggregate per side."""
    common = [c for c in ref.columns if c in cur.columns]

    def rates(df: DataFrame, name: str) -> DataFrame:
        w = df.agg(*[F.avg(F.col(f"`{c}`").isNull().cast("double")).alias(c) for c in common])
        return w.unpivot([], common, "feature", name)
    j = rates(ref, "_r").join(rates(cur, "_i"), "feature")
    j = j.withColumn("_s", F.abs(F.col("_r") - F.col("_i")))
    return j.select("feature", F.round(F.col("_r") * 100, 2).alias("reference_missing"),
                    F.round(F.col("_i") * 100, 2).alias("incoming_missing"),
                    F.round(F.col("_s") * 100, 2).alias("shift"))


def drift_summary(psi_table: DataFrame, ref: DataFrame, cur: DataFrame) -> DataFrame:
    """K9: action/watch counts, max and mean PSI, scored n of m, incoming
    NULL rate over all cells, shared field count, row counts."""
    p = F.col("psi")
    s = psi_table.agg(
        F.count_if(p > PSI_ACTION).alias("action_features"),
        F.count_if((p >= PSI_WATCH) & (p <= PSI_ACTION)).alias("watch_features"),
        F.max(p).alias("max_psi"), F.avg(p).alias("mean_psi"),
        F.count(p).alias("scored"), F.count(F.lit(1)).alias("features"))
    cells = cur.agg(F.count(F.lit(1)).alias("_rows"),
                    sum((F.count_if(F.col(f"`{c}`").isNull()) for c in cur.columns),
                        F.lit(0)).alias("_nulls"))
    refn = ref.agg(F.count(F.lit(1)).alias("reference_rows"))
    shared = len(set(ref.columns) & set(cur.columns))
    return s.join(cells, how="inner").join(refn, how="inner").select(
        "action_features", "watch_features", "max_psi", "mean_psi", "scored", "features",
        "reference_rows", F.col("_rows").alias("incoming_rows"),
        (F.col("_nulls") / F.greatest(F.col("_rows") * F.lit(len(cur.columns)), F.lit(1)))
        .alias("incoming_null_rate"),
        F.lit(shared).alias("shared_fields"))


def simulate_shift(df: DataFrame, cols: Sequence[str], id_col: str, strength: float = 0.25,
                   extra_missing: float = 0.12, seed: int = 42) -> DataFrame:
    """Mu + s*sd + (x - mu)(1 + s) + noise(0.05 sd), floored at 0 for
    size-like names; extra random NULLs.  Noise and NULL masks are md5
    uniforms of (id, column, seed), so the result does not depend on the
    partitioning (Box-Muller for the normal draw)."""
    st = df.agg(*[F.struct(F.avg(F.col(f"`{c}`").cast("double")).alias("m"),
                           F.stddev_pop(F.col(f"`{c}`").cast("double")).alias("s")).alias(c)
                  for c in cols])
    j = df.join(F.broadcast(st.select(*[F.col(c).alias(f"_st_{c}") for c in cols])), how="inner")
    out = []
    for c in df.columns:
        if c not in cols:
            out.append(F.col(f"`{c}`"))
            continue
        mu, sd = F.col(f"_st_{c}.m"), F.col(f"_st_{c}.s")
        x = F.col(f"`{c}`").cast("double")
        u1 = F.greatest(hash_uniform(F.concat_ws(":", F.col(id_col).cast("string"),
                                                 F.lit(c), F.lit("n1")), seed), F.lit(1e-12))
        u2 = hash_uniform(F.concat_ws(":", F.col(id_col).cast("string"), F.lit(c), F.lit("n2")),
                          seed)
        z = F.sqrt(-2.0 * F.log(u1)) * F.cos(2 * 3.141592653589793 * u2)
        x2 = mu + strength * sd + (x - mu) * (1.0 + strength) + 0.05 * sd * z
        if any(h in c.lower() for h in NON_NEGATIVE_HINTS):
            x2 = F.when(x2.isNull(), x2).otherwise(F.greatest(x2, F.lit(0.0)))
        x2 = F.when((sd == 0) | sd.isNull(), x).otherwise(x2)
        miss = hash_uniform(F.concat_ws(":", F.col(id_col).cast("string"), F.lit(c),
                                        F.lit("m")), seed) < extra_missing
        out.append(F.when(miss, F.lit(None).cast("double")).otherwise(x2).alias(c))
    return j.select(*out)
