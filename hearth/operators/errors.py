"""Error analysis on out-of-fold predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.functions.exprs import right_closed_bin
from hearth.operators.quantiles import exact_quantiles, quantile_columns, with_quantiles


def error_frame(preds: DataFrame, truth: DataFrame | None, id_col: str, target: str,
                pred_col: str = "pred_log", sign: str = "pred_minus_true",
                keep: Sequence[str] = (), sum_cols: Sequence[str] = (),
                sum_name: str = "total_sf", log_space: bool = True,
                check_keys: bool = False) -> DataFrame:
    """L1: per-row errors in raw and log space.

    ``sign`` = 'pred_minus_true' (apps) or 'true_minus_pred' (notebook).
    Rows are aligned by key, never by position; with ``check_keys`` a key
    without a truth row raises (anti join count, one scalar to the driver).
    """
    if check_keys and truth is not None:
        missing = preds.join(truth.select(id_col), id_col, "left_anti").limit(1).count()
        if missing:
            raise ValueError("predictions contain ids that are absent from the truth table")
    t_cols = [id_col, target, *[c for c in keep if c != id_col],
              *[c for c in sum_cols if c not in keep]]
    if truth is None:  # predictions already carry the target and features
        j = preds
        preds = preds.drop(*[c for c in t_cols if c != id_col])
    else:
        j = preds.join(truth.select(*t_cols), id_col)
    y = F.col(target).cast("double")
    p_log = F.col(pred_col).cast("double")
    p_raw = F.expm1(p_log) if log_space else p_log
    y_log = F.log1p(y)
    cols = [F.col(c) for c in preds.columns if c not in (pred_col,)]
    d = j.select(*cols, y.alias("y_true"), p_raw.alias("y_pred"), y_log.alias("y_true_log"),
                 (p_log if log_space else F.log1p(p_log)).alias("y_pred_log"),
                 *[F.col(c) for c in keep], *[F.col(c) for c in sum_cols if c not in keep])
    if sign == "pred_minus_true":
        rr, rl = F.col("y_pred") - F.col("y_true"), F.col("y_pred_log") - F.col("y_true_log")
    else:
        rr, rl = F.col("y_true") - F.col("y_pred"), F.col("y_true_log") - F.col("y_pred_log")
    d = d.select("*", rr.alias("residual_raw"), rl.alias("residual_log"))
    d = d.select("*", F.abs("residual_raw").alias("abs_error_raw"),
                 F.abs("residual_log").alias("abs_error_log"),
                 (F.abs("residual_raw") / F.greatest(F.col("y_true"), F.lit(1.0))).alias("ape_raw"))
    if sum_cols:
        total = None
        for c in sum_cols:
            term = F.coalesce(F.col(c).try_cast("double"), F.lit(0.0))
            total = term if total is None else total + term
        d = d.withColumn(sum_name, total)
        d = d.drop(*[c for c in sum_cols if c not in keep])
    return d


def error_kpis(err: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """L2: RMSE, MAE, p90 and p95 of the absolute raw error."""
    g = with_quantiles(err, by, [F.sqrt(F.avg(F.pow("residual_raw", 2))).alias("rmse"),
                                 F.avg("abs_error_raw").alias("mae")],
                       [("abs_error_raw", [0.9, 0.95], "_q")], needs=["residual_raw", "abs_error_raw"])
    return g.select(*by, "rmse", "mae", F.col("_q")[0].alias("p90_abs"),
                    F.col("_q")[1].alias("p95_abs"))


def compare_models(err: DataFrame, model_col: str = "model") -> DataFrame:
    """L3: raw and log RMSE/MAE/MAPE per model, sorted by log RMSE."""
    return (err.groupBy(model_col).agg(
        F.sqrt(F.avg(F.pow("residual_raw", 2))).alias("rmse_raw"),
        F.avg("abs_error_raw").alias("mae_raw"),
        F.avg("ape_raw").alias("mape_raw"),
        F.sqrt(F.avg(F.pow("residual_log", 2))).alias("rmse_log"),
        F.avg("abs_error_log").alias("mae_log"))
        .orderBy("rmse_log"))


def quantile_edges(df: DataFrame, c: str, q: int, by: Sequence[str] = ()) -> DataFrame:
    """Distinct sorted quantile edges P(c, i/q), i = 0..q (duplicates dropped)."""
    probs = [i / q for i in range(q + 1)]
    e = exact_quantiles(df.filter(F.col(c).isNotNull()), c, probs, by, out="_q")
    return e.select(*by, F.sort_array(F.array_distinct("_q")).alias("edges"))


def quantile_bins(df: DataFrame, c: str, q: int = 10, out: str = "bin",
                  label: str | None = "bin_label", scale: float = 1000.0) -> DataFrame:
    """L4: right-closed quantile bins (qcut), duplicates dropped; label
    'lo-hi' in thousands.  The edge row is one array of <= q+1 doubles,
    joined by broadcast."""
    edges = quantile_edges(df, c, q)
    j = df.join(F.broadcast(edges), how="left")  # one row
    b = right_closed_bin(c, F.col("edges"))
    j = j.withColumn(out, b.cast("int"))
    if label:
        lo = F.element_at(F.col("edges"), F.col(out))
        hi = F.element_at(F.col("edges"), F.col(out) + 1)
        j = j.withColumn(label, F.when(F.col(out).isNotNull(), F.concat(
            F.bround(lo / scale, 0).cast("bigint").cast("string"), F.lit("k-"),
            F.bround(hi / scale, 0).cast("bigint").cast("string"), F.lit("k"))))
    return j.drop("edges")


# Quality tiers (0,4], (4,6], (6,10].
QUALITY_EDGES = [0, 4, 6, 10]
QUALITY_LABELS = ["Low (1-4)", "Mid (5-6)", "High (7-10)"]


def fixed_bins(df: DataFrame, c: str, edges: Sequence[float] = QUALITY_EDGES,
               labels: Sequence[str] = QUALITY_LABELS, out: str = "tier") -> DataFrame:
    """Right-closed fixed bins (pd.cut); outside the edges -> NULL."""
    x = F.col(c)
    expr = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = (x > lo) & (x <= hi)
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return df.withColumn(out, expr)


def segment_errors(err: DataFrame, by: str | Sequence[str], with_p90: bool = False) -> DataFrame:
    """N, MAE, MAPE and median true value per segment."""
    by = [by] if isinstance(by, str) else list(by)
    aggs = [F.count(F.lit(1)).alias("n"), F.avg("abs_error_raw").alias("mae"),
            F.avg("ape_raw").alias("mape")]
    qs = [("y_true", [0.5], "_qm")] + ([("abs_error_raw", [0.9], "_qp")] if with_p90 else [])
    g = with_quantiles(err, by, aggs, qs, needs=["abs_error_raw", "ape_raw"])
    out = [*by, "n", "mae", "mape", F.col("_qm")[0].alias("median_true")]
    if with_p90:
        out.append(F.col("_qp")[0].alias("p90_abs"))
    return g.select(*out)


def worst_segment(err: DataFrame, by: str) -> DataFrame:
    """The segment with the highest mean absolute error (one row)."""
    g = with_quantiles(err.filter(F.col(by).isNotNull()), [by], [
        F.count(F.lit(1)).alias("n"), F.avg("abs_error_raw").alias("mean_abs"),
        F.avg("ape_raw").alias("mean_ape")], [("abs_error_raw", [0.9], "_q")], needs=["abs_error_raw", "ape_raw"])
    g = g.select(by, "n", "mean_abs", F.col("_q")[0].alias("p90_abs"), "mean_ape")
    return g.orderBy(F.desc("mean_abs"), F.asc(by)).limit(1)


def risk_table(err: DataFrame, groups: dict[str, str], min_n: int = 1) -> DataFrame:
    """Segment errors over several groupings stacked as (group, segment).

    Each row is expanded once per grouping and collapsed by the map-side
    partial aggregate before the shuffle."""
    cells = F.explode(F.array(*[F.struct(F.lit(name).alias("group"), F.col(c).cast("string").alias("segment"))
                                for c, name in groups.items()]))
    d = err.select(cells.alias("_c"), "abs_error_raw", "ape_raw", "y_true").select("_c.*", "abs_error_raw", "ape_raw", "y_true")
    g = quantile_columns(d.filter(F.col("segment").isNotNull()), ["group", "segment"], [
        F.count(F.lit(1)).alias("n"), F.avg("abs_error_raw").alias("mae"), F.avg("ape_raw").alias("mape")],
        [("y_true", 0.5, "median_true")])
    return g.filter(F.col("n") >= min_n)


def category_risk(err: DataFrame, c: str, min_n: int = 10,
                  min_coverage: float = 0.6) -> DataFrame:
    """Per-level errors of a category, only when the category is filled
    on more than ``min_coverage`` of the rows; levels need n >= min_n."""
    cov = err.agg(F.avg(F.col(c).isNotNull().cast("double")).alias("_cov"))
    g = with_quantiles(err.filter(F.col(c).isNotNull()), [c], [
        F.count(F.lit(1)).alias("n"), F.avg("abs_error_raw").alias("mae"),
        F.avg("ape_raw").alias("mape")], [("y_true", [0.5], "_q")], needs=["abs_error_raw", "ape_raw"])
    g = g.select(c, "n", "mae", "mape", F.col("_q")[0].alias("median_true")).filter(
        F.col("n") >= min_n)
    return (g.join(F.broadcast(cov), how="inner")  # one-row coverage scalar
            .filter(F.col("_cov") > min_coverage).drop("_cov"))


def top_segments(err: DataFrame, features: DataFrame, id_col: str, by: str,
                 k: int = 25) -> DataFrame:
    """The k worst levels of ``by`` by MAE after joining the features."""
    j = join_features(err, features, id_col, [by])
    g = with_quantiles(j, [by], [F.count(F.lit(1)).alias("n"),
                                 F.avg("abs_error_raw").alias("mae"),
                                 F.avg("ape_raw").alias("mape")], [("y_true", [0.5], "_q")], needs=["abs_error_raw", "ape_raw"])
    g = g.select(by, "n", "mae", "mape", F.col("_q")[0].alias("median_price"))
    return g.orderBy(F.desc("mae"), F.asc(by)).limit(k)


def worst_rows(err: DataFrame, n: int = 25, cols: Sequence[str] | None = None,
               id_col: str = "id") -> DataFrame:
    """Top-n absolute errors (TakeOrdered; no global sort)."""
    cols = list(cols or [id_col, "y_true", "y_pred", "abs_error_raw", "ape_raw"])
    return err.orderBy(F.desc("abs_error_raw"), F.asc(id_col)).limit(n).select(*cols)


def join_features(err: DataFrame, features: DataFrame, id_col: str,
                  cols: Sequence[str] | None = None) -> DataFrame:
    """Left join of raw features on the key."""
    feats = features if cols is None else features.select(id_col, *cols)
    dup = [c for c in feats.columns if c in err.columns and c != id_col]
    return err.join(feats.drop(*dup), id_col, "left")


def error_correlates(err: DataFrame, cols: Sequence[str], target: str = "abs_error_raw",
                     min_pairs: int = 50, k: int = 8) -> DataFrame:
    """Spearman correlation of each numeric column with the absolute
    error (NULL below ``min_pairs`` pairs), ranked by magnitude."""
    from hearth.operators.profile import spearman
    rho = spearman(err, cols, target, min_pairs=min_pairs)
    return (rho.withColumn("direction", F.when(F.col("spearman") > 0, F.lit(
        "larger values -> larger errors")).when(F.col("spearman") < 0, F.lit(
            "larger values -> smaller errors")).otherwise(F.lit("no relation")))
        .filter(F.col("spearman").isNotNull())
        .orderBy(F.desc(F.abs("spearman")), F.asc("feature")).limit(k))


def residual_histogram(err: DataFrame, c: str = "residual_raw", bins: int = 70,
                       trim: tuple[float, float] | None = (0.01, 0.99)) -> DataFrame:
    """Equal-width histogram of residuals, optionally 1-99% trimmed."""
    from hearth.operators.align import trim_quantiles
    from hearth.operators.profile import histogram
    d = trim_quantiles(err, c, trim[0], trim[1]) if trim else err
    return histogram(d, c, bins)
