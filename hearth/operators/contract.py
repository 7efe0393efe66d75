"""Prediction contracts and regression gates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearth.operators.quantiles import exact_quantiles, quantile_columns

from hearth.operators.folds import sample_n

# Contract tolerances (relative, absolute) in log space.
TOL_LINEAR = (0.01, 0.005)
TOL_TREES = (0.03, 0.03)
TREE_MODELS = {"lgbm", "extratrees", "xgb", "stacking", "voting_mean"}
# Verdict thresholds and log-space detection band.
PARTIAL_DEMO, PARTIAL_APP = 0.8, 0.7
LOG_BAND = (6.0, 16.0)
MIN_FEATURES, MIN_ROWS = 20, 5


def tolerance_for(model_name: str) -> tuple[float, float]:
    return TOL_TREES if model_name in TREE_MODELS else TOL_LINEAR


def pick_golden_rows(df: DataFrame, id_col: str, n: int = 12, seed: int = 42) -> DataFrame:
    """Deterministic sample without replacement (n smallest md5(id:seed))."""
    return sample_n(df, id_col, n, seed)


def contract_bounds(preds: DataFrame, pred_col: str, model_name: str) -> DataFrame:
    """J2 (row form): lo/hi = pred -/+ (|pred| * rel + abs)."""
    rel, ab = tolerance_for(model_name)
    band = F.abs(F.col(pred_col)) * rel + ab
    return preds.select("*", (F.col(pred_col) - band).alias("pred_lo"),
                        (F.col(pred_col) + band).alias("pred_hi"))


def make_contract(golden: DataFrame, preds: DataFrame, id_col: str, pred_col: str,
                  model_name: str, features: Sequence[str], seed: int, n_rows: int
                  ) -> DataFrame:
    """One nested contract document (golden rows in key order, parallel
    lo/hi arrays, tolerance policy).  The golden set is bounded (n rows), so
    collecting it into one document is safe."""
    rel, ab = tolerance_for(model_name)
    b = contract_bounds(preds.select(id_col, pred_col), pred_col, model_name)
    rows = golden.join(b, id_col)
    doc = rows.agg(F.array_sort(F.collect_list(F.struct(
        F.col(id_col).alias("_k"), F.struct(*[F.col(f"`{c}`") for c in features]).alias("x"),
        F.col("pred_lo").alias("lo"), F.col("pred_hi").alias("hi")))).alias("_r"))
    return doc.select(
        F.lit(model_name).alias("model_name"), F.lit(seed).cast("bigint").alias("seed"),
        F.lit(n_rows).cast("bigint").alias("n_rows"),
        F.array(*[F.lit(c) for c in features]).alias("feature_columns"),
        F.transform("_r", lambda r: r["x"]).alias("golden_X"),
        F.struct(F.transform("_r", lambda r: r["lo"]).alias("pred_lo"),
                 F.transform("_r", lambda r: r["hi"]).alias("pred_hi")).alias("expected"),
        F.struct(F.lit(rel).alias("relative"), F.lit(ab).alias("absolute"),
                 F.lit("pass if pred within [lo, hi] for each golden row (log-space)")
                 .alias("note")).alias("tolerance_policy"))


def contract_rows(contract: DataFrame, id_field: str) -> DataFrame:
    """Explode a contract document back into rows: (pos, id, lo, hi, x...)."""
    z = contract.select(F.posexplode(F.arrays_zip(
        F.col("golden_X").alias("x"), F.col("expected.pred_lo").alias("lo"),
        F.col("expected.pred_hi").alias("hi"))).alias("pos", "z"))
    return z.select("pos", F.col(f"z.x.{id_field}").alias(id_field),
                    F.col("z.lo").alias("pred_lo"), F.col("z.hi").alias("pred_hi"), "z.x")


def check_contract(bounds: DataFrame, rescored: DataFrame, id_col: str, pred_col: str,
                   partial: float = PARTIAL_DEMO, log_space: bool = True,
                   strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """Per-row pass (lo <= pred <= hi) with price-space columns, and a
    summary row: pass rate, failed rows, median band width, verdict
    (pass = 1.0, partial >= threshold, or > with ``strict`` as in the second
    variant, else fail)."""
    j = bounds.select(id_col, "pred_lo", "pred_hi").join(
        rescored.select(id_col, F.col(pred_col).alias("pred")), id_col)
    ok = (F.col("pred") >= F.col("pred_lo")) & (F.col("pred") <= F.col("pred_hi"))
    rows = j.select(id_col, "pred", "pred_lo", "pred_hi", F.coalesce(ok, F.lit(False)).alias("pass"))
    if log_space:
        rows = rows.select("*", F.expm1("pred").alias("pred_price"),
                           F.expm1("pred_lo").alias("lo_price"), F.expm1("pred_hi").alias("hi_price"))
    rate = F.avg(F.col("pass").cast("double"))
    summary = quantile_columns(rows, [], [
        rate.alias("pass_rate"), F.count_if(~F.col("pass")).alias("failed_rows"), F.count(F.lit(1)).alias("rows")],
        [(F.col("pred_hi") - F.col("pred_lo"), 0.5, "median_band_width")], needs=["pass"])
    summary = summary.withColumn("verdict", verdict(F.col("pass_rate"), partial, strict))
    return rows, summary


def verdict(rate: Column, partial: float = PARTIAL_DEMO, strict: bool = False) -> Column:
    reached = rate > partial if strict else rate >= partial
    return (F.when(rate == 1.0, F.lit("pass")).when(reached, F.lit("partial"))
            .otherwise(F.lit("fail")))


def contract_shape_ok(contract: DataFrame) -> DataFrame:
    """J3 shape checks: >= 20 features, >= 5 golden rows, equal lengths."""
    n_x, n_lo, n_hi = F.size("golden_X"), F.size("expected.pred_lo"), F.size("expected.pred_hi")
    return contract.select(
        (F.size("feature_columns") >= MIN_FEATURES).alias("enough_features"),
        (n_x >= MIN_ROWS).alias("enough_rows"),
        ((n_x == n_lo) & (n_x == n_hi)).alias("equal_lengths"))


def rmse_gate(new: DataFrame, baseline: DataFrame, on: str = "model",
              tolerance: float = 0.01) -> DataFrame:
    """New RMSE <= baseline + tolerance, per model."""
    j = new.withColumnRenamed("rmse", "new_rmse").join(
        baseline.select(on, F.col("rmse").alias("baseline_rmse")), on)
    return j.withColumn("passed", F.col("new_rmse") <= F.col("baseline_rmse") + tolerance)


def reload_consistency(before: DataFrame, after: DataFrame, id_col: str, pred_col: str,
                       tol: float) -> DataFrame:
    """Maximum absolute prediction difference before/after save+load."""
    j = before.select(id_col, F.col(pred_col).alias("_a")).join(
        after.select(id_col, F.col(pred_col).alias("_b")), id_col)
    return j.agg(F.max(F.abs(F.col("_a") - F.col("_b"))).alias("max_abs_diff"),
                 F.count(F.lit(1)).alias("rows")).withColumn(
        "consistent", F.col("max_abs_diff") <= tol)


def detect_log_space(preds: DataFrame, pred_col: str, truth: DataFrame | None = None,
                     target: str | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Predictions are log1p-like when their median is in [6, 16] and the
    target's median is above 1000."""
    m = quantile_columns(preds, by, [F.count(F.lit(1)).alias("_n")], [(pred_col, 0.5, "pred_median")], needs=[]).drop("_n")
    if truth is not None and target is not None:
        t = exact_quantiles(truth, target, [0.5]).select(F.col("q")[0].alias("target_median"))
        m = m.join(F.broadcast(t), how="inner")
        cond = F.col("pred_median").between(*LOG_BAND) & (F.col("target_median") > 1000)
    else:
        cond = F.col("pred_median").between(*LOG_BAND)
    return m.withColumn("is_log_space", F.coalesce(cond, F.lit(True)))
