"""Flagship: error by target decile of out-of-fold ridge predictions.

sales -> log features (D11, C2) -> md5 folds (G1) -> OOF one-feature ridge
(G2) -> error frame (L1) -> right-closed target deciles (L4) -> segment
errors (L6).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.functions.exprs import hash_key, log1p0, rnd
from hearth.operators.errors import error_frame, quantile_bins, segment_errors
from hearth.operators.folds import assign_balanced_folds, assign_folds, dense_index
from hearth.operators.oof import fold_summary, oof_group_mean, oof_ridge1
from hearth.plans.registry import query
from hearth.plans.sqlparts import SALES_CTE, fold_sql, quantiles_sql, rc_bin_sql, ridge1_sql
from hearth.session import cut_lineage
from hearth.sources.bindings import sales

KEEP = ["nbhd", "quality", "segment", "priority", "status", "yr_built", "qty", "ext",
        "acctbal", "n_lines", "disc"]


def sales_xy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales with x = log1p(max(ext or 0, 0)), y = log1p(price), fold."""
    s = sales(spark, sf_dir)
    d = s.withColumn("x", log1p0(F.coalesce(F.col("ext"), F.lit(0.0)))) \
         .withColumn("y", F.log1p("price"))
    return assign_folds(d, "id", 5, 42)


def oof_errors(spark: SparkSession, sf_dir: str, keep: list[str] = KEEP) -> DataFrame:
    """Error frame of the OOF ridge with the kept features.  The training
    frame is checkpointed once: the fold statistics, the row path and the
    quantile edges downstream all read it instead of re-running the
    lineitem aggregation and the joins."""
    d = sales_xy(spark, sf_dir).select("id", "price", "x", "y", "fold", *keep)
    p = oof_ridge1(cut_lineage(d), "x", "y", alpha=12.0)
    return error_frame(p, None, "id", "price", keep=keep)


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prediction table (model, id, fold, pred_log) of three stand-in models
    that are all computed from fold sufficient statistics (training frame
    checkpointed once, read by all six passes)."""
    d = cut_lineage(sales_xy(spark, sf_dir).withColumn(
        "xq", log1p0(F.coalesce(F.col("qty"), F.lit(0.0)))).select(
        "id", "fold", "x", "xq", "y", "priority"))
    a = oof_ridge1(d, "x", "y", alpha=12.0).select(
        F.lit("ridge_ext").alias("model"), "id", "fold", "pred_log")
    b = oof_ridge1(d, "xq", "y", alpha=12.0).select(
        F.lit("ridge_qty").alias("model"), "id", "fold", "pred_log")
    c = oof_group_mean(d, "priority", "y").select(
        F.lit("seg_mean").alias("model"), "id", "fold", "pred_log")
    return a.unionByName(b).unionByName(c)


PRED_SQL = f"""
{SALES_CTE},
sx AS (SELECT *, ln(1 + CASE WHEN coalesce(ext, 0.0) < 0 THEN 0.0 ELSE coalesce(ext, 0.0) END) AS x,
              ln(1 + CASE WHEN coalesce(qty, 0.0) < 0 THEN 0.0 ELSE coalesce(qty, 0.0) END) AS xq,
              ln(1 + price) AS y, {fold_sql('id')} AS fold FROM sales),
sq AS (SELECT id, fold, xq AS x, y FROM sx),
{ridge1_sql('sx', 'x', 'y')},
{ridge1_sql('sq', 'x', 'y')},
gm AS (
  SELECT k.fold, d.priority, SUM(d.y) / COUNT(*) AS m
  FROM (SELECT DISTINCT fold FROM sx) k JOIN sx d ON d.fold <> k.fold
  WHERE d.priority IS NOT NULL GROUP BY k.fold, d.priority),
gg AS (
  SELECT k.fold, SUM(d.y) / COUNT(*) AS m
  FROM (SELECT DISTINCT fold FROM sx) k JOIN sx d ON d.fold <> k.fold GROUP BY k.fold),
preds AS (
  SELECT 'ridge_ext' AS model, id, fold, pred_log FROM oof_sx
  UNION ALL SELECT 'ridge_qty', id, fold, pred_log FROM oof_sq
  UNION ALL SELECT 'seg_mean', d.id, d.fold, coalesce(gm.m, gg.m)
  FROM sx d LEFT JOIN gm ON d.fold = gm.fold AND d.priority = gm.priority
  JOIN gg ON d.fold = gg.fold)
"""

ERR_SQL = f"""
{SALES_CTE},
sx AS (SELECT *, ln(1 + CASE WHEN coalesce(ext, 0.0) < 0 THEN 0.0 ELSE coalesce(ext, 0.0) END) AS x,
              ln(1 + price) AS y, {fold_sql('id')} AS fold FROM sales),
{ridge1_sql('sx', 'x', 'y')},
err0 AS (
  SELECT id, fold, price AS y_true, exp(pred_log) - 1 AS y_pred, ln(1 + price) AS y_true_log,
         pred_log AS y_pred_log, nbhd, quality, segment, priority, status, yr_built, qty, ext,
         acctbal, n_lines, disc
  FROM oof_sx),
err AS (
  SELECT *, y_pred - y_true AS residual_raw, y_pred_log - y_true_log AS residual_log,
         abs(y_pred - y_true) AS abs_error_raw, abs(y_pred_log - y_true_log) AS abs_error_log,
         abs(y_pred - y_true) / greatest(y_true, 1.0) AS ape_raw
  FROM err0)
"""


def _flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    err = oof_errors(spark, sf_dir, keep=[])
    b = quantile_bins(err, "y_true", 10, out="bin", label="bin_label")
    seg = segment_errors(b, ["bin", "bin_label"])
    return seg.select("bin", "bin_label", "n", rnd("mae", 2).alias("mae"),
                      rnd("mape", 6).alias("mape"), rnd("median_true", 3).alias("median_true"))


FLAGSHIP_SQL = f"""
WITH {ERR_SQL.strip()},
e AS (SELECT {quantiles_sql('y_true', 10)} AS edges FROM err),
b AS (SELECT err.*, CAST({rc_bin_sql('y_true', 'e.edges')} AS INTEGER) AS bin, e.edges FROM err, e)
SELECT bin,
       CAST(CAST(round_even(edges[bin] / 1000.0, 0) AS BIGINT) AS VARCHAR) || 'k-' ||
       CAST(CAST(round_even(edges[bin + 1] / 1000.0, 0) AS BIGINT) AS VARCHAR) || 'k' AS bin_label,
       COUNT(*) AS n, round(AVG(abs_error_raw), 2) AS mae, round(AVG(ape_raw), 6) AS mape,
       round(quantile_cont(y_true, 0.5), 3) AS median_true
FROM b GROUP BY bin, bin_label
"""

query("l6_segment_errors_decile", FLAGSHIP_SQL)(_flagship)


@query("g2_oof_ridge1_fold_rmse", f"""
WITH {ERR_SQL.strip()}
SELECT fold, COUNT(*) AS n, round(sqrt(AVG(residual_log * residual_log)), 9) AS rmse
FROM err GROUP BY fold
""")
def _g2(spark, sf_dir):
    err = oof_errors(spark, sf_dir)
    return err.groupBy("fold").agg(F.count(F.lit(1)).alias("n"),
                                   rnd(F.sqrt(F.avg(F.pow("residual_log", 2))), 9).alias("rmse"))


@query("g1_assign_folds", f"""
WITH {SALES_CTE.strip()}
SELECT {fold_sql('id')} AS fold, COUNT(*) AS n, CAST(SUM(id) AS BIGINT) AS id_sum FROM sales GROUP BY 1
""")
def _g1(spark, sf_dir):
    d = assign_folds(sales(spark, sf_dir).select("id"), "id", 5, 42)
    return d.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.sum("id").alias("id_sum"))


_RANKED = f"""
WITH {SALES_CTE.strip()},
k AS (SELECT id, price, ('0x' || substr(md5(CAST(id AS VARCHAR) || ':42'), 1, 8))::BIGINT AS h FROM sales),
r AS (SELECT id, price, row_number() OVER (ORDER BY h, id) - 1 AS i FROM k)"""


@query("g1_balanced_folds", _RANKED + """
SELECT id, price, CAST(i % 5 AS INTEGER) AS fold FROM r
""")
def _g1b(spark, sf_dir):
    return assign_balanced_folds(sales(spark, sf_dir).select("id", "price"), "id", 5, 42)


@query("g1_dense_index", _RANKED + """
SELECT id, price, i AS idx FROM r
""")
def _g1i(spark, sf_dir):
    return dense_index(sales(spark, sf_dir).select("id", "price"), hash_key("id", 42), ["id"], "idx")


@query("g4_fold_summary", f"""
WITH {PRED_SQL.strip()},
pe AS (SELECT p.model, p.fold, (p.pred_log - ln(1 + s.price)) AS r FROM preds p JOIN sales s ON p.id = s.id),
per AS (SELECT model, fold, SUM(r * r) AS sse, COUNT(*) AS n FROM pe GROUP BY model, fold)
SELECT model, round(sqrt(SUM(sse) / SUM(n)), 9) AS oof_rmse,
       round(AVG(sqrt(sse / n)), 9) AS fold_rmse_mean,
       round(stddev_pop(sqrt(sse / n)), 9) AS fold_rmse_std
FROM per GROUP BY model
""")
def _g4(spark, sf_dir):
    p = predictions(spark, sf_dir)
    s = sales(spark, sf_dir).select("id", F.log1p("price").alias("y"))
    j = p.join(s, "id")
    out = fold_summary(j, "y", "pred_log", "fold", by=["model"])
    return out.select("model", rnd("oof_rmse", 9).alias("oof_rmse"),
                      rnd("fold_rmse_mean", 9).alias("fold_rmse_mean"),
                      rnd("fold_rmse_std", 9).alias("fold_rmse_std"))
