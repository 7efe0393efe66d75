"""Error analysis plans (L1-L14) on the out-of-fold ridge predictions."""

from __future__ import annotations

from pyspark.sql import functions as F

from hearth.functions.exprs import rnd
from hearth.operators import errors
from hearth.plans.q_flagship import ERR_SQL, PRED_SQL, oof_errors, predictions
from hearth.plans.q_profile import _hist_sql, _spearman_sql
from hearth.plans.registry import query
from hearth.plans.sqlparts import quantiles_sql, rc_bin_sql
from hearth.sources.bindings import sales

E = f"WITH {ERR_SQL.strip()}"

MONEY = ["y_true", "y_pred", "residual_raw", "abs_error_raw"]
LOGS = ["y_true_log", "y_pred_log", "residual_log", "abs_error_log", "ape_raw"]


def _err_cols(d):
    return [rnd(c, 2).alias(c) if c in MONEY else rnd(c, 6).alias(c) for c in MONEY + LOGS]


@query("l1_error_frame", f"""{E}
SELECT id, {", ".join(f"round({c}, 2) AS {c}" for c in MONEY)},
       {", ".join(f"round({c}, 6) AS {c}" for c in LOGS)},
       coalesce(TRY_CAST(qty AS DOUBLE), 0.0) + coalesce(TRY_CAST(ext AS DOUBLE), 0.0)
         + coalesce(TRY_CAST(n_lines AS DOUBLE), 0.0) AS total_sf
FROM err
""")
def _l1(spark, sf):
    from hearth.plans.q_flagship import sales_xy
    from hearth.operators.oof import oof_ridge1
    p = oof_ridge1(sales_xy(spark, sf), "x", "y", alpha=12.0)
    d = errors.error_frame(p, None, "id", "price", sum_cols=["qty", "ext", "n_lines"])
    return d.select("id", *_err_cols(d), "total_sf")


@query("l1_error_frame_notebook_sign", f"""{E}
SELECT id, round(y_true - y_pred, 2) AS residual_raw, round(y_true_log - y_pred_log, 6) AS residual_log
FROM err
""")
def _l1n(spark, sf):
    from hearth.plans.q_flagship import sales_xy
    from hearth.operators.oof import oof_ridge1
    p = oof_ridge1(sales_xy(spark, sf), "x", "y", alpha=12.0)
    d = errors.error_frame(p, None, "id", "price", sign="true_minus_pred")
    return d.select("id", rnd("residual_raw", 2).alias("residual_raw"),
                    rnd("residual_log", 6).alias("residual_log"))


@query("l2_error_kpis", f"""{E}
SELECT round(sqrt(AVG(residual_raw * residual_raw)), 4) AS rmse, round(AVG(abs_error_raw), 4) AS mae,
       round(quantile_cont(abs_error_raw, 0.9), 4) AS p90_abs,
       round(quantile_cont(abs_error_raw, 0.95), 4) AS p95_abs FROM err
""")
def _l2(spark, sf):
    k = errors.error_kpis(oof_errors(spark, sf))
    return k.select(*[rnd(c, 4).alias(c) for c in k.columns])


@query("l3_compare_models", f"""WITH {PRED_SQL.strip()},
e AS (SELECT p.model, s.price AS y, exp(p.pred_log) - 1 AS yp, ln(1 + s.price) AS yl, p.pred_log AS pl
      FROM preds p JOIN sales s ON p.id = s.id)
SELECT model, round(sqrt(AVG((yp - y) * (yp - y))), 4) AS rmse_raw, round(AVG(abs(yp - y)), 4) AS mae_raw,
       round(AVG(abs(yp - y) / greatest(y, 1.0)), 9) AS mape_raw,
       round(sqrt(AVG((pl - yl) * (pl - yl))), 9) AS rmse_log, round(AVG(abs(pl - yl)), 9) AS mae_log
FROM e GROUP BY model
""")
def _l3(spark, sf):
    err = errors.error_frame(predictions(spark, sf), sales(spark, sf), "id", "price")
    c = errors.compare_models(err)
    return c.select("model", rnd("rmse_raw", 4).alias("rmse_raw"), rnd("mae_raw", 4).alias("mae_raw"),
                    rnd("mape_raw", 9).alias("mape_raw"), rnd("rmse_log", 9).alias("rmse_log"),
                    rnd("mae_log", 9).alias("mae_log"))


@query("l4_quantile_bins_ties", f"""{E},
e AS (SELECT {quantiles_sql('CAST(quality AS DOUBLE)', 10)} AS edges FROM err)
SELECT CAST({rc_bin_sql('quality', 'e.edges')} AS INTEGER) AS bin, COUNT(*) AS n, CAST(SUM(id) AS BIGINT) AS id_sum
FROM err, e GROUP BY 1
""")
def _l4(spark, sf):
    b = errors.quantile_bins(oof_errors(spark, sf).withColumn("q", F.col("quality").cast("double")),
                             "q", 10, label=None)
    return b.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.sum("id").alias("id_sum"))


@query("l4_quantile_bins_tiers", f"""{E},
e AS (SELECT {quantiles_sql('abs_error_raw', 4)} AS edges FROM err)
SELECT CAST({rc_bin_sql('abs_error_raw', 'e.edges')} AS INTEGER) AS bin, COUNT(*) AS n,
       round(AVG(ape_raw), 9) AS mape FROM err, e GROUP BY 1
""")
def _l4t(spark, sf):
    b = errors.quantile_bins(oof_errors(spark, sf), "abs_error_raw", 4, label=None)
    return b.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), rnd(F.avg("ape_raw"), 9).alias("mape"))


TIER_SQL = ("CASE WHEN quality > 0 AND quality <= 4 THEN 'Low (1-4)' "
            "WHEN quality > 4 AND quality <= 6 THEN 'Mid (5-6)' "
            "WHEN quality > 6 AND quality <= 10 THEN 'High (7-10)' END")


@query("l5_fixed_bins", f"""{E}
SELECT {TIER_SQL} AS tier, COUNT(*) AS n, round(AVG(abs_error_raw), 4) AS mae FROM err GROUP BY 1
""")
def _l5(spark, sf):
    b = errors.fixed_bins(oof_errors(spark, sf), "quality")
    return b.groupBy("tier").agg(F.count(F.lit(1)).alias("n"),
                                 rnd(F.avg("abs_error_raw"), 4).alias("mae"))


@query("l6_segment_errors_nbhd", f"""{E}
SELECT nbhd, COUNT(*) AS n, round(AVG(abs_error_raw), 4) AS mae, round(AVG(ape_raw), 9) AS mape,
       round(quantile_cont(y_true, 0.5), 3) AS median_true,
       round(quantile_cont(abs_error_raw, 0.9), 4) AS p90_abs
FROM err GROUP BY nbhd
""")
def _l6n(spark, sf):
    s = errors.segment_errors(oof_errors(spark, sf), "nbhd", with_p90=True)
    return s.select("nbhd", "n", rnd("mae", 4).alias("mae"), rnd("mape", 9).alias("mape"),
                    rnd("median_true", 3).alias("median_true"), rnd("p90_abs", 4).alias("p90_abs"))


@query("l7_worst_segment", f"""{E}
SELECT nbhd, COUNT(*) AS n, round(AVG(abs_error_raw), 4) AS mean_abs,
       round(quantile_cont(abs_error_raw, 0.9), 4) AS p90_abs, round(AVG(ape_raw), 9) AS mean_ape
FROM err WHERE nbhd IS NOT NULL GROUP BY nbhd ORDER BY AVG(abs_error_raw) DESC, nbhd LIMIT 1
""")
def _l7(spark, sf):
    w = errors.worst_segment(oof_errors(spark, sf), "nbhd")
    return w.select("nbhd", "n", rnd("mean_abs", 4).alias("mean_abs"),
                    rnd("p90_abs", 4).alias("p90_abs"), rnd("mean_ape", 9).alias("mean_ape"))


def _risk_cols(spark, sf):
    err = oof_errors(spark, sf)
    err = errors.quantile_bins(err, "y_true", 10, out="price_bin", label=None)
    err = errors.quantile_bins(err, "ext", 4, out="size_bin", label=None)
    return errors.fixed_bins(err, "quality", out="tier")


RISK_SQL = f"""{E},
e1 AS (SELECT {quantiles_sql('y_true', 10)} AS e1 FROM err),
e2 AS (SELECT {quantiles_sql('ext', 4)} AS e2 FROM err),
r AS (SELECT err.*, CAST(CAST({rc_bin_sql('y_true', 'e1')} AS INTEGER) AS VARCHAR) AS price_bin,
             CAST(CAST({rc_bin_sql('ext', 'e2')} AS INTEGER) AS VARCHAR) AS size_bin,
             {TIER_SQL} AS tier FROM err, e1, e2),
g AS (
  SELECT 'price' AS "group", price_bin AS segment, COUNT(*) AS n, AVG(abs_error_raw) AS mae,
         AVG(ape_raw) AS mape, quantile_cont(y_true, 0.5) AS median_true FROM r GROUP BY price_bin
  UNION ALL SELECT 'size', size_bin, COUNT(*), AVG(abs_error_raw), AVG(ape_raw), quantile_cont(y_true, 0.5)
  FROM r GROUP BY size_bin
  UNION ALL SELECT 'quality', tier, COUNT(*), AVG(abs_error_raw), AVG(ape_raw), quantile_cont(y_true, 0.5)
  FROM r GROUP BY tier
  UNION ALL SELECT 'region', nbhd, COUNT(*), AVG(abs_error_raw), AVG(ape_raw), quantile_cont(y_true, 0.5)
  FROM r GROUP BY nbhd)
SELECT "group", segment, n, round(mae, 4) AS mae, round(mape, 9) AS mape,
       round(median_true, 3) AS median_true
FROM g WHERE segment IS NOT NULL AND n >= 10
"""


@query("l8_risk_table", RISK_SQL)
def _l8(spark, sf):
    r = errors.risk_table(_risk_cols(spark, sf), {"price_bin": "price", "size_bin": "size",
                                                  "tier": "quality", "nbhd": "region"}, min_n=10)
    return r.select("group", "segment", "n", rnd("mae", 4).alias("mae"),
                    rnd("mape", 9).alias("mape"), rnd("median_true", 3).alias("median_true"))


@query("l9_category_risk", f"""{E},
cov AS (SELECT AVG(CASE WHEN nbhd IS NOT NULL THEN 1.0 ELSE 0.0 END) AS cov FROM err)
SELECT nbhd, COUNT(*) AS n, round(AVG(abs_error_raw), 4) AS mae, round(AVG(ape_raw), 9) AS mape,
       round(quantile_cont(y_true, 0.5), 3) AS median_true
FROM err, cov WHERE nbhd IS NOT NULL AND cov > 0.6 GROUP BY nbhd HAVING COUNT(*) >= 10
""")
def _l9(spark, sf):
    c = errors.category_risk(oof_errors(spark, sf), "nbhd", 10, 0.6)
    return c.select("nbhd", "n", rnd("mae", 4).alias("mae"), rnd("mape", 9).alias("mape"),
                    rnd("median_true", 3).alias("median_true"))


@query("l10_top_segments", f"""{E}
SELECT segment, COUNT(*) AS n, round(AVG(abs_error_raw), 4) AS mae, round(AVG(ape_raw), 9) AS mape,
       round(quantile_cont(y_true, 0.5), 3) AS median_price
FROM err GROUP BY segment ORDER BY AVG(abs_error_raw) DESC, segment LIMIT 3
""")
def _l10(spark, sf):
    err = oof_errors(spark, sf).drop("segment")
    t = errors.top_segments(err, sales(spark, sf), "id", "segment", 3)
    return t.select("segment", "n", rnd("mae", 4).alias("mae"), rnd("mape", 9).alias("mape"),
                    rnd("median_price", 3).alias("median_price"))


@query("l11_worst_rows", f"""{E}
SELECT id, round(y_true, 2) AS y_true, round(y_pred, 2) AS y_pred,
       round(abs_error_raw, 2) AS abs_error_raw, round(ape_raw, 9) AS ape_raw
FROM err ORDER BY abs_error_raw DESC, id LIMIT 25
""")
def _l11(spark, sf):
    w = errors.worst_rows(oof_errors(spark, sf), 25)
    return w.select("id", rnd("y_true", 2).alias("y_true"), rnd("y_pred", 2).alias("y_pred"),
                    rnd("abs_error_raw", 2).alias("abs_error_raw"), rnd("ape_raw", 9).alias("ape_raw"))


@query("l12_join_features", f"""{E}
SELECT e.id, round(e.abs_error_raw, 2) AS abs_error_raw, s.nbhd, s.quality, s.acctbal
FROM err e LEFT JOIN sales s ON e.id = s.id
""")
def _l12(spark, sf):
    err = oof_errors(spark, sf).select("id", "abs_error_raw")
    j = errors.join_features(err, sales(spark, sf), "id", ["nbhd", "quality", "acctbal"])
    return j.select("id", rnd("abs_error_raw", 2).alias("abs_error_raw"), "nbhd", "quality",
                    "acctbal")


L13 = ["qty", "ext", "acctbal", "quality", "n_lines", "disc"]


@query("l13_error_correlates", f"""{E},
sp AS ({" UNION ALL ".join(_spearman_sql(c, 'abs_error_raw').replace('FROM sales', 'FROM err') for c in L13)})
SELECT feature, spearman,
       CASE WHEN spearman > 0 THEN 'larger values -> larger errors'
            WHEN spearman < 0 THEN 'larger values -> smaller errors' ELSE 'no relation' END AS direction
FROM sp WHERE n >= 50 AND spearman IS NOT NULL ORDER BY abs(spearman) DESC, feature LIMIT 4
""")
def _l13(spark, sf):
    c = errors.error_correlates(oof_errors(spark, sf), L13, "abs_error_raw", 50, 4)
    return c.select("feature", rnd("spearman", 9).alias("spearman"), "direction")


TRIM = f"""{E},
tr AS (SELECT err.* FROM err, (SELECT quantile_cont(residual_raw, 0.01) AS lo1,
       quantile_cont(residual_raw, 0.99) AS hi1 FROM err) b WHERE residual_raw BETWEEN lo1 AND hi1)"""


@query("l14_residual_histogram_log", _hist_sql("residual_log", 60, E, "err"))
def _l14l(spark, sf):
    h = errors.residual_histogram(oof_errors(spark, sf), "residual_log", 60, None)
    return h.select("bin", rnd("lo", 6).alias("lo"), rnd("hi", 6).alias("hi"), "count",
                    rnd("median", 6).alias("median"))


@query("l14_residual_histogram", _hist_sql("residual_raw", 70, TRIM, "tr"))
def _l14(spark, sf):
    h = errors.residual_histogram(oof_errors(spark, sf), "residual_raw", 70, (0.01, 0.99))
    return h.select("bin", rnd("lo", 6).alias("lo"), rnd("hi", 6).alias("hi"), "count",
                    rnd("median", 6).alias("median"))
