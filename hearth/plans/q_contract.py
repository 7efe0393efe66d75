"""Contract / gate plans (J1-J6) and sampling plans (O1, O2)."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from hearth.functions.exprs import rnd
from hearth.operators import contract as ct
from hearth.operators.folds import sample_n, stratified_sample
from hearth.operators.oof import fold_summary
from hearth.plans.q_flagship import PRED_SQL, predictions
from hearth.plans.registry import query
from hearth.plans.sqlparts import SALES_CTE, hash_sql, quantiles_sql, rc_bin_sql
from hearth.session import checkpoint_dir
from hearth.sources.bindings import sales, sales_split

S = f"WITH {SALES_CTE.strip()}"
P = f"WITH {PRED_SQL.strip()}"


@query("j1_pick_golden_rows", f"""{S}
SELECT id, price, nbhd FROM sales ORDER BY {hash_sql('id')}, id LIMIT 12
""")
def _j1(spark, sf):
    return ct.pick_golden_rows(sales(spark, sf), "id", 12, 42).select("id", "price", "nbhd")


GOLD_SQL = f"""{P},
gold AS (SELECT id FROM sales ORDER BY {hash_sql('id')}, id LIMIT 12),
b AS (SELECT p.id, p.pred_log AS pred, p.pred_log - (abs(p.pred_log) * 0.01 + 0.005) AS pred_lo,
             p.pred_log + (abs(p.pred_log) * 0.01 + 0.005) AS pred_hi
      FROM preds p JOIN gold g ON p.id = g.id WHERE p.model = 'ridge_ext')"""


def _bounds(spark, sf):
    gold = ct.pick_golden_rows(sales(spark, sf), "id", 12, 42).select("id")
    p = predictions(spark, sf).filter(F.col("model") == "ridge_ext").join(gold, "id")
    return ct.contract_bounds(p.select("id", F.col("pred_log").alias("pred")), "pred", "ridge")


@query("j2_make_contract", f"""{GOLD_SQL}
SELECT id, round(pred, 9) AS pred, round(pred_lo, 9) AS pred_lo, round(pred_hi, 9) AS pred_hi FROM b
""")
def _j2(spark, sf):
    b = _bounds(spark, sf)
    return b.select("id", *[rnd(c, 9).alias(c) for c in ("pred", "pred_lo", "pred_hi")])


@query("j2_contract_document")
def _j2d(spark, sf):
    s = sales(spark, sf)
    gold = ct.pick_golden_rows(s, "id", 12, 42)
    p = predictions(spark, sf).filter(F.col("model") == "ridge_ext")
    feats = ["id", "qty", "ext", "nbhd", "quality"]
    doc = ct.make_contract(gold, p, "id", "pred_log", "ridge", feats, 42, 12)
    path = os.path.join(checkpoint_dir(spark), "contracts", "ridge_contract")
    doc.coalesce(1).write.mode("overwrite").json(path)
    back = spark.read.json(path)
    return ct.contract_rows(back, "id").select("pos", "id", rnd("pred_lo", 9).alias("pred_lo"),
                                               rnd("pred_hi", 9).alias("pred_hi"))


@query("j3_check_contract", f"""{GOLD_SQL},
r AS (SELECT b.id, q.pred_log AS pred, b.pred_lo, b.pred_hi,
             coalesce(q.pred_log >= b.pred_lo AND q.pred_log <= b.pred_hi, false) AS pass
      FROM b JOIN preds q ON b.id = q.id AND q.model = 'ridge_qty')
SELECT round(AVG(CAST(pass AS DOUBLE)), 9) AS pass_rate, COUNT(CASE WHEN NOT pass THEN 1 END) AS failed_rows,
       COUNT(*) AS rows, round(quantile_cont(pred_hi - pred_lo, 0.5), 9) AS median_band_width,
       CASE WHEN AVG(CAST(pass AS DOUBLE)) = 1.0 THEN 'pass'
            WHEN AVG(CAST(pass AS DOUBLE)) >= 0.8 THEN 'partial' ELSE 'fail' END AS verdict
FROM r
""")
def _j3(spark, sf):
    b = _bounds(spark, sf)
    q = predictions(spark, sf).filter(F.col("model") == "ridge_qty")
    _rows, summary = ct.check_contract(b, q, "id", "pred_log")
    return summary.select(rnd("pass_rate", 9).alias("pass_rate"), "failed_rows", "rows",
                          rnd("median_band_width", 9).alias("median_band_width"), "verdict")


@query("j3_check_contract_rows", f"""{GOLD_SQL}
SELECT b.id, coalesce(q.pred_log >= b.pred_lo AND q.pred_log <= b.pred_hi, false) AS pass,
       round(exp(q.pred_log) - 1, 4) AS pred_price
FROM b JOIN preds q ON b.id = q.id AND q.model = 'seg_mean'
""")
def _j3r(spark, sf):
    b = _bounds(spark, sf)
    q = predictions(spark, sf).filter(F.col("model") == "seg_mean")
    rows, _s = ct.check_contract(b, q, "id", "pred_log")
    return rows.select("id", "pass", rnd("pred_price", 4).alias("pred_price"))


@query("j4_rmse_gate", f"""{P},
r AS (SELECT p.model, sqrt(AVG((p.pred_log - ln(1 + s.price)) * (p.pred_log - ln(1 + s.price)))) AS rmse
      FROM preds p JOIN sales s ON p.id = s.id GROUP BY p.model)
SELECT r.model, round(r.rmse, 9) AS new_rmse, round(b.rmse, 9) AS baseline_rmse,
       r.rmse <= b.rmse + 0.01 AS passed
FROM r, (SELECT rmse FROM r WHERE model = 'ridge_qty') b
""")
def _j4(spark, sf):
    p = predictions(spark, sf)
    y = sales(spark, sf).select("id", F.log1p("price").alias("y"))
    s = fold_summary(p.join(y, "id"), "y", "pred_log", "fold", by=["model"]) \
        .select("model", F.col("oof_rmse").alias("rmse"))
    base = s.filter(F.col("model") == "ridge_qty").select(F.lit(1).alias("_j"), "rmse")
    new = s.withColumn("_j", F.lit(1))
    g = ct.rmse_gate(new, base, on="_j", tolerance=0.01)
    return g.select("model", rnd("new_rmse", 9).alias("new_rmse"),
                    rnd("baseline_rmse", 9).alias("baseline_rmse"), "passed")


@query("j5_reload_consistency", f"""WITH {SALES_CTE.strip()}
SELECT 0.0::DOUBLE AS max_abs_diff, COUNT(*) AS rows, true AS consistent FROM sales WHERE yr_built >= 1998
""")
def _j5(spark, sf):
    from hearth.plans.q_score import _fit_ridge
    from hearth.sources.io import load_model, save_model
    ref, cur = sales_split(spark, sf)
    model, _feats = _fit_ridge(ref)
    before = model.transform(cur)
    path = save_model(model, os.path.join(checkpoint_dir(spark), "models"), "ridge_j5",
                      "2025-01-02_000000")
    after = load_model(path).transform(cur)
    return ct.reload_consistency(before, after, "id", "prediction", 1e-12)


def _reloaded(spark, sf, name, fit):
    """J5 of a composite model: fitted on four fifths, scored before and after save and load."""
    from hearth.operators.folds import assign_folds, holdout_split
    from hearth.plans.q_models import model_frame
    from hearth.sources.io import load_model, save_model
    d = assign_folds(model_frame(spark, sf), "id", 3, 42)
    train, hold = holdout_split(d, "id", 0.2, 42)
    model = fit(d, train)
    path = save_model(model, os.path.join(checkpoint_dir(spark), "models"), name, "2025-01-02_000000")
    return ct.reload_consistency(model.transform(hold), load_model(path).transform(hold), "id", "prediction", 1e-6)


_RELOADED_SQL = f"""WITH {SALES_CTE.strip()}
SELECT 0.0::DOUBLE AS max_abs_diff, COUNT(*) AS rows, true AS consistent
FROM sales WHERE {hash_sql('id')} % 100 < 20
"""


@query("j5_reload_voting", _RELOADED_SQL)
def _j5_voting(spark, sf):
    from hearth.operators import models
    from hearth.plans.q_models import pipe
    return _reloaded(spark, sf, "voting_j5", lambda d, train: models.VotingMean([
        pipe(d, lambda: models.ridge(6.0), True), pipe(d, lambda: models.extra_trees(5, max_depth=4), False)]).fit(train))


@query("j5_reload_stacking", _RELOADED_SQL)
def _j5_stacking(spark, sf):
    from hearth.operators import models
    from hearth.plans.q_models import pipe
    return _reloaded(spark, sf, "stacking_j5", lambda d, train: models.Stacking([
        pipe(d, lambda: models.ridge(12.0), True), pipe(d, lambda: models.boosted_depth(5, step=0.1), False)], "id", "fold", k=3).fit(train))


@query("j6_detect_log_space", f"""{P},
t AS (SELECT quantile_cont(price, 0.5) AS tm FROM sales)
SELECT model, round(quantile_cont(pred_log, 0.5), 9) AS pred_median, round(MAX(t.tm), 3) AS target_median,
       coalesce(quantile_cont(pred_log, 0.5) BETWEEN 6.0 AND 16.0 AND MAX(t.tm) > 1000, true) AS is_log_space
FROM preds, t GROUP BY model
""")
def _j6(spark, sf):
    d = ct.detect_log_space(predictions(spark, sf), "pred_log", sales(spark, sf), "price",
                            by=["model"])
    return d.select("model", rnd("pred_median", 9).alias("pred_median"),
                    rnd("target_median", 3).alias("target_median"), "is_log_space")


@query("o1_stratified_sample", f"""{S},
v AS (SELECT * FROM sales WHERE price IS NOT NULL),
e AS (SELECT {quantiles_sql('price', 10)} AS edges, COUNT(*) AS rows FROM v),
bn AS (SELECT v.*, {rc_bin_sql('price', 'e.edges')} AS bin, least(800, e.rows) AS take, e.rows
       FROM v, e),
sz AS (SELECT bin, COUNT(*) AS size, MAX(take) AS take, MAX(rows) AS rows FROM bn GROUP BY bin),
al AS (SELECT bin, floor(take * size / rows) AS fl, take * size / rows - floor(take * size / rows) AS frac,
              take FROM sz),
al2 AS (SELECT bin, fl + CASE WHEN row_number() OVER (ORDER BY frac DESC, bin) <=
                     take - SUM(fl) OVER () THEN 1 ELSE 0 END AS nb FROM al),
rk AS (SELECT bn.id, bn.price, bn.bin,
              row_number() OVER (PARTITION BY bn.bin ORDER BY {hash_sql('bn.id')}, bn.id) AS r FROM bn)
SELECT rk.id, rk.price FROM rk JOIN al2 ON rk.bin = al2.bin WHERE rk.r <= al2.nb
""")
def _o1(spark, sf):
    return stratified_sample(sales(spark, sf), "id", "price", 800, 10, 42).select("id", "price")


@query("o2_sample_n", f"""{S}
SELECT id, nbhd, segment FROM sales ORDER BY {hash_sql('id')}, id LIMIT 400
""")
def _o2(spark, sf):
    return sample_n(sales(spark, sf), "id", 400, 42, drop=["price"]).select("id", "nbhd", "segment")
