"""Model operators on one or two columns, where SQL can state the solution."""

from __future__ import annotations

import os
import uuid

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from hearth.functions.exprs import rnd
from hearth.operators import cluster, explain, score
from hearth.operators.folds import assign_folds, holdout_split
from hearth.operators.oof import oof_predict
from hearth.plans.q_flagship import sales_xy
from hearth.plans.q_models import _SX, one_feature
from hearth.plans.registry import query
from hearth.plans.sqlparts import SALES_CTE, fold_sql, hash_sql
from hearth.session import checkpoint_dir
from hearth.sources.bindings import sales

S = f"WITH {SALES_CTE.strip()}"


def _xy(spark, sf):
    return sales_xy(spark, sf).select("id", "x", F.col("y").alias("label"))


def _fit_sql(src: str, where: str = "true", by: str = "") -> str:
    """Ridge with penalty 12 on one standardised column: one row (per group)."""
    return (f"SELECT {by} AVG(x) AS mx, AVG(y) AS my, stddev_pop(x) AS sx, COUNT(*) * covar_pop(x, y) / stddev_pop(x) / (COUNT(*) + 12.0) AS c "
            f"FROM {src} WHERE {where}")


@query("g3_fold_avg_one_feature", f"""{_SX},
d AS (SELECT *, {fold_sql('id', 3, 42)} AS fold, {hash_sql('id', 7)} % 100 < 20 AS test FROM sx),
f AS ({" UNION ALL ".join(_fit_sql("d", f"NOT test AND fold <> {k}") for k in range(3))})
SELECT id, round(AVG(my + c * (x - mx) / sx), 8) AS pred_log FROM d, f WHERE test GROUP BY id
""")
def _g3(spark, sf):
    train, test = holdout_split(assign_folds(_xy(spark, sf), "id", 3, 42), "id", 0.2, 7)
    _oof, averaged, _m = oof_predict(train, one_feature(12.0), "fold", "id", 3, test=test)
    return averaged.select("id", rnd("pred_log", 8).alias("pred_log"))


@query("i1_score_one_feature", f"""{_SX},
d AS (SELECT sx.*, yr_built FROM sx JOIN sales USING (id)),
f AS ({_fit_sql("d", "yr_built < 1998")})
SELECT id, round(my + c * (x - mx) / sx, 8) AS pred_log, 'ridge/2025-01-01_000000' AS model_id FROM d, f WHERE yr_built >= 1998
""")
def _i1(spark, sf):
    from hearth.sources.io import load_model, save_model
    d = _xy(spark, sf).join(sales(spark, sf).select("id", "yr_built"), "id")
    root = os.path.join(checkpoint_dir(spark), f"models-{uuid.uuid4().hex}")
    path = save_model(one_feature(12.0)().fit(d.filter("yr_built < 1998")), root, "ridge", "2025-01-01_000000")
    told = score.score_batch(load_model(path), d.filter("yr_built >= 1998"), ["x"], "id", "ridge/2025-01-01_000000")
    return told.select("id", rnd("pred_log", 8).alias("pred_log"), "model_id")


@query("m11_pca_two_columns", f"""{S},
r AS (SELECT abs(corr(ext, acctbal)) AS r FROM (SELECT coalesce(ext, 0.0) AS ext, coalesce(acctbal, 0.0) AS acctbal FROM sales))
SELECT 1 AS component, round((1 + r) / 2, 8) AS explained_variance FROM r UNION ALL SELECT 2, round((1 - r) / 2, 8) FROM r
""")
def _m11(spark, sf):
    _proj, var = cluster.pca(sales(spark, sf), ["ext", "acctbal"], "id", k=2)
    return var.select("component", rnd("explained_variance", 8).alias("explained_variance"))


def _fitted(spark, sf):
    return one_feature(12.0)().fit(_xy(spark, sf)).stages[-1]


@query("n1_importance_one_feature", f"""{_SX}, f AS ({_fit_sql("sx")})
SELECT 'x' AS feature, round(abs(c), 8) AS importance FROM f
""")
def _n1(spark, sf):
    return explain.importance(spark, _fitted(spark, sf), ["x"]).select("feature", rnd("importance", 8).alias("importance"))


@query("n5_signed_one_feature", f"""{_SX}, f AS ({_fit_sql("sx")})
SELECT 'x' AS feature, round(c, 8) AS coefficient, round(abs(c), 8) AS magnitude,
       CASE WHEN c > 0 THEN 'positive' WHEN c < 0 THEN 'negative' ELSE 'zero' END AS sign FROM f
""")
def _n5(spark, sf):
    c = explain.signed_coefficients(spark, _fitted(spark, sf), ["x"])
    return c.select("feature", rnd("coefficient", 8).alias("coefficient"), rnd("magnitude", 8).alias("magnitude"), "sign")


@query("n6_ols_one_regressor", f"""{_SX},
m AS (SELECT COUNT(*) AS n, AVG(x) AS mx, regr_slope(y, x) AS b, regr_intercept(y, x) AS a, regr_sxx(y, x) AS sxx FROM sx),
e AS (SELECT ANY_VALUE(n) AS n, ANY_VALUE(mx) AS mx, ANY_VALUE(a) AS a, ANY_VALUE(b) AS b, ANY_VALUE(sxx) AS sxx,
             SUM(power(y - a - b * x, 2)) / (ANY_VALUE(n) - 2) AS s2 FROM sx, m),
o AS (SELECT 'x' AS feature, b AS c, sqrt(s2 / sxx) AS se FROM e
      UNION ALL SELECT 'intercept', a, sqrt(s2 * (1.0 / n + mx * mx / sxx)) FROM e)
SELECT feature, round(c, 6) AS coefficient, round(se, 6) AS std_error, round(c / se, 4) AS t_value FROM o
""")
def _n6(spark, sf):
    v = VectorAssembler(inputCols=["x"], outputCol="features").transform(_xy(spark, sf))
    o = explain.ols_inference(v, "features", "label")
    return o.select(F.when(F.col("feature") == "intercept", "intercept").otherwise("x").alias("feature"),
                    rnd("coefficient", 6).alias("coefficient"), rnd("std_error", 6).alias("std_error"), rnd("t_value", 4).alias("t_value"))


REPEATS = 8


def _n7_sql() -> str:
    parts = []
    for r in range(REPEATS):
        a, b = (f"(SELECT *, row_number() OVER (ORDER BY {hash_sql('id', 42_000 + 2 * r + s)}, id) AS i FROM h)" for s in (0, 1))
        parts.append(f"SELECT sqrt(AVG(power(p.y - p.pred - c * (q.x - p.x) / sx, 2))) - (SELECT e FROM base) AS up FROM {a} p JOIN {b} q USING (i), f")
    return f"""{_SX},
d AS (SELECT *, {hash_sql('id')} % 100 < 20 AS hold FROM sx),
f AS ({_fit_sql("d", "NOT hold")}),
h AS (SELECT id, x, y, my + c * (x - mx) / sx AS pred FROM d, f WHERE hold),
base AS (SELECT sqrt(AVG(power(y - pred, 2))) AS e FROM h),
up AS ({" UNION ALL ".join(parts)})
SELECT 'x' AS feature, round(AVG(up), 8) AS importance_mean, round(stddev_pop(up), 8) AS importance_std FROM up"""


@query("n7_permutation_one_feature", _n7_sql())
def _n7(spark, sf):
    train, hold = holdout_split(_xy(spark, sf), "id", 0.2, 42)
    m = one_feature(12.0)().fit(train)
    h = m.stages[1].transform(m.stages[0].transform(hold))
    out = explain.permutation_importance(h, m.stages[-1], ["x"], "id", repeats=REPEATS)
    return out.select("feature", rnd("importance_mean", 8).alias("importance_mean"), rnd("importance_std", 8).alias("importance_std"))
