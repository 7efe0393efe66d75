"""Scoring plans."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from hearth.functions.exprs import rnd
from hearth.operators.impute import medians
from hearth.operators import profile, registry, score, search
from hearth.plans.q_flagship import ERR_SQL, oof_errors
from hearth.plans.q_models import _search_ctes, one_feature
from hearth.plans.registry import query
from hearth.plans.sqlparts import SALES_CTE
from hearth.session import checkpoint_dir, cut_lineage
from hearth.sources.bindings import sales, sales_split

SPLIT = f"""WITH {SALES_CTE.strip()},
ref AS (SELECT * FROM sales WHERE yr_built < 1998),
cur AS (SELECT * FROM sales WHERE yr_built >= 1998)"""
KEYS = ["ext", "qty", "acctbal", "quality", "n_lines"]


def _fit_ridge(train):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    from hearth.operators.encode import PopulationScaler
    from hearth.operators.impute import MedianImputer
    feats = ["ext", "qty", "acctbal", "quality"]
    d = train.withColumn("label", F.log1p("price"))
    pipe = Pipeline(stages=[MedianImputer(inputCols=feats), PopulationScaler(inputCols=feats),
                            VectorAssembler(inputCols=feats, outputCol="features"),
                            LinearRegression(regParam=0.01, elasticNetParam=0.0, solver="normal",
                                             standardization=False)])
    return pipe.fit(d), feats


@query("i1_score_batch")
def _i1(spark, sf):
    from hearth.sources.io import load_model, save_model
    ref, cur = sales_split(spark, sf)
    model, feats = _fit_ridge(ref)
    root = os.path.join(checkpoint_dir(spark), "models")
    path = save_model(model, root, "ridge", "2025-01-01_000000")
    loaded = load_model(path)
    return score.score_batch(loaded, cur.drop("price"), feats, "id", "ridge/2025-01-01_000000")


@query("i2_score_lineage")
def _i2(spark, sf):
    """All columns of the rows to score enter the fingerprint; the run is trained, registered and resolved here."""
    d, aliases, runs = _trained(spark, sf)
    _told, lineage = score.score_requests(d.drop("label").withColumn("model_id", F.lit("global/best")), "id", "model_id", runs, aliases)
    return lineage.drop("scored_at", "model_path")


# runs of two families: (family, run, ridge penalty), in the order of their registration
TRAINED = [("ridge", "2025-06-01_120000", 500.0), ("ridge", "2025-06-02_120000", 1.0), ("heavy", "2025-06-03_120000", 5000.0)]
# what the rows ask for, by id modulo 8; the last is NULL
ASKED = ["global/best", "ridge/best", "ridge/latest", "ridge/2025-06-01_120000", "global/latest", "heavy/production", "ridge/nope"]


def _trained(spark, sf):
    """Three registered runs of a one-feature ridge on ``quality``: (rows, current aliases, runs)."""
    d = cut_lineage(sales(spark, sf).select("id", F.col("quality").alias("x"), F.log1p("price").alias("label")))
    root = os.path.join(checkpoint_dir(spark), f"registry-{uuid.uuid4().hex}")
    for family, run_id, alpha in TRAINED:
        search.train_run(spark, d, one_feature(alpha), family, "id", "label", 3, 42, root, run_id, ["x"])
    return d, registry.current_aliases(registry.read_events(spark, root)), registry.read_runs(spark, root)


def _asked(d):
    by = F.expr("id % 8")
    ask = F.lit(None).cast("string")
    for i, a in enumerate(ASKED):
        ask = F.when(by == i, F.lit(a)).otherwise(ask)
    return d.select("id", "x", ask.alias("model_id"))


REQUESTS_SQL = f"""WITH {SALES_CTE.strip()},
sx AS (SELECT id, quality AS x, ln(1 + price) AS y FROM sales),
{_search_ctes("det", (42,), 3, {f"r{i}": a for i, (_f, _r, a) in enumerate(TRAINED)})},
t AS (SELECT v.model, v.run_id, v.alpha, det.cv_rmse FROM det JOIN (VALUES
      {", ".join(f"('r{i}', '{f}', '{r}', {a})" for i, (f, r, a) in enumerate(TRAINED))}) v(candidate, model, run_id, alpha) ON det.candidate = v.candidate),
al AS (SELECT 'global/best' AS request, arg_min(model || '/' || run_id, cv_rmse) AS model_id FROM t
       UNION ALL SELECT 'global/latest', arg_max(model || '/' || run_id, run_id) FROM t
       UNION ALL SELECT model || '/best', arg_min(model || '/' || run_id, cv_rmse) FROM t GROUP BY model
       UNION ALL SELECT model || '/latest', arg_max(model || '/' || run_id, run_id) FROM t GROUP BY model
       UNION ALL SELECT model || '/' || run_id, model || '/' || run_id FROM t),
rows_ AS (SELECT id, x, CASE id % 8 {" ".join(f"WHEN {i} THEN '{a}'" for i, a in enumerate(ASKED))} END AS request FROM sx),
told AS (SELECT rows_.*, al.model_id, CASE WHEN al.model_id IS NOT NULL THEN 'ok' WHEN request IS NULL THEN 'malformed'
                WHEN request = 'heavy/production' THEN 'unset' ELSE 'unknown_run' END AS status
         FROM rows_ LEFT JOIN al USING (request))"""


@query("i1_score_requests", f"""{REQUESTS_SQL},
m AS (SELECT t.model || '/' || t.run_id AS model_id, mx, my, sx, n * cxy / sx / (n + alpha) AS c
      FROM t, (SELECT COUNT(*) AS n, AVG(x) AS mx, AVG(y) AS my, stddev_pop(x) AS sx, covar_pop(x, y) AS cxy FROM sx))
SELECT id, request AS requested_model_id, told.model_id, round(my + c * (x - mx) / sx, 8) AS pred_log, status
FROM told LEFT JOIN m USING (model_id)
""")
def _i1r(spark, sf):
    d, aliases, runs = _trained(spark, sf)
    told, _lineage = score.score_requests(_asked(d), "id", "model_id", runs, aliases)
    return told.select("id", "requested_model_id", "model_id", rnd("pred_log", 8).alias("pred_log"), "status")


@query("i2_lineage_of_requests", f"""{REQUESTS_SQL},
h AS (SELECT *, row_number() OVER (PARTITION BY request ORDER BY id) AS n FROM told)
SELECT request AS requested_model_id, any_value(model_id) AS resolved_model_id, any_value(status) AS status, COUNT(*) AS input_rows,
       md5(string_agg(id || '|' || x || '|' || coalesce(request, ''), chr(10) ORDER BY n) FILTER (WHERE n <= 200)) AS input_head_md5,
       any_value('models/' || model_id || '/model') AS model_path
FROM h GROUP BY request
""")
def _i2r(spark, sf):
    d, aliases, runs = _trained(spark, sf)
    _told, lineage = score.score_requests(_asked(d), "id", "model_id", runs, aliases)
    return lineage.select("requested_model_id", "resolved_model_id", "status", "input_rows", "input_head_md5",
                          F.regexp_extract("model_path", "models/.*$", 0).alias("model_path"))


def _prof_sql(src: str = "ref") -> str:
    parts = []
    for k in KEYS:
        x = f"CAST({k} AS DOUBLE)"
        parts.append(f"SELECT '{k}' AS feature, quantile_cont({x}, 0.05) AS p05, "
                     f"quantile_cont({x}, 0.5) AS p50, quantile_cont({x}, 0.95) AS p95, "
                     f"greatest(quantile_cont({x}, 0.75) - quantile_cont({x}, 0.25), 1e-9) AS iqr, "
                     f"COUNT({x}) AS n FROM {src}")
    return " UNION ALL ".join(parts)


@query("i3_feature_profile", f"""{SPLIT},
p AS ({_prof_sql()})
SELECT feature, round(p05, 4) AS p05, round(p50, 4) AS p50, round(p95, 4) AS p95,
       round(iqr, 4) AS iqr FROM p WHERE n >= 20
""")
def _i3(spark, sf):
    ref, _cur = sales_split(spark, sf)
    p = profile.feature_profile(ref, KEYS)
    return p.select("feature", *[rnd(c, 4).alias(c) for c in ("p05", "p50", "p95", "iqr")])


def _i4_sql() -> str:
    pens, used, reasons, joins = [], [], [], []
    for i, k in enumerate(KEYS):
        a = f"p{i}"
        joins.append(f"(SELECT * FROM p WHERE feature = '{k}') {a}")
        v = f"CAST(c.{k} AS DOUBLE)"
        present = f"({a}.feature IS NOT NULL AND {v} IS NOT NULL)"
        pens.append(f"CASE WHEN {present} AND {v} < {a}.p05 THEN least(18.0, 8.0 + 10.0 * ({a}.p05 - {v}) / {a}.iqr) "
                    f"WHEN {present} AND {v} > {a}.p95 THEN least(18.0, 8.0 + 10.0 * ({v} - {a}.p95) / {a}.iqr) "
                    f"ELSE 0.0 END")
        used.append(f"CAST({present} AS INTEGER)")
        reasons.append(f"CASE WHEN {present} AND {v} < {a}.p05 THEN '{k} under p05 ' || printf('%.1f', {a}.p05) "
                       f"WHEN {present} AND {v} > {a}.p95 THEN '{k} over p95 ' || printf('%.1f', {a}.p95) END")
    return f"""{SPLIT},
p AS ({_prof_sql()}),
s AS (SELECT c.id, ({" + ".join(pens)}) AS pen, ({" + ".join(used)}) AS used,
             list_filter([{", ".join(reasons)}], lambda r: r IS NOT NULL) AS reasons
      FROM cur c, {", ".join(joins)}),
t AS (SELECT id, used, reasons,
             CASE WHEN used = 0 THEN 60 ELSE greatest(0, least(100, CAST(round_even(100.0 - pen, 0) AS INTEGER))) END AS typicality
      FROM s)
SELECT id, typicality, CASE WHEN used = 0 THEN 'Medium' WHEN typicality >= 80 THEN 'High'
       WHEN typicality >= 55 THEN 'Medium' ELSE 'Low' END AS label,
       CASE WHEN used = 0 THEN ['no usable input'] ELSE reasons END AS reasons FROM t
"""


@query("i4_typicality_score", _i4_sql())
def _i4(spark, sf):
    ref, cur = sales_split(spark, sf)
    prof = profile.feature_profile(ref, KEYS)
    d = score.typicality_score(cur, prof, KEYS, "id")
    return d.withColumn("reasons", F.transform("reasons", lambda r: F.concat_ws(
        " ", r["feature"], r["side"], F.format_string("%.1f", r["bound"]))))


D_KEYS = ["ext", "qty", "quality", "yr_built"]


@query("i5_default_distance_score", f"""{SPLIT},
d AS (SELECT {", ".join(f"quantile_cont(CAST({k} AS DOUBLE), 0.5) AS {k}" for k in D_KEYS)} FROM ref),
t AS (SELECT c.id,
        ({" + ".join(f"CASE WHEN c.{k} IS NULL THEN 0.0 ELSE least(3.0, abs(CAST(c.{k} AS DOUBLE) - d.{k}) / greatest(1.0, abs(d.{k}))) END" for k in D_KEYS)}) AS s,
        ({" + ".join(f"CAST(c.{k} IS NOT NULL AS INTEGER)" for k in D_KEYS)}) AS n
      FROM cur c, d),
u AS (SELECT id, n, CASE WHEN n = 0 THEN 60 ELSE CAST(floor(greatest(0.0, least(100.0, 100.0 * (1.0 - (s / n) / 1.5)))) AS INTEGER) END AS score FROM t)
SELECT id, score, CASE WHEN n = 0 THEN 'Medium' WHEN score >= 75 THEN 'High'
       WHEN score >= 50 THEN 'Medium' ELSE 'Low' END AS label FROM u
""")
def _i5(spark, sf):
    ref, cur = sales_split(spark, sf)
    return score.default_distance_score(cur, medians(ref, D_KEYS), D_KEYS, "id")


@query("i6_typical_range", f"""WITH {ERR_SQL.strip()},
r AS (SELECT sqrt(AVG(residual_log * residual_log)) AS rmse FROM err)
SELECT id, round(y_pred / exp(rmse), 2) AS lo, round(y_pred * exp(rmse), 2) AS hi FROM err, r
""")
def _i6(spark, sf):
    err = oof_errors(spark, sf)
    rm = err.agg(F.sqrt(F.avg(F.pow("residual_log", 2))).alias("rmse"))
    j = err.join(F.broadcast(rm), how="inner")
    lo, hi = score.typical_range(F.col("y_pred"), F.col("rmse"))
    return j.select("id", rnd(lo, 2).alias("lo"), rnd(hi, 2).alias("hi"))


@query("i7_percentile_rank", f"""{SPLIT},
rv AS (SELECT price AS v FROM ref WHERE price IS NOT NULL),
n AS (SELECT COUNT(*) AS n FROM rv)
SELECT c.id, round(100.0 * (SELECT COUNT(*) FROM rv WHERE rv.v < c.price) / n.n, 9) AS pct_rank
FROM cur c, n
""")
def _i7(spark, sf):
    ref, cur = sales_split(spark, sf)
    r = score.percentile_rank(ref, "price", cur.select("id", "price"), "price")
    return r.select("id", rnd("pct_rank", 9).alias("pct_rank"))


@query("i7_percentile_rank_ties", f"""{SPLIT},
rv AS (SELECT quality AS v FROM ref WHERE quality IS NOT NULL),
n AS (SELECT COUNT(*) AS n FROM rv)
SELECT c.id, round(100.0 * (SELECT COUNT(*) FROM rv WHERE rv.v < c.quality) / n.n, 9) AS pct_rank
FROM cur c, n
""")
def _i7t(spark, sf):
    ref, cur = sales_split(spark, sf)
    r = score.percentile_rank(ref, "quality", cur.select("id", "quality"), "quality")
    return r.select("id", rnd("pct_rank", 9).alias("pct_rank"))


@query("i8_example_rows", f"""WITH {SALES_CTE.strip()},
m AS (SELECT quantile_cont(price, 0.5) AS m FROM sales)
SELECT 'starter' AS example, id, price FROM sales ORDER BY price, id LIMIT 1)
UNION ALL (SELECT 'premium', id, price FROM sales ORDER BY price DESC, id LIMIT 1)
UNION ALL (SELECT 'typical', id, price FROM sales, m ORDER BY abs(price - m), id LIMIT 1
""".replace("SELECT 'starter'", "(SELECT 'starter'", 1) + ")")
def _i8(spark, sf):
    return score.example_rows(sales(spark, sf), "price", "id")


CODE_SQL = ("CASE WHEN quality <= 2 THEN 'Po' WHEN quality <= 4 THEN 'Fa' WHEN quality <= 6 THEN 'TA' "
            "ELSE 'Gd' END")


@query("i9_ordered_levels", f"""WITH {SALES_CTE.strip()},
c AS (SELECT DISTINCT {CODE_SQL} AS code FROM sales WHERE quality IS NOT NULL),
dom AS (SELECT * FROM (VALUES ('Po', 0, 'Poor (Po)'), ('Fa', 1, 'Fair (Fa)'),
        ('TA', 2, 'Typical/Average (TA)'), ('Gd', 3, 'Good (Gd)'), ('Ex', 4, 'Excellent (Ex)'))
        v(code, rank, label))
SELECT dom.code, dom.rank, dom.label FROM c JOIN dom ON c.code = dom.code
""")
def _i9(spark, sf):
    s = sales(spark, sf).filter(F.col("quality").isNotNull())
    code = (F.when(F.col("quality") <= 2, "Po").when(F.col("quality") <= 4, "Fa")
            .when(F.col("quality") <= 6, "TA").otherwise("Gd"))
    return score.ordered_levels(s.select(code.alias("code")), "code")
