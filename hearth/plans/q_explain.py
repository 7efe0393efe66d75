"""Interpretation plans."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from hearth.functions.exprs import rnd
from hearth.operators import encode, explain, models
from hearth.operators.folds import assign_folds, holdout_split
from hearth.plans.q_models import model_frame, pipe, prep
from hearth.plans.registry import query
from hearth.plans.sqlparts import RUNS_CTE, SALES_CTE
from hearth.sources.bindings import runs as runs_binding
from hearth.sources.bindings import sales, sales_split

NUM = ["qty", "ext", "n_lines", "disc", "acctbal", "quality"]
SPLIT = f"""WITH {SALES_CTE.strip()},
ref AS (SELECT * FROM sales WHERE yr_built < 1998),
cur AS (SELECT * FROM sales WHERE yr_built >= 1998)"""


def _fitted(spark, sf, est, linear=True):
    d = model_frame(spark, sf)
    m = pipe(d, est, linear)().fit(d)
    feats = m.transform(d.limit(1))
    return m, explain.slot_names(feats, "features")


@query("n1_importance_linear")
def _n1(spark, sf):
    m, names = _fitted(spark, sf, lambda: models.ridge(12.0))
    imp = explain.importance(spark, m.stages[-1], names)
    return imp.select("feature", (F.col("importance") >= 0).alias("non_negative"))


@query("n1_importance_trees", f"""WITH {SALES_CTE.strip()}
SELECT 6 + COUNT(DISTINCT segment) + COUNT(DISTINCT priority) AS slots, 1.0::DOUBLE AS total_importance FROM sales
""")
def _n1t(spark, sf):
    m, names = _fitted(spark, sf, lambda: models.extra_trees(10, max_depth=5), linear=False)
    imp = explain.importance(spark, m.stages[-1], names)
    return imp.agg(F.count(F.lit(1)).alias("slots"),
                   F.round(F.sum("importance"), 6).alias("total_importance"))


def _member_imps(spark, sf):
    ref, cur = sales_split(spark, sf)
    from hearth.operators.profile import pearson
    a = pearson(ref, NUM, "price").select(F.lit("ref").alias("member"), "feature",
                                          F.abs("pearson").alias("importance"))
    b = pearson(cur, NUM, "price").select(F.lit("cur").alias("member"), "feature",
                                          F.abs("pearson").alias("importance"))
    w = spark.createDataFrame([("ref", 1.0), ("cur", 3.0)], "member string, weight double")
    return a.unionByName(b), w


def _corr_sql(src: str, member: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{member}' AS member, '{c}' AS feature, abs(corr({c}, price)) AS importance "
        f"FROM {src} WHERE {c} IS NOT NULL AND price IS NOT NULL" for c in NUM)


VOTE_SQL = f"""{SPLIT},
imp AS ({_corr_sql('ref', 'ref')} UNION ALL {_corr_sql('cur', 'cur')}),
w AS (SELECT * FROM (VALUES ('ref', 1.0::DOUBLE), ('cur', 3.0::DOUBLE)) v(member, weight)),
vi AS (SELECT feature, SUM(weight * importance) / SUM(weight) AS importance
       FROM imp JOIN w ON imp.member = w.member GROUP BY feature)"""


@query("n2_voting_importance", f"""{VOTE_SQL}
SELECT feature, round(importance, 9) AS importance FROM vi
""")
def _n2(spark, sf):
    imps, w = _member_imps(spark, sf)
    v = explain.voting_importance(imps, w)
    return v.select("feature", rnd("importance", 9).alias("importance"))


@query("n3_stacking_importance")
def _n3(spark, sf):
    d = assign_folds(model_frame(spark, sf), "id", 3, 42)
    bases = [pipe(d, lambda: models.ridge(12.0), True),
             pipe(d, lambda: models.boosted_depth(8, step=0.1), False)]
    m = models.Stacking(bases, "id", "fold", k=3).fit(d)
    imp = explain.stacking_importance(spark, m.meta, ["ridge", "xgb"])
    return imp.select("feature", (F.col("importance") >= 0).alias("non_negative"))


@query("n4_top_features", f"""{VOTE_SQL}
SELECT feature, round(importance, 9) AS importance FROM vi
ORDER BY abs(importance) DESC, feature LIMIT 3
""")
def _n4(spark, sf):
    imps, w = _member_imps(spark, sf)
    t = explain.top_features(explain.voting_importance(imps, w), 3)
    return t.select("feature", rnd("importance", 9).alias("importance"))


@query("n4_newest_reports", f"""WITH {RUNS_CTE.strip()},
r AS (SELECT model, run_id AS report, try_strptime(run_id, '%Y-%m-%d_%H%M%S') AS created_at FROM runs)
SELECT model, report FROM (
  SELECT *, row_number() OVER (PARTITION BY model ORDER BY created_at DESC NULLS LAST) AS rn FROM r
  WHERE created_at IS NOT NULL) WHERE rn = 1
""")
def _n4r(spark, sf):
    from hearth.operators.registry import run_ts
    r = runs_binding(spark, sf).select("model", F.col("run_id").alias("report"),
                                       run_ts(F.col("run_id")).alias("created_at"))
    return explain.newest_reports(r.filter(F.col("created_at").isNotNull())).select(
        "model", "report")


@query("n5_signed_coefficients")
def _n5(spark, sf):
    m, names = _fitted(spark, sf, lambda: models.ridge(12.0))
    c = explain.signed_coefficients(spark, m.stages[-1], names)
    return c.select("feature", "sign", (F.col("magnitude") >= 0).alias("ok"))


@query("n6_ols_inference")
def _n6(spark, sf):
    s = sales(spark, sf).select("id", "price", "ext", "quality", "acctbal", "segment")
    s = s.dropna()
    lv = encode.dummy_levels(s, ["segment"])["segment"][1:]  # drop-first: full rank
    x = s.select("price", "ext", "quality", "acctbal",
                 *[(F.col("segment") == v).cast("double").alias(f"segment_{v}") for v in lv])
    feats = [c for c in x.columns if c != "price"]
    v = VectorAssembler(inputCols=feats, outputCol="features").transform(x)
    o = explain.ols_inference(v, "features", "price")
    return o.select("feature", (F.col("p_value").between(0, 1)).alias("valid_p"),
                    (F.col("std_error") > 0).alias("positive_se"))


@query("n7_permutation_importance")
def _n7(spark, sf):
    d = model_frame(spark, sf)
    train, hold = holdout_split(d, "id", 0.2, 42)
    pm = Pipeline(stages=prep(d, True)).fit(train)
    tr, ho = pm.transform(train), pm.transform(hold)
    lm = models.ridge(12.0).fit(tr)
    names = explain.slot_names(ho, "features")
    out = explain.permutation_importance(ho, lm, names, "id", repeats=3)
    return out.select("feature", (F.col("importance_std") >= 0).alias("finite"))


FIELDS = {"qty": "Total quantity of the order.", "ext": "Extended price of the order.",
          "segment": "Market segment of the customer.", "status": "Order status code.",
          "quality": "Quality code from 1 to 10.", "priority": "Order priority."}


def _names_df(spark, sf):
    s = sales(spark, sf)
    a = s.select(F.concat(F.lit("cat__segment_"), F.col("segment")).alias("feature"))
    b = s.select(F.concat(F.lit("cat__status_"), F.col("status")).alias("feature"))
    c = s.select(F.concat(F.lit("p__q__priority_"), F.col("priority")).alias("feature"))
    fixed = spark.createDataFrame(
        [(x,) for x in ["num__qty", "a___b", "ext_log", "acctbal_log", "HouseAge", "HasSauna", "IsCorner",
                        "AreaBin", "other", "Kitchen_TA", "Central_Y", "quality"]],
        "feature string")
    return a.unionByName(b).unionByName(c).filter(F.col("feature").isNotNull()).distinct() \
        .unionByName(fixed)


def _case(d: dict, key: str) -> str:
    whens = " ".join("WHEN " + repr(k) + " THEN " + repr(v) for k, v in d.items())
    return f"(CASE {key} {whens} END)"


def _n8_sql() -> str:
    names = ", ".join(f"('{x}')" for x in ["num__qty", "a___b", "ext_log", "acctbal_log", "HouseAge",
                                            "HasSauna", "IsCorner", "AreaBin", "other",
                                            "Kitchen_TA", "Central_Y", "quality"])
    fd_s, fd_f, fd_b = _case(FIELDS, "s"), _case(FIELDS, "field"), _case(FIELDS, "base")
    eng = _case(explain.FeatureSpec().formulas(), "s")
    ql, yn = _case(explain.QUALITY_LEVEL, "level"), _case(explain.YESNO_LEVEL, "level")
    return f"""WITH {SALES_CTE.strip()},
nm AS (SELECT DISTINCT 'cat__segment_' || segment AS feature FROM sales WHERE segment IS NOT NULL
       UNION SELECT DISTINCT 'cat__status_' || status FROM sales WHERE status IS NOT NULL
       UNION SELECT DISTINCT 'p__q__priority_' || priority FROM sales WHERE priority IS NOT NULL
       UNION ALL SELECT * FROM (VALUES {names}) v(feature)),
a AS (SELECT feature, regexp_replace(feature, '^(?:.*?__)+', '') AS s FROM nm),
b AS (SELECT feature, s, regexp_replace(s, '_log$', '') AS base, split_part(s, '_', 1) AS field,
             substr(s, instr(s, '_') + 1) AS level FROM a)
SELECT feature, CASE
  WHEN {eng} IS NOT NULL THEN s || ' = ' || {eng}
  WHEN ends_with(s, '_log') THEN 'log1p of ' || base || coalesce(': ' || {fd_b}, '')
  WHEN contains(s, '_') THEN CASE WHEN {fd_f} IS NULL THEN 'indicator ' || s
       ELSE field || ' is ' || level || coalesce(' (' || coalesce({ql}, {yn}) || ')', '') || ': ' || {fd_f} END
  WHEN {fd_s} IS NOT NULL THEN {fd_s}
  WHEN starts_with(s, 'Has') OR starts_with(s, 'Is') THEN 'flag ' || s
  WHEN ends_with(s, 'Bin') THEN 'bucket ' || s
  ELSE 'column ' || s END AS description
FROM b"""


@query("n8_describe_features", _n8_sql())
def _n8(spark, sf):
    return explain.describe_features(_names_df(spark, sf), FIELDS)
