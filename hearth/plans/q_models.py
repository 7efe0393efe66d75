"""Model, blending and search plans."""

from __future__ import annotations

import os
import uuid

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.functions.exprs import rnd
from hearth.operators import encode, models, registry, search
from hearth.operators.folds import assign_folds, holdout_split
from hearth.operators.oof import fold_summary, oof_predict
from hearth.plans.q_flagship import PRED_SQL, predictions, sales_xy
from hearth.plans.registry import query
from hearth.plans.sqlparts import SALES_CTE, fold_sql, hash_sql
from hearth.session import checkpoint_dir, cut_lineage
from hearth.sources.bindings import sales

S = f"WITH {SALES_CTE.strip()}"
P = f"WITH {PRED_SQL.strip()}"
MODEL_COLS = ["id", "qty", "ext", "n_lines", "disc", "acctbal", "quality", "segment", "priority"]


def model_frame(spark, sf) -> DataFrame:
    """Training frame for the Spark ML models: a few numeric and text
    columns plus label = log1p(price).  Written once: every imputer, indexer
    and fit reads it, instead of joining orders and lines again."""
    s = sales(spark, sf)
    return cut_lineage(s.select(*MODEL_COLS, F.log1p("price").alias("label")))


def prep(df: DataFrame, linear: bool) -> list:
    return encode.assembler(df.drop("label"), exclude=["id", "fold"], linear=linear).getStages()


def pipe(df: DataFrame, est, linear: bool = True):
    return lambda: Pipeline(stages=prep(df, linear) + [est() if callable(est) else est])


def one_feature(alpha: float, x: str = "x"):
    """Pipeline of the ridge on one standardised column, whose solution SQL can state."""
    def make():
        from pyspark.ml.feature import VectorAssembler
        return Pipeline(stages=[encode.PopulationScaler(inputCols=[x]), VectorAssembler(inputCols=[x], outputCol="features"), models.ridge(alpha)])
    return make


def _rmse(df: DataFrame, label: str = "label", pred: str = "prediction"):
    return F.sqrt(F.avg(F.pow(F.col(label) - F.col(pred), 2)))


@query("f1_ridge_one_feature", f"""{S},
d AS (SELECT ln(1 + CASE WHEN coalesce(ext, 0.0) < 0 THEN 0.0 ELSE coalesce(ext, 0.0) END) AS x,
             ln(1 + price) AS y FROM sales),
st AS (SELECT COUNT(*) AS n, AVG(y) AS my, stddev_pop(x) AS sx, covar_pop(x, y) AS cxy FROM d)
SELECT round(my, 8) AS intercept, round(n * cxy / sx / (n + 12.0), 8) AS coefficient FROM st
""")
def _f1(spark, sf):
    from pyspark.ml.feature import VectorAssembler
    d = sales_xy(spark, sf).select("x", "y")
    z = encode.PopulationScaler(inputCols=["x"]).fit(d).transform(d)
    v = VectorAssembler(inputCols=["x"], outputCol="features").transform(z)
    m = models.Ridge(alpha=12.0, labelCol="y").fit(v)
    return spark.createDataFrame([(float(m.intercept), float(m.coefficients[0]))],
                                 "intercept double, coefficient double").select(
        rnd("intercept", 8).alias("intercept"), rnd("coefficient", 8).alias("coefficient"))


def _mean_sql(extra: str, hold: str = f"{hash_sql('id')} % 100 < 20") -> str:
    """Holdout rows and the error of the training mean.  The target hardly depends on the columns,
    so a model must be near that error there, and below the mean's error on its own training rows."""
    return f"""{S},
d AS (SELECT ln(1 + price) AS y, {hold} AS hold FROM sales),
m AS (SELECT AVG(y) AS my FROM d WHERE NOT hold)
SELECT {extra} COUNT(*) AS rows, round(sqrt(AVG(power(y - my, 2))), 9) AS mean_rmse, true AS within_fifth, true AS fits_better
FROM d, m WHERE hold"""


def _against_mean(fitted: DataFrame, predicted: DataFrame, pred: str = "prediction") -> DataFrame:
    mean = fitted.agg(F.avg("label").alias("_my"), (_rmse(None, pred=pred) < F.stddev_pop("label")).alias("fits_better"))
    r = predicted.join(F.broadcast(mean)).agg(
        F.count(F.lit(1)).alias("rows"), F.sqrt(F.avg(F.pow(F.col("label") - F.col("_my"), 2))).alias("_mean"),
        _rmse(None, pred=pred).alias("_own"), F.any_value("fits_better").alias("fits_better"))
    return r.select("rows", rnd("_mean", 9).alias("mean_rmse"), F.col("_own").between(0.8 * F.col("_mean"), 1.2 * F.col("_mean")).alias("within_fifth"), "fits_better")


def _fit_eval(spark, sf, est, linear: bool, name: str):
    d = model_frame(spark, sf)
    train, hold = holdout_split(d, "id", 0.2, 42)
    m = pipe(d, est, linear)().fit(train)
    return _against_mean(m.transform(train), m.transform(hold)).select(F.lit(name).alias("model"), "*")


@query("f1_ridge_pipeline", _mean_sql("'ridge' AS model,"))
def _f1p(spark, sf):
    return _fit_eval(spark, sf, lambda: models.ridge(12.0), True, "ridge")


@query("f2_extra_trees", _mean_sql("'extratrees' AS model,"))
def _f2(spark, sf):
    return _fit_eval(spark, sf, lambda: models.extra_trees(20, max_depth=6), False, "extratrees")


@query("f3_boosted_depth", _mean_sql("'xgb' AS model,"))
def _f3(spark, sf):
    return _fit_eval(spark, sf, lambda: models.boosted_depth(15, step=0.1), False, "xgb")


@query("f4_boosted_leaf", _mean_sql("'lgbm' AS model,"))
def _f4(spark, sf):
    return _fit_eval(spark, sf, lambda: models.boosted_leaf(15, step=0.1), False, "lgbm")


@query("f5_voting_mean", _mean_sql("'voting_mean' AS model,"))
def _f5(spark, sf):
    d = model_frame(spark, sf)
    members = [pipe(d, lambda: models.ridge(6.0), True),
               pipe(d, lambda: models.extra_trees(10, max_depth=5), False),
               pipe(d, lambda: models.boosted_depth(10, step=0.1), False),
               pipe(d, lambda: models.boosted_leaf(10, step=0.1), False)]
    train, hold = holdout_split(d, "id", 0.2, 42)
    m = models.VotingMean(members).fit(train)
    return _against_mean(m.transform(train), m.transform(hold)).select(F.lit("voting_mean").alias("model"), "*")


@query("f6_stacking", _mean_sql("'stacking' AS model, 2 AS meta_coefficients,"))
def _f6(spark, sf):
    d = assign_folds(model_frame(spark, sf), "id", 3, 42)
    train, hold = holdout_split(d, "id", 0.2, 42)
    bases = [pipe(d, lambda: models.ridge(12.0), True),
             pipe(d, lambda: models.boosted_depth(10, step=0.1), False)]
    m = models.Stacking(bases, "id", "fold", k=3, meta_alpha=1.0).fit(train)
    return _against_mean(m.transform(train), m.transform(hold)).select(
        F.lit("stacking").alias("model"), F.lit(len(m.meta.coefficients)).alias("meta_coefficients"), "*")


@query("f7_blend_mean", f"""{P}
SELECT id, round(AVG(pred_log), 6) AS pred_log, COUNT(pred_log) AS n_models,
       COUNT(pred_log) = 3 AS complete FROM preds GROUP BY id
""")
def _f7(spark, sf):
    b = models.blend_mean(predictions(spark, sf), n_models=3)
    return b.select("id", rnd("pred_log", 6).alias("pred_log"), "n_models", "complete")


@query("f8_blend_weighted", f"""{P},
r AS (SELECT p.model, sqrt(AVG((p.pred_log - ln(1 + s.price)) * (p.pred_log - ln(1 + s.price)))) AS rmse
      FROM preds p JOIN sales s ON p.id = s.id GROUP BY p.model),
w AS (SELECT p.id, p.pred_log, 1.0 / greatest(coalesce(r.rmse, 1.0), 1e-12) AS w
      FROM preds p LEFT JOIN r ON p.model = r.model)
SELECT id, round(SUM(w * pred_log) / SUM(w), 6) AS pred_log FROM w GROUP BY id
""")
def _f8(spark, sf):
    p = predictions(spark, sf)
    y = sales(spark, sf).select("id", F.log1p("price").alias("y"))
    met = fold_summary(p.join(y, "id"), "y", "pred_log", by=["model"]).select(
        "model", F.col("oof_rmse").alias("rmse"))
    b = models.blend_weighted(p, met)
    return b.select("id", rnd("pred_log", 6).alias("pred_log"))


@query("f9_stack_ridge", _mean_sql("3 AS meta_coefficients,", "yr_built >= 1998"))
def _f9(spark, sf):
    p = predictions(spark, sf)
    s = sales(spark, sf).select("id", "yr_built", F.log1p("price").alias("label"))
    ref_ids = s.filter(F.col("yr_built") < 1998).select("id")
    cur_ids = s.filter(F.col("yr_built") >= 1998).select("id")
    out, meta = models.stack_ridge(p.join(ref_ids, "id"), s, p, ["ridge_ext", "ridge_qty", "seg_mean"])
    told = out.select("id", "pred_log").join(s.select("id", "label"), "id")
    return _against_mean(told.join(ref_ids, "id"), told.join(cur_ids, "id"), "pred_log").select(
        F.lit(len(meta.coefficients)).alias("meta_coefficients"), "*")


@query("f10_early_stopping", f"""{S}
SELECT round(stddev_pop(ln(1 + price)), 9) AS spread, true AS within_fifth, true AS stopped FROM sales
""")
def _f10(spark, sf):
    d = assign_folds(model_frame(spark, sf), "id", 3, 42)
    st = Pipeline(stages=prep(d, False)).fit(d)
    x = st.transform(d).select("id", "fold", "label", "features")
    per = models.early_stopping_cv(x, lambda: models.boosted_depth(30, step=0.2), "fold", 3)
    spread = d.agg(F.stddev_pop("label").alias("spread"))
    return models.summarize_iterations(per).join(F.broadcast(spread)).select(
        rnd("spread", 9).alias("spread"), F.col("rmse_mean").between(0.8 * F.col("spread"), 1.2 * F.col("spread")).alias("within_fifth"),
        F.col("best_iter_mean").between(1, 30).alias("stopped"))


@query("g3_fold_avg_predict", f"""{S}
SELECT COUNT(*) AS rows, COUNT(*) AS predicted FROM sales WHERE {hash_sql('id', 7)} % 100 < 20
""")
def _g3(spark, sf):
    d = assign_folds(model_frame(spark, sf), "id", 3, 42)
    train, test = holdout_split(d, "id", 0.2, 7)
    _oof, test_avg, _m = oof_predict(train, pipe(d, lambda: models.ridge(12.0), True), "fold",
                                     "id", 3, test=test)
    return test_avg.agg(F.count(F.lit(1)).alias("rows"),
                        F.count("pred_log").alias("predicted"))


ALPHAS = {"alpha_1": 1.0, "alpha_12": 12.0, "alpha_100": 100.0}


def _search_ctes(det: str, seeds=(42, 43), k=3, alphas=ALPHAS) -> str:
    """Tables up to ``det``: the CV error of every candidate and seed."""
    ctes, parts = [], []
    for s in seeds:
        for name, a in alphas.items():
            tag = f"{det}{s}_{name}"
            ctes.append(f"""d_{tag} AS (SELECT id, x, y, {fold_sql('id', k, s)} AS fold FROM sx),
t_{tag} AS (SELECT k.fold, COUNT(*) AS n, AVG(d.x) AS mx, AVG(d.y) AS my, stddev_pop(d.x) AS sdx,
                   covar_pop(d.x, d.y) AS cxy
            FROM (SELECT DISTINCT fold FROM d_{tag}) k JOIN d_{tag} d ON d.fold <> k.fold GROUP BY k.fold),
p_{tag} AS (SELECT d.fold, d.y - (t.my + (t.n * t.cxy / t.sdx / (t.n + {a})) * (d.x - t.mx) / t.sdx) AS r
            FROM d_{tag} d JOIN t_{tag} t ON d.fold = t.fold)""")
            parts.append(f"SELECT '{name}' AS candidate, {s} AS seed, sqrt(AVG(r * r)) AS cv_rmse "
                         f"FROM p_{tag}")
    return f"""{",".join(ctes)},
{det} AS ({" UNION ALL ".join(parts)})"""


_SX = f"""{S},
sx AS (SELECT id, ln(1 + CASE WHEN coalesce(ext, 0.0) < 0 THEN 0.0 ELSE coalesce(ext, 0.0) END) AS x,
              ln(1 + price) AS y FROM sales)"""


@query("g5_run_candidates", f"""{_SX},
{_search_ctes("det")}
SELECT candidate, round(AVG(cv_rmse), 9) AS rmse_mean, round(stddev_pop(cv_rmse), 9) AS rmse_std
FROM det GROUP BY candidate""")
def _g5(spark, sf):
    d = sales_xy(spark, sf).select("id", "x", "y")
    det = search.ridge1_candidates(d, "x", "y", "id", ALPHAS, (42, 43), 3)
    s = search.summarize_candidates(det)
    return s.select("candidate", rnd("rmse_mean", 9).alias("rmse_mean"),
                    rnd("rmse_std", 9).alias("rmse_std"))


@query("g5_run_candidates_ml", f"""{S}
SELECT candidate, round(stddev_pop(ln(1 + price)), 9) AS spread, true AS within_fifth, true AS has_text
FROM sales, (VALUES ('ridge_a6'), ('ridge_a12')) c(candidate) GROUP BY candidate
""")
def _g5ml(spark, sf):
    d = model_frame(spark, sf)
    cands = {"ridge_a6": pipe(d, lambda: models.ridge(6.0), True),
             "ridge_a12": pipe(d, lambda: models.ridge(12.0), True)}
    summ, _det, top = search.run_candidates(spark, d, "ridge", cands, (42, 43), 3, "id",
                                            top_k=1)
    spread = d.agg(F.stddev_pop("label").alias("spread"))
    return summ.join(F.broadcast(spread)).select(
        "candidate", rnd("spread", 9).alias("spread"), F.col("rmse_mean").between(0.8 * F.col("spread"), 1.2 * F.col("spread")).alias("within_fifth"),
        F.col("rmse_text").isNotNull().alias("has_text"))


@query("g6_two_stage_search", f"""{_SX},
{_search_ctes("one")},
kept AS (SELECT candidate FROM one GROUP BY candidate ORDER BY AVG(cv_rmse), stddev_pop(cv_rmse) LIMIT 2),
{_search_ctes("two", (42, 43, 44, 45, 46), 5)},
s AS (SELECT candidate, AVG(cv_rmse) AS m, stddev_pop(cv_rmse) AS sd FROM two WHERE candidate IN (SELECT candidate FROM kept) GROUP BY candidate)
SELECT candidate, round(m, 9) AS rmse_mean, round(sd, 9) AS rmse_std FROM s ORDER BY m, sd LIMIT 1
""")
def _g6(spark, sf):
    d = sales_xy(spark, sf).select("id", "x", "y")

    def run(keep, seeds, k, stage):
        al = ALPHAS if keep is None else {c: ALPHAS[c] for c in keep}
        return search.summarize_candidates(
            search.ridge1_candidates(d, "x", "y", "id", al, seeds, k, stage))
    _s1, s2, best = search.two_stage_search(spark, run, top_k=2)
    return best.select("candidate", rnd("rmse_mean", 9).alias("rmse_mean"),
                       rnd("rmse_std", 9).alias("rmse_std"))


W = [round(i * 0.05, 2) for i in range(21)]


@query("g7_weight_sweep", f"""{P},
a AS (SELECT id, pred_log FROM preds WHERE model = 'ridge_ext'),
b AS (SELECT id, pred_log FROM preds WHERE model = 'seg_mean'),
w AS (SELECT * FROM (VALUES {", ".join(f"({x}::DOUBLE)" for x in W)}) v(w))
SELECT w.w, round(sqrt(AVG(power(w.w * a.pred_log + (1 - w.w) * b.pred_log - ln(1 + s.price), 2))), 9) AS rmse
FROM a JOIN b ON a.id = b.id JOIN sales s ON a.id = s.id, w GROUP BY w.w
""")
def _g7(spark, sf):
    p = predictions(spark, sf)
    y = sales(spark, sf).select("id", F.log1p("price").alias("y"))
    out = search.weight_sweep(p.filter(F.col("model") == "ridge_ext"),
                              p.filter(F.col("model") == "seg_mean"), y, "id", "y", W)
    return out.select("w", rnd("rmse", 9).alias("rmse"))


@query("g8_holdout_split", f"""{S}
SELECT CASE WHEN {hash_sql('id')} % 100 < 20 THEN 'holdout' ELSE 'train' END AS split,
       COUNT(*) AS n, CAST(SUM(id) AS BIGINT) AS id_sum FROM sales GROUP BY 1
""")
def _g8(spark, sf):
    tr, ho = holdout_split(sales(spark, sf), "id", 0.2, 42)
    agg = [F.count(F.lit(1)).alias("n"), F.sum("id").alias("id_sum")]
    return tr.agg(*agg).select(F.lit("train").alias("split"), "*").unionByName(
        ho.agg(*agg).select(F.lit("holdout").alias("split"), "*"))


@query("g9_train_run", f"""{S}
SELECT 'ridge' AS model, '2025-06-01_120000' AS run_id, round(stddev_pop(ln(1 + price)), 9) AS spread, true AS within_fifth,
       3 AS folds, COUNT(*) AS rows FROM sales
""")
def _g9(spark, sf):
    d = model_frame(spark, sf)
    root = os.path.join(checkpoint_dir(spark), f"registry-{uuid.uuid4().hex}")
    rec = search.train_run(spark, d, pipe(d, lambda: models.ridge(12.0), True), "ridge", "id",
                           "label", 3, 42, root, "2025-06-01_120000", MODEL_COLS[1:])
    spread = d.agg(F.stddev_pop("label").alias("spread"))
    return rec.join(F.broadcast(spread)).select(
        "model", "run_id", rnd("spread", 9).alias("spread"), F.col("cv_rmse").between(0.8 * F.col("spread"), 1.2 * F.col("spread")).alias("within_fifth"),
        F.size("fold_rmse").alias("folds"), "rows")


RUNS = {"2025-06-01_120000": 500.0, "2025-06-02_120000": 1.0, "2025-06-03_120000": 5000.0}


@query("g9_train_aliases", f"""{_SX},
{_search_ctes("det", (42,), 3, {f"r{i}": a for i, a in enumerate(RUNS.values())})},
r AS (SELECT v.run_id, det.cv_rmse FROM det JOIN (VALUES {", ".join(f"('r{i}', '{r}')" for i, r in enumerate(RUNS))}) v(candidate, run_id)
      ON det.candidate = v.candidate),
a AS (SELECT 'latest' AS alias, MAX(run_id) AS run_id FROM r
      UNION ALL SELECT 'best', arg_min(run_id, cv_rmse) FROM r)
SELECT scope, 'ridge' AS model, alias, a.run_id, round(r.cv_rmse, 9) AS cv_rmse, (SELECT COUNT(*) FROM r) AS n_runs
FROM a JOIN r USING (run_id), (VALUES ('family'), ('global')) s(scope)
""")
def _g9a(spark, sf):
    """Three runs of the one-feature ridge, the last one twice: aliases after all of them."""
    d = cut_lineage(sales_xy(spark, sf).select("id", "x", F.col("y").alias("label")))  # read by four runs
    root = os.path.join(checkpoint_dir(spark), f"registry-{uuid.uuid4().hex}")
    for run_id, alpha in [*RUNS.items(), list(RUNS.items())[-1]]:
        search.train_run(spark, d, one_feature(alpha), "ridge", "id", "label", 3, 42, root, run_id, ["x"])
    n = registry.read_runs(spark, root).agg(F.count(F.lit(1)).alias("n_runs"))
    return registry.current_aliases(registry.read_events(spark, root)).join(F.broadcast(n)).select(
        "scope", "model", "alias", "run_id", rnd("cv_rmse", 9).alias("cv_rmse"), "n_runs")


@query("g10_perf_baseline", f"""{S}
SELECT 'log1p(target)' AS target, 'Ridge(alpha=10.0)' AS model, 3 AS n_splits, 42 AS seed,
       round(stddev_pop(ln(1 + price)), 9) AS spread, true AS below_mean, CAST(0.015 AS DOUBLE) AS tolerance FROM sales
""")
def _g10(spark, sf):
    d = sales(spark, sf).select("id", "price", "qty", "ext", "quality", "segment", "priority",
                                "status")
    r = search.perf_baseline(spark, d, "id", "price", 3, 42, 10.0, 0.015)
    spread = d.agg(F.stddev_pop(F.log1p("price")).alias("spread"))
    return r.join(F.broadcast(spread)).select(
        "target", "model", "n_splits", "seed", rnd("spread", 9).alias("spread"),
        F.col("rmse").between(0.01, 1.02 * F.col("spread")).alias("below_mean"), "tolerance")

