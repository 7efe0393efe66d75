"""Cross-validated search and training jobs.

Independent fits (candidates x seeds) are submitted from a small driver
thread pool so the cluster runs several Spark ML jobs at once; every fit is
itself distributed.  Only per-fold RMSE scalars come back to the driver.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.operators.folds import assign_folds
from hearth.operators.oof import fold_summary, oof_predict, oof_ridge1
from hearth.operators.registry import run_ts
from hearth.session import cut_lineage

DETAIL_SCHEMA = ("stage string, model string, candidate string, seed int, cv_rmse double, "
                 "fold_mean double, fold_std double, best_iter_mean double, best_iter_std double")


def _cv_once(df: DataFrame, make: Callable[[], object], id_col: str, label: str, k: int,
             seed: int) -> tuple[float, list[float]]:
    d = assign_folds(df, id_col, k, seed)
    oof, _t, _m = oof_predict(d, make, "fold", id_col, k, checkpoint=True)
    j = oof.join(d.select(id_col, label), id_col)
    r = fold_summary(j, label, "pred_log").first()
    folds = [x["rmse"] for x in r["fold_rmse"]]
    return float(r["oof_rmse"]), [float(v) for v in folds]


def run_candidates(spark: SparkSession, df: DataFrame, model: str,
                   candidates: dict[str, Callable[[], object]], seeds: Sequence[int], k: int,
                   id_col: str, label: str = "label", stage: str = "Stage1",
                   top_k: int | None = None, parallel: int = 4
                   ) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """CV for every candidate x seed.  Returns (summary, detail, top-k):
    summary = mean and population std of the per-seed CV RMSE with the
    'mean +- std' text, sorted by (mean, std)."""
    jobs = [(c, s) for c in candidates for s in seeds]
    with ThreadPoolExecutor(max_workers=parallel) as ex:
        res = list(ex.map(lambda cs: _cv_once(df, candidates[cs[0]], id_col, label, k, cs[1]),
                          jobs))
    rows = []
    for (c, s), (cv, folds) in zip(jobs, res):
        m = sum(folds) / len(folds)
        sd = (sum((f - m) ** 2 for f in folds) / len(folds)) ** 0.5
        rows.append((stage, model, c, int(s), cv, m, sd, None, None))
    detail = spark.createDataFrame(rows, DETAIL_SCHEMA)
    summary = summarize_candidates(detail)
    top = summary.limit(top_k) if top_k else None
    return summary, detail.orderBy("candidate", "seed"), top


def summarize_candidates(detail: DataFrame) -> DataFrame:
    """G5 aggregation: per candidate mean/std (ddof 0) of the per-seed CV
    RMSE, formatted text, sorted by (mean, std)."""
    g = detail.groupBy("stage", "model", "candidate").agg(
        F.avg("cv_rmse").alias("rmse_mean"), F.stddev_pop("cv_rmse").alias("rmse_std"),
        F.avg("best_iter_mean").alias("best_iter_mean"),
        F.stddev_pop("best_iter_mean").alias("best_iter_std"))
    g = g.withColumn("rmse_text", F.format_string("%.5f ± %.5f", "rmse_mean", "rmse_std"))
    return g.orderBy("rmse_mean", "rmse_std", "candidate")


def ridge1_candidates(df: DataFrame, x: str, y: str, id_col: str, alphas: dict[str, float],
                      seeds: Sequence[int], k: int, stage: str = "Stage1",
                      model: str = "ridge") -> DataFrame:
    """G5 detail for one-feature ridge candidates, as one lazy plan (per seed
    and alpha: one fold-statistics aggregate, no fitting loop)."""
    parts = []
    base = cut_lineage(df.select(id_col, x, y))  # read by every seed x alpha plan
    for s in seeds:
        d = assign_folds(base, id_col, k, s)
        for name, a in alphas.items():
            p = oof_ridge1(d, x, y, alpha=a)
            fs = fold_summary(p, y, "pred_log")
            parts.append(fs.select(
                F.lit(stage).alias("stage"), F.lit(model).alias("model"),
                F.lit(name).alias("candidate"), F.lit(int(s)).alias("seed"),
                F.col("oof_rmse").alias("cv_rmse"), F.col("fold_rmse_mean").alias("fold_mean"),
                F.col("fold_rmse_std").alias("fold_std"),
                F.lit(None).cast("double").alias("best_iter_mean"),
                F.lit(None).cast("double").alias("best_iter_std")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def two_stage_search(spark: SparkSession, run: Callable[..., tuple], top_k: int = 2,
                     stage1=((42, 43), 3), stage2=((42, 43, 44, 45, 46), 5)):
    """Stage 1 on few seeds/folds keeps the top-k candidates, stage 2
    re-runs them on more seeds/folds; the best is min by (mean, std).

    ``run(candidates_or_None, seeds, k, stage)`` returns a summary frame."""
    s1 = run(None, stage1[0], stage1[1], "Stage1")
    keep = [r["candidate"] for r in s1.orderBy("rmse_mean", "rmse_std").limit(top_k).collect()]
    s2 = run(keep, stage2[0], stage2[1], "Stage2")
    best = s2.agg(F.min_by(F.struct("candidate", "rmse_mean", "rmse_std"),
                           F.struct("rmse_mean", "rmse_std")).alias("b")).select("b.*")
    return s1, s2, best


def weight_sweep(a: DataFrame, b: DataFrame, truth: DataFrame, id_col: str, label: str,
                 weights: Sequence[float], pred: str = "pred_log") -> DataFrame:
    """RMSE of w*a + (1-w)*b for every w, from three sums in one pass:
    with d = a - b and e = b - y, SSE(w) = w^2 Sdd + 2 w Sde + See.  No
    per-weight pass over the rows and no row x weight product."""
    j = (a.select(id_col, F.col(pred).alias("_a"))
         .join(b.select(id_col, F.col(pred).alias("_b")), id_col)
         .join(truth.select(id_col, F.col(label).alias("_y")), id_col))
    d, e = F.col("_a") - F.col("_b"), F.col("_b") - F.col("_y")
    st = j.agg(F.sum(d * d).alias("sdd"), F.sum(d * e).alias("sde"), F.sum(e * e).alias("see"),
               F.count(F.lit(1)).alias("n"))
    spark = a.sparkSession
    w = spark.createDataFrame([(float(x),) for x in weights], "w double")
    out = w.join(F.broadcast(st), how="inner")  # weights x one statistics row
    sse = F.col("w") * F.col("w") * F.col("sdd") + 2 * F.col("w") * F.col("sde") + F.col("see")
    return out.select("w", F.sqrt(F.greatest(sse, F.lit(0.0)) / F.col("n")).alias("rmse")) \
              .orderBy("rmse", "w")


def train_run(spark: SparkSession, df: DataFrame, make: Callable[[], object], model: str,
              id_col: str, label: str, k: int, seed: int, root: str, run_id: str,
              features: Sequence[str], test: DataFrame | None = None) -> DataFrame:
    """The training job: out-of-fold and (fold-averaged) test predictions,
    metrics, final fit on all rows, persisted model, run record and alias
    events (latest and best, of the family and of all).  Returns the record.

    Everything is written under the run's id, so a job that runs again
    replaces its own results and registers nothing twice."""
    from hearth.operators.registry import current_aliases, fingerprint, promote, read_events, read_runs, write_part
    from hearth.sources.io import save_model, write_metrics
    d = cut_lineage(assign_folds(df, id_col, k, seed))  # read by the fits, the join and the fingerprint
    oof, averaged, _m = oof_predict(d, make, "fold", id_col, k, test=test, checkpoint=False)
    part = f"model={model}/run_id={run_id}"
    told = f"{root}/predictions/split=oof/{part}"
    write_part(oof.select(id_col, "fold", "pred_log"), told)
    if averaged is not None:
        write_part(averaged, f"{root}/predictions/split=test/{part}")
    j = spark.read.schema(oof.select(id_col, "fold", "pred_log").schema).parquet(told).join(d.select(id_col, label), id_col)
    summ = fold_summary(j, label, "pred_log").first()
    final = make().fit(d)
    path = save_model(final, os.path.join(root, "models"), model, run_id)
    fp = fingerprint(d.select(*[F.col(f"`{c}`") for c in df.columns]), id_col).first()
    rec = spark.createDataFrame(
        [(model, run_id, float(summ["oof_rmse"]), [float(x["rmse"]) for x in summ["fold_rmse"]],
          {"seed": str(seed), "n_splits": str(k), "model_name": model}, list(features),
          int(fp["rows"]), fp["head_md5"], fp["table_hash"], path)],
        "model string, run_id string, cv_rmse double, fold_rmse array<double>, "
        "args map<string,string>, features array<string>, rows bigint, head_md5 string, table_hash string, "
        "artifact string")
    write_metrics(rec.select("model", "run_id", "cv_rmse", "fold_rmse"), f"{root}/metrics/{part}")
    write_part(rec.withColumn("ts", run_ts(F.col("run_id"))), f"{root}/runs/run={model}-{run_id}")
    aliases = current_aliases(read_events(spark, root).filter(F.col("event") != f"{model}-{run_id}"))
    write_part(promote(read_runs(spark, root), aliases, model, run_id), f"{root}/events/event={model}-{run_id}")
    return read_runs(spark, root).filter((F.col("model") == model) & (F.col("run_id") == run_id))


def perf_baseline(spark: SparkSession, df: DataFrame, id_col: str, target: str, k: int = 3,
                  seed: int = 42, alpha: float = 10.0, tolerance: float = 0.015) -> DataFrame:
    """Plain dummies (+ NULL indicators) + ridge(10), k-fold OOF RMSE."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from hearth.operators.encode import dummies
    from hearth.operators.models import Ridge
    x = dummies(df.drop(target), exclude=[id_col])
    feats = [c for c in x.columns if c != id_col]
    d = x.join(df.select(id_col, F.log1p(target).alias("label")), id_col)

    def make():
        return Pipeline(stages=[VectorAssembler(inputCols=feats, outputCol="features"),
                                Ridge(alpha=alpha)])
    cv, folds = _cv_once(d, make, id_col, "label", k, seed)
    return spark.createDataFrame(
        [("log1p(target)", f"Ridge(alpha={alpha})", k, seed, cv, tolerance)],
        "target string, model string, n_splits int, seed int, rmse double, tolerance double")
