"""Out-of-fold prediction and fold scoring.

``oof_ridge1`` is the one-feature ridge of the flagship query.  Instead of K
separate fits it computes sufficient statistics per fold in a single
aggregate (map-side partial sums, K output rows), derives the K
training-fold coefficient sets as "total minus own fold", and joins the
K-row coefficient table back by broadcast.  One scan, one tiny shuffle.

``oof_predict`` is the general loop for Spark ML estimators: one fit per fold
on ``fold != i`` with preprocessing fitted inside the fold.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hearth.session import cut_lineage


def ridge1_fold_coefficients(df: DataFrame, x: str, y: str, fold_col: str = "fold",
                             alpha: float = 12.0) -> DataFrame:
    """Per fold k: ridge fitted on rows with fold != k, one standardised
    feature (population std), intercept unpenalised.

    Returns (fold, n, mx, my, sd, b): prediction = my + b * (x - mx) / sd.
    """
    xs, ys = F.col(x).cast("double"), F.col(y).cast("double")
    per_fold = (df.filter(xs.isNotNull() & ys.isNotNull())
                .groupBy(fold_col).agg(
                    F.count(F.lit(1)).alias("c"), F.sum(xs).alias("sx"), F.sum(ys).alias("sy"),
                    F.sum(xs * xs).alias("sxx"), F.sum(xs * ys).alias("sxy")))
    w = Window.partitionBy()  # over the K fold rows only
    tr = per_fold.select(
        fold_col,
        *[(F.sum(c).over(w) - F.col(c)).alias(c) for c in ("c", "sx", "sy", "sxx", "sxy")])
    n = F.col("c").cast("double")
    mx, my = F.col("sx") / n, F.col("sy") / n
    tr = tr.select(fold_col, n.alias("n"), mx.alias("mx"), my.alias("my"),
                   (F.col("sxx") / n - mx * mx).alias("vx"),
                   (F.col("sxy") / n - mx * my).alias("cxy"))
    sd = F.sqrt(F.greatest(F.col("vx"), F.lit(0.0)))
    sd_safe = F.when(sd > 0, sd).otherwise(F.lit(1.0))
    b = F.col("n") * F.col("cxy") / sd_safe / (F.col("n") + F.lit(float(alpha)))
    return tr.select(fold_col, "n", "mx", "my", sd_safe.alias("sd"), b.alias("b"))


def oof_ridge1(df: DataFrame, x: str, y: str, fold_col: str = "fold", alpha: float = 12.0,
               out: str = "pred_log") -> DataFrame:
    coef = ridge1_fold_coefficients(df, x, y, fold_col, alpha)
    j = df.join(F.broadcast(coef), fold_col)  # K rows: size bounded by k
    pred = F.col("my") + F.col("b") * (F.col(x) - F.col("mx")) / F.col("sd")
    return j.withColumn(out, pred).drop("n", "mx", "my", "sd", "b")


def oof_group_mean(df: DataFrame, by: str, y: str, fold_col: str = "fold",
                   out: str = "pred_log") -> DataFrame:
    """Stand-in model: out-of-fold mean of ``y`` per level of ``by`` computed
    on the training folds only (level total minus own fold); a NULL level or
    a level seen only in its own fold falls back to the training-fold mean.

    Statistics tables: (fold, level) sums partitioned by level, and K fold
    totals; no window spans the whole statistics table."""
    ys = F.col(y).cast("double")
    g = (df.filter(ys.isNotNull()).groupBy(fold_col, by)
         .agg(F.count(F.lit(1)).alias("_c"), F.sum(ys).alias("_s")))
    w_lvl = Window.partitionBy(by)
    lvl = g.filter(F.col(by).isNotNull()).select(
        fold_col, by, (F.sum("_c").over(w_lvl) - F.col("_c")).alias("_lc"),
        (F.sum("_s").over(w_lvl) - F.col("_s")).alias("_ls"))
    ft = g.groupBy(fold_col).agg(F.sum("_c").alias("_fc"), F.sum("_s").alias("_fs"))
    w_all = Window.partitionBy()  # over the K fold rows only
    glob = ft.select(fold_col, (F.sum("_fc").over(w_all) - F.col("_fc")).alias("_gc"),
                     (F.sum("_fs").over(w_all) - F.col("_fs")).alias("_gs"))
    j = (df.join(F.broadcast(glob), fold_col, "left")  # K rows
         .join(lvl, [fold_col, by], "left"))  # k x levels: AQE broadcasts it when small
    pred = F.coalesce(F.when(F.col("_lc") > 0, F.col("_ls") / F.col("_lc")),
                      F.col("_gs") / F.col("_gc"))
    return j.withColumn(out, pred).drop("_lc", "_ls", "_gc", "_gs")


def oof_predict(df: DataFrame, make_pipeline: Callable[[], object], fold_col: str,
                id_col: str, k: int, pred_col: str = "prediction", out: str = "pred_log",
                test: DataFrame | None = None, checkpoint: bool = True, parallel: int = 4
                ) -> tuple[DataFrame, DataFrame | None, list]:
    """Fit ``make_pipeline()`` on every fold's training rows and
    predict the held-out rows.  Returns (oof, test_avg, models).

    The training frame is checkpointed once so each of the K fits reads the
    materialised rows instead of recomputing the lineage; test predictions
    are the mean over the K fold models (G3)."""
    base = cut_lineage(df) if checkpoint else df
    # the K fits are independent Spark jobs: submit them concurrently
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=max(1, min(parallel, k))) as ex:
        models = list(ex.map(
            lambda i: make_pipeline().fit(base.filter(F.col(fold_col) != i)), range(k)))
    parts = [m.transform(base.filter(F.col(fold_col) == i))
             .select(id_col, F.lit(i).alias(fold_col), F.col(pred_col).alias(out))
             for i, m in enumerate(models)]
    oof = parts[0]
    for p in parts[1:]:
        oof = oof.unionByName(p)
    test_avg = None
    if test is not None:
        # the K fold models side by side on each test row: map-only, no shuffle
        from hearth.operators.models import transform_isolated
        names = [f"_f{i}" for i in range(k)]
        t = transform_isolated(models, test.select(
            *[F.col(f"`{c}`") for c in test.columns]), names, pred_col)
        cols = [F.col(n) for n in names]
        test_avg = t.select(id_col, (sum(cols[1:], cols[0]) / F.lit(float(k))).alias(out))
    return oof, test_avg, models


def fold_average(preds: DataFrame, id_col: str, pred: str = "pred_log") -> DataFrame:
    """G3 for predictions already stored in long form (one row per fold
    model and id): mean over the fold models.  ``oof_predict`` computes the
    same mean map-side when it scores the test rows itself."""
    return preds.groupBy(id_col).agg(F.avg(pred).alias(pred))


def fold_rmse(df: DataFrame, y: str, pred: str, fold_col: str = "fold") -> DataFrame:
    """Per-fold RMSE plus one overall row (fold = NULL) via rollup."""
    se = F.pow(F.col(y) - F.col(pred), 2)
    return (df.rollup(fold_col).agg(F.sqrt(F.avg(se)).alias("rmse"),
                                    F.count(F.lit(1)).alias("n")))


def fold_summary(df: DataFrame, y: str, pred: str, fold_col: str = "fold",
                 by: list[str] | None = None) -> DataFrame:
    """Overall OOF RMSE, mean and std (ddof 0) of the fold RMSEs."""
    by = by or []
    se = F.pow(F.col(y) - F.col(pred), 2)
    per = df.groupBy(*by, fold_col).agg(F.sum(se).alias("sse"), F.count(F.lit(1)).alias("n"))
    per = per.withColumn("rmse", F.sqrt(F.col("sse") / F.col("n")))
    return per.groupBy(*by).agg(
        F.sqrt(F.sum("sse") / F.sum("n")).alias("oof_rmse"),
        F.avg("rmse").alias("fold_rmse_mean"),
        F.stddev_pop("rmse").alias("fold_rmse_std"),
        F.sort_array(F.collect_list(F.struct(fold_col, "rmse"))).alias("fold_rmse"))
