"""Models, blending and stacking (F1-F10) on Spark ML.

Regressors are Spark ML estimators so training is distributed (normal
equations / L-BFGS for ridge, histogram trees for forests and boosting).
Documented deviations from the single-machine originals: no random split
thresholds (extra trees -> random forest without bootstrap), no leaf-wise
growth (depth-limited GBT), no L2 leaf-weight penalty, and Spark's early
stopping uses a relative-improvement tolerance.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReader, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.session import cut_lineage


class Ridge(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol,
            DefaultParamsReadable, DefaultParamsWritable):
    """ridge objective ||y - Xw - b||^2 + alpha ||w||^2 (intercept not
    penalised) expressed through Spark's LinearRegression:
    regParam = alpha * stddev_pop(y) / n, no internal standardisation.  The
    two statistics come from one aggregate; Spark picks the solver from the
    vector's size."""

    alpha = Param(Params._dummy(), "alpha", "ridge penalty", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, alpha=12.0, featuresCol="features", labelCol="label",
                 predictionCol="prediction"):
        super().__init__()
        self._setDefault(alpha=12.0, featuresCol="features", labelCol="label",
                         predictionCol="prediction")
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame):
        y = self.getOrDefault(self.labelCol)
        st = df.agg(F.count(F.col(y)).alias("n"), F.stddev_pop(F.col(y)).alias("s")).first()
        n, s = st["n"], st["s"] or 0.0
        reg = float(self.getOrDefault(self.alpha)) * s / max(n, 1)
        lr = LinearRegression(featuresCol=self.getOrDefault(self.featuresCol), labelCol=y,
                              predictionCol=self.getOrDefault(self.predictionCol),
                              regParam=reg, elasticNetParam=0.0, standardization=False,
                              solver="auto", maxIter=200, tol=1e-10)
        return lr.fit(df)


def ridge(alpha: float = 12.0, **kw) -> Ridge:
    return Ridge(alpha=alpha, **kw)


def extra_trees(n_trees: int = 1500, seed: int = 42, max_depth: int = 12,
                min_leaf: int = 1, **kw) -> RandomForestRegressor:
    """randomised-tree forest: all rows per tree (no bootstrap), sqrt
    feature subset per split."""
    return RandomForestRegressor(numTrees=n_trees, featureSubsetStrategy="sqrt",
                                 bootstrap=False, maxDepth=max_depth,
                                 minInstancesPerNode=min_leaf, seed=seed, **kw)


def boosted_depth(n_iter: int = 4000, step: float = 0.03, depth: int = 4,
                  subsample: float = 0.75, colsample: float = 0.75, seed: int = 42,
                  **kw) -> GBTRegressor:
    """depth-wise boosting preset."""
    return GBTRegressor(maxIter=n_iter, stepSize=step, maxDepth=depth,
                        subsamplingRate=subsample, featureSubsetStrategy=str(colsample),
                        seed=seed, **kw)


def boosted_leaf(n_iter: int = 5000, step: float = 0.03, depth: int = 5,
                 subsample: float = 0.8, colsample: float = 0.85, seed: int = 42,
                 **kw) -> GBTRegressor:
    """second boosting preset (leaf-wise growth approximated by depth 5)."""
    return GBTRegressor(maxIter=n_iter, stepSize=step, maxDepth=depth,
                        subsamplingRate=subsample, featureSubsetStrategy=str(colsample),
                        seed=seed, **kw)


def transform_isolated(members: Sequence, df: DataFrame, names: Sequence[str],
                       pred_col: str = "prediction") -> DataFrame:
    """Apply several fitted pipelines to the same rows, each on pristine input
    columns (stages such as imputers and scalers rewrite columns in place).
    The original row travels as one struct and is restored before every
    member, so this stays a chain of projections: no join, no shuffle."""
    cols = df.columns
    cur = df.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("_orig"))
    done: list[str] = []
    for m, n in zip(members, names):
        inp = cur.select("_orig.*", "_orig", *done)
        out = m.transform(inp)
        cur = out.select("_orig", *done, F.col(pred_col).alias(n))
        done.append(n)
    return cur.select("_orig.*", *done)


class _PartsWriter(MLWriter):
    """Writes a model's parameters, ``settings()`` and its ``parts()``, each in a folder of its own."""

    def __init__(self, model):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        parts = self.model.parts()
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession, extraMetadata={"parts": list(parts), "settings": self.model.settings()})
        for name, part in parts.items():
            # a part may hold further models: it is written by its own writer
            writer = part.write()
            (writer.overwrite() if self.shouldOverwrite else writer).session(self.sparkSession).save(f"{path}/parts/{name}")


class _PartsReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        parts = {name: DefaultParamsReader.loadParamsInstance(f"{path}/parts/{name}", self.sparkSession) for name in meta["parts"]}
        model = self.cls.from_parts(parts, meta["settings"])
        model._resetUid(meta["uid"])
        DefaultParamsReader.getAndSetParams(model, meta)
        return model


class CompositeModel(Model):
    """A model made of fitted models, saved and loaded with all of them."""

    def write(self) -> MLWriter:
        return _PartsWriter(self)

    def save(self, path: str) -> None:
        self.write().save(path)

    @classmethod
    def read(cls) -> MLReader:
        return _PartsReader(cls)

    @classmethod
    def load(cls, path: str):
        return cls.read().load(path)


class MeanEnsembleModel(CompositeModel, HasPredictionCol):
    """F5 fitted: mean of the member predictions (map-only)."""

    def __init__(self, members: list | None = None, predictionCol: str = "prediction"):
        super().__init__()
        self.members = members or []
        self._set(predictionCol=predictionCol)

    def parts(self) -> dict:
        return {f"member{i}": m for i, m in enumerate(self.members)}

    def settings(self) -> dict:
        return {}

    @classmethod
    def from_parts(cls, parts: dict, settings: dict) -> MeanEnsembleModel:
        return cls([parts[f"member{i}"] for i in range(len(parts))])

    def _transform(self, df: DataFrame) -> DataFrame:
        names = [f"_m{i}" for i in range(len(self.members))]
        out = transform_isolated(self.members, df, names)
        cols = [F.col(c) for c in names]
        mean = sum(cols[1:], cols[0]) / F.lit(float(len(cols)))
        return out.withColumn(self.getOrDefault(self.predictionCol), mean).drop(*names)


class VotingMean(Estimator, HasPredictionCol):
    """equal-weight mean of fitted member models."""

    def __init__(self, members: Sequence[Callable[[], Estimator]], predictionCol="prediction"):
        super().__init__()
        self.factories = list(members)
        self._set(predictionCol=predictionCol)

    def _fit(self, df: DataFrame) -> MeanEnsembleModel:
        return MeanEnsembleModel([f().fit(df) for f in self.factories],
                                 self.getOrDefault(self.predictionCol))


class StackingModel(CompositeModel):
    """F6 fitted: base models refit on all rows, meta ridge on their outputs.
    ``folds`` says how the meta model's rows were made (id, fold column, k, alpha)."""

    def __init__(self, bases: list, meta, base_cols: list[str], folds: dict | None = None):
        super().__init__()
        self.bases, self.meta, self.base_cols, self.folds = bases, meta, base_cols, folds or {}

    def parts(self) -> dict:
        return {f"base{i}": m for i, m in enumerate(self.bases)} | {"meta": self.meta}

    def settings(self) -> dict:
        return {"base_cols": self.base_cols, "folds": self.folds}

    @classmethod
    def from_parts(cls, parts: dict, settings: dict) -> StackingModel:
        return cls([parts[f"base{i}"] for i in range(len(parts) - 1)], parts["meta"], settings["base_cols"], settings["folds"])

    def _transform(self, df: DataFrame) -> DataFrame:
        out = transform_isolated(self.bases, df, self.base_cols)
        out = VectorAssembler(inputCols=self.base_cols, outputCol="_meta_x").transform(out)
        res = self.meta.setFeaturesCol("_meta_x").transform(out)
        return res.drop("_meta_x", *self.base_cols)


class Stacking(Estimator):
    """K-fold OOF predictions of every base model (fit on k-1 folds) are
    the meta features; the meta ridge (alpha 1) is fitted on them; bases are
    refit on all rows; no passthrough of the original features."""

    def __init__(self, bases: Sequence[Callable[[], Estimator]], id_col: str, fold_col: str,
                 k: int = 5, meta_alpha: float = 1.0, labelCol: str = "label"):
        super().__init__()
        self.bases, self.id_col, self.fold_col = list(bases), id_col, fold_col
        self.k, self.meta_alpha, self.label = k, meta_alpha, labelCol

    def _fit(self, df: DataFrame) -> StackingModel:
        from hearth.operators.oof import oof_predict
        cols = [f"_b{i}" for i in range(len(self.bases))]
        long = None
        for f, c in zip(self.bases, cols):
            o, _t, _m = oof_predict(df, f, self.fold_col, self.id_col, self.k, out="_p")
            o = o.select(self.id_col, F.lit(c).alias("_base"), "_p")
            long = o if long is None else long.unionByName(o)
        # one pivot (explicit base list, no distinct pass) instead of a join per base
        wide = long.groupBy(self.id_col).pivot("_base", cols).agg(F.first("_p"))
        # read by the meta ridge's statistics and by its fit: written once
        oof = cut_lineage(wide.join(df.select(self.id_col, self.label), self.id_col))
        meta_in = VectorAssembler(inputCols=cols, outputCol="_meta_x").transform(oof)
        meta = Ridge(alpha=self.meta_alpha, featuresCol="_meta_x", labelCol=self.label).fit(meta_in)
        bases = [f().fit(df) for f in self.bases]
        return StackingModel(bases, meta, cols, {"id_col": self.id_col, "fold_col": self.fold_col, "k": self.k, "meta_alpha": self.meta_alpha})


def blend_mean(preds: DataFrame, id_col: str = "id", model_col: str = "model",
               pred_col: str = "pred_log", n_models: int | None = None) -> DataFrame:
    """row mean over models in log space; ``complete`` tells whether every
    model predicted the row (the equal-length requirement, as a column)."""
    g = preds.groupBy(id_col).agg(F.avg(pred_col).alias(pred_col),
                                  F.count(pred_col).alias("n_models"))
    if n_models is not None:
        g = g.withColumn("complete", F.col("n_models") == n_models)
    return g


def blend_weighted(preds: DataFrame, metrics: DataFrame, id_col: str = "id",
                   model_col: str = "model", pred_col: str = "pred_log",
                   eps: float = 1e-12) -> DataFrame:
    """F8: weights 1/max(rmse, eps) normalised per row; a model without a
    metric gets RMSE 1.0.  The metrics table has one row per model."""
    m = metrics.select(model_col, F.coalesce(F.col("rmse"), F.lit(1.0)).alias("_r"))
    j = preds.join(F.broadcast(m), model_col, "left").withColumn(
        "_w", F.lit(1.0) / F.greatest(F.coalesce(F.col("_r"), F.lit(1.0)), F.lit(eps)))
    return j.groupBy(id_col).agg(
        (F.sum(F.col("_w") * F.col(pred_col)) / F.sum("_w")).alias(pred_col))


def pivot_predictions(preds: DataFrame, models: Sequence[str], id_col: str = "id",
                      model_col: str = "model", pred_col: str = "pred_log") -> DataFrame:
    """Wide (id, model_1 .. model_m) frame; the model list is explicit so the
    pivot needs no distinct pass."""
    return preds.groupBy(id_col).pivot(model_col, list(models)).agg(F.first(pred_col))


def stack_ridge(oof: DataFrame, truth: DataFrame, test: DataFrame, models: Sequence[str],
                id_col: str = "id", label: str = "label", alpha: float = 1.0,
                model_col: str = "model", pred_col: str = "pred_log"):
    """meta ridge fitted on all OOF rows (pivoted by model) and applied
    to the pivoted test predictions.  Returns (test predictions, meta model)."""
    tr = pivot_predictions(oof, models, id_col, model_col, pred_col).join(
        truth.select(id_col, label), id_col).dropna()
    va = VectorAssembler(inputCols=list(models), outputCol="_x")
    meta = Ridge(alpha=alpha, featuresCol="_x", labelCol=label).fit(va.transform(tr))
    te = va.transform(pivot_predictions(test, models, id_col, model_col, pred_col).dropna())
    return meta.transform(te).select(id_col, F.col("prediction").alias(pred_col)), meta


def best_round(errors: Sequence[float], rounds: int) -> int:
    """Trees up to the lowest error before ``rounds`` trees in a row bring no lower one."""
    best = 0
    for i, e in enumerate(errors):
        if e < errors[best]:
            best = i
        elif i - best >= rounds:
            break
    return best + 1


def early_stopping_cv(df: DataFrame, make_gbt: Callable[[], GBTRegressor], fold_col: str,
                      k: int, label: str = "label", features: str = "features",
                      tol: float = 1e-4, rounds: int | None = None) -> DataFrame:
    """per fold, boosting stops on the held-out fold
    (validationIndicatorCol); best iteration = number of trees kept.  With
    ``rounds`` all trees are fitted on the other folds and the best iteration
    is the last that the held-out error improved at within that many trees.
    Returns per-fold (fold, best_iteration, rmse)."""
    spark = df.sparkSession
    rows = []
    for i in range(k):
        if rounds is not None:
            m = make_gbt().setParams(labelCol=label, featuresCol=features).fit(df.filter(F.col(fold_col) != i))
            errors = m.evaluateEachIteration(df.filter(F.col(fold_col) == i), "squared")
            best = best_round(errors, rounds)
            rows.append((i, best, float(errors[best - 1]) ** 0.5))
            continue
        d = df.withColumn("_is_val", F.col(fold_col) == i)
        m = make_gbt().setParams(validationIndicatorCol="_is_val", validationTol=tol,
                                 labelCol=label, featuresCol=features).fit(d)
        p = m.transform(df.filter(F.col(fold_col) == i))
        r = p.agg(F.sqrt(F.avg(F.pow(F.col(label) - F.col("prediction"), 2)))).first()[0]
        rows.append((i, len(m.trees), float(r)))
    per = spark.createDataFrame(rows, "fold int, best_iteration int, rmse double")
    return per


def summarize_iterations(per_fold: DataFrame) -> DataFrame:
    return per_fold.agg(F.avg("rmse").alias("rmse_mean"), F.stddev_pop("rmse").alias("rmse_std"),
                        F.avg("best_iteration").alias("best_iter_mean"),
                        F.stddev_pop("best_iteration").alias("best_iter_std"))

