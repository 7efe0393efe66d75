"""Sources and sinks (A1-A8): CSV / Parquet / JSON tables and ML persistence."""

from __future__ import annotations

import os
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from hearth.functions.exprs import DEFAULT_NA_TOKENS, na_tokens_to_null, unlog


def read_table(spark: SparkSession, path: str, schema: StructType | str | None = None,
               na_tokens: Iterable[str] | None = None, fmt: str | None = None) -> DataFrame:
    """A1: read a CSV (header, explicit schema) or Parquet table.

    For CSV every string column additionally gets a missing-token pass,
    because ``nullValue`` only understands one token.
    """
    fmt = fmt or ("csv" if path.endswith(".csv") else "json" if path.endswith(".json")
                  else "parquet")
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        df = (reader.option("header", True).option("nullValue", "NA")
              .option("mode", "PERMISSIVE").csv(path))
        tokens = list(DEFAULT_NA_TOKENS if na_tokens is None else na_tokens)
        if tokens:
            df = df.select([
                na_tokens_to_null(f.name, tokens).alias(f.name)
                if isinstance(f.dataType, StringType) else F.col(f"`{f.name}`")
                for f in df.schema.fields])
        return df
    if fmt == "json":
        return reader.json(path)
    df = reader.parquet(path)
    if na_tokens:
        df = df.select([
            na_tokens_to_null(f.name, na_tokens).alias(f.name)
            if isinstance(f.dataType, StringType) else F.col(f"`{f.name}`")
            for f in df.schema.fields])
    return df


def load_train_test(spark: SparkSession, train_path: str, test_path: str, target: str,
                    schema: StructType | None = None, fmt: str | None = None
                    ) -> tuple[DataFrame, DataFrame]:
    """A2: read both tables; they must share the schema apart from the target."""
    missing = [p for p in (train_path, test_path) if not _exists(spark, p)]
    if missing:
        raise FileNotFoundError(f"missing input: {missing}")
    train = read_table(spark, train_path, schema, fmt=fmt)
    test_schema = None
    if schema is not None:
        test_schema = StructType([f for f in schema.fields if f.name != target])
    test = read_table(spark, test_path, test_schema, fmt=fmt)
    check_train_test(train, test, target)
    return train, test


def check_train_test(train: DataFrame, test: DataFrame, target: str) -> None:
    a = {f.name: f.dataType.simpleString() for f in train.schema.fields if f.name != target}
    b = {f.name: f.dataType.simpleString() for f in test.schema.fields if f.name != target}
    if set(a) != set(b):
        raise ValueError(f"train/test columns differ: {sorted(set(a) ^ set(b))}")


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p)


def prepare_features(df: DataFrame, id_col: str, target: str,
                     label: str = "label") -> DataFrame:
    """A3: keep the key, add ``label = log1p(target)``; error if the target
    is absent. Feature columns are every other column."""
    if target not in df.columns:
        raise ValueError(f"target column {target!r} not in frame")
    if id_col not in df.columns:
        raise ValueError(f"id column {id_col!r} not in frame")
    feats = [c for c in df.columns if c not in (id_col, target)]
    return df.select(F.col(id_col), *[F.col(f"`{c}`") for c in feats],
                     F.log1p(F.col(target).cast("double")).alias(label))


def feature_columns(df: DataFrame, exclude: Sequence[str]) -> list[str]:
    return [c for c in df.columns if c not in set(exclude)]


def write_predictions(preds: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A4 sink: prediction table partitioned by model (partition pruning on read)."""
    preds.write.mode(mode).partitionBy("model").parquet(path)


def read_predictions(spark: SparkSession, path: str, models: Sequence[str] | None = None,
                     metrics: DataFrame | None = None) -> DataFrame:
    """A4 source: reload predictions (only the requested model partitions) and
    attach each model's RMSE, 1.0 when the metric is missing."""
    df = spark.read.parquet(path)
    if models:
        df = df.filter(F.col("model").isin(list(models)))
    if metrics is not None:
        m = metrics.select("model", F.col("cv_rmse").alias("_rmse"))
        df = df.join(F.broadcast(m), "model", "left")  # one row per model
        df = df.withColumn("rmse", F.coalesce(F.col("_rmse"), F.lit(1.0))).drop("_rmse")
    return df


def write_metrics(metrics: DataFrame, path: str, fmt: str = "json") -> None:
    """A5: per-run metrics (model, cv_rmse, fold_rmse array<double>)."""
    metrics.coalesce(1).write.mode("overwrite").format(fmt).save(path)


def write_submission(preds: DataFrame, id_col: str, pred_col: str, path: str,
                     out_col: str = "SalePrice") -> DataFrame:
    """Id + max(expm1(pred), 0) as CSV with header."""
    out = preds.select(F.col(id_col), unlog(pred_col).alias(out_col))
    out.write.mode("overwrite").option("header", True).csv(path)
    return out


def save_model(model, root: str, name: str, run_id: str) -> str:
    """Persist a fitted model (pipeline, voting mean, stacking), versioned + a 'current' copy."""
    versioned = os.path.join(root, name, run_id, "model")
    model.write().overwrite().save(versioned)
    model.write().overwrite().save(os.path.join(root, name, "current", "model"))
    return versioned


def load_model(path: str):
    """The model saved at ``path``, as the class that wrote it."""
    from pyspark.ml.util import DefaultParamsReader
    return DefaultParamsReader.loadParamsInstance(path, SparkSession.active())


# Canonical stage names of the experiment summary.
STAGE_NAMES = {"stage1": "Stage1", "stage 1": "Stage1", "stage2": "Stage2",
               "stage 2": "Stage2"}
SUMMARY_COLUMNS = ["stage", "model", "candidate", "rmse_mean", "rmse_std"]


def read_summary(spark: SparkSession, path: str) -> DataFrame:
    """Experiment-summary CSV -> typed frame.

    Header names are trimmed and lower-cased, the five required columns must
    exist, stage names are normalised, numbers are coerced, rows without a
    mean are dropped and a missing std becomes 0."""
    raw = spark.read.option("header", True).csv(path)
    return normalize_summary(raw)


def normalize_summary(raw: DataFrame) -> DataFrame:
    renamed = raw.toDF(*[c.strip().lower() for c in raw.columns])
    missing = [c for c in SUMMARY_COLUMNS if c not in renamed.columns]
    if missing:
        raise ValueError(f"summary lacks columns {missing}")
    stage_key = F.lower(F.trim(F.col("stage")))
    stage = F.coalesce(
        F.element_at(F.create_map(*[F.lit(x) for kv in STAGE_NAMES.items() for x in kv]),
                     stage_key),
        F.trim(F.col("stage")))
    return (renamed.select(
        stage.alias("stage"),
        F.trim(F.col("model")).alias("model"),
        F.trim(F.col("candidate")).alias("candidate"),
        F.trim(F.col("rmse_mean")).try_cast("double").alias("rmse_mean"),
        F.coalesce(F.trim(F.col("rmse_std")).try_cast("double"), F.lit(0.0)).alias("rmse_std"))
        .na.drop(subset=["rmse_mean"]))
