"""Encoding and vector assembly."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from hearth.operators.impute import MedianImputer, ModeImputer

MAX_DUMMY_LEVELS = 10_000  # per column; categories only


class _ScalerParams(Params):
    inputCols = Param(Params._dummy(), "inputCols", "columns", TypeConverters.toListString)
    stats = Param(Params._dummy(), "stats", "mean/std per column (JSON)", TypeConverters.toString)


class PopulationScalerModel(Model, _ScalerParams, DefaultParamsReadable, DefaultParamsWritable):
    def __init__(self):
        super().__init__()

    def _transform(self, df: DataFrame) -> DataFrame:
        st = json.loads(self.getOrDefault(self.stats))
        out = []
        for c in df.columns:
            if c in st:
                mu, sd = st[c]
                sd = sd if sd not in (None, 0.0) else 1.0
                mu = mu if mu is not None else 0.0
                out.append(((F.col(f"`{c}`").cast("double") - F.lit(mu)) / F.lit(sd)).alias(c))
            else:
                out.append(F.col(f"`{c}`"))
        return df.select(*out)


class PopulationScaler(Estimator, _ScalerParams, DefaultParamsReadable, DefaultParamsWritable):
    """Z-score with the population std (ddof 0); constant columns are
    only centred.  One aggregate computes every column's mean and std."""

    @keyword_only
    def __init__(self, inputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> PopulationScalerModel:
        cols = [c for c in self.getOrDefault(self.inputCols) if c in df.columns]
        st = {}
        if cols:
            row = df.agg(*[F.struct(F.avg(F.col(f"`{c}`").cast("double")).alias("m"),
                                    F.stddev_pop(F.col(f"`{c}`").cast("double")).alias("s"))
                           .alias(c) for c in cols]).first()
            st = {c: [row[c]["m"], row[c]["s"]] for c in cols}
        m = PopulationScalerModel()
        m._set(inputCols=cols, stats=json.dumps(st))
        return m


def split_columns(df: DataFrame, exclude: Sequence[str]) -> tuple[list[str], list[str]]:
    num = [f.name for f in df.schema.fields
           if isinstance(f.dataType, NumericType) and f.name not in set(exclude)]
    cat = [f.name for f in df.schema.fields
           if not isinstance(f.dataType, NumericType) and f.name not in set(exclude)]
    return num, cat


def one_hot_all(cats: Sequence[str], suffix: str = "_ohe") -> list:
    """Every seen level kept, unknown or NULL -> all zeros."""
    idx = [f"{c}__idx" for c in cats]
    return [
        StringIndexer(inputCols=list(cats), outputCols=idx, handleInvalid="keep",
                      stringOrderType="alphabetAsc"),
        OneHotEncoder(inputCols=idx, outputCols=[f"{c}{suffix}" for c in cats], dropLast=True),
    ]


def assembler(df: DataFrame, exclude: Sequence[str], linear: bool = True,
              output: str = "features") -> Pipeline:
    """Numeric block (median impute, + population scaling for linear
    models) and one-hot block (mode impute + one-hot); other columns dropped.
    Slot names are kept in the vector's ML attributes."""
    num, cat = split_columns(df, exclude)
    stages: list = []
    if num:
        stages.append(MedianImputer(inputCols=num))
        if linear:
            stages.append(PopulationScaler(inputCols=num))
    if cat:
        stages.append(ModeImputer(inputCols=cat))
        stages.extend(one_hot_all(cat))
    stages.append(VectorAssembler(inputCols=num + [f"{c}_ohe" for c in cat],
                                  outputCol=output, handleInvalid="keep"))
    return Pipeline(stages=stages)


def dummy_levels(df: DataFrame, cats: Sequence[str]) -> dict[str, list[str]]:
    """Distinct non-null levels per text column in one aggregate."""
    if not cats:
        return {}
    # cardinality check with HyperLogLog before anything is collected
    est = df.agg(*[F.approx_count_distinct(F.col(f"`{c}`")).alias(c) for c in cats]).first()
    wide = [c for c in cats if est[c] > MAX_DUMMY_LEVELS * 1.05]
    if wide:
        raise ValueError(f"{wide} have more than {MAX_DUMMY_LEVELS} levels; dummies need categories")
    row = df.agg(*[F.array_sort(F.collect_set(F.col(f"`{c}`"))).alias(c) for c in cats]).first()
    out = {}
    for c in cats:
        lv = list(row[c])
        if len(lv) > MAX_DUMMY_LEVELS:
            raise ValueError(f"{c} has {len(lv)} levels; dummies need a category")
        out[c] = lv
    return out


def dummies(df: DataFrame, exclude: Sequence[str] = (), dummy_na: bool = True,
            levels: dict[str, list[str]] | None = None) -> DataFrame:
    """Indicator columns per level (+ NULL indicator), numeric NULL -> 0."""
    num, cat = split_columns(df, exclude)
    levels = levels if levels is not None else dummy_levels(df, cat)
    out = [F.col(f"`{c}`") for c in exclude if c in df.columns]
    out += [F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)).alias(c) for c in num]
    for c in cat:
        x = F.col(f"`{c}`")
        for v in levels.get(c, []):
            out.append(F.coalesce((x == F.lit(v)).cast("int"), F.lit(0)).alias(f"{c}_{v}"))
        if dummy_na:
            out.append(x.isNull().cast("int").alias(f"{c}_nan"))
    return df.select(*out)
