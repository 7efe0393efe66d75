"""Imputation.

Statistics are fitted on training rows only and applied anywhere.  The
fitted models keep one value per column as a small JSON param and apply it
as a literal; medians per level of a grouping column are a table that is
saved with the model and joined at transform time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (
    DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLWritable)
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, NumericType

from hearth.functions.exprs import to_num
from hearth.operators.quantiles import quantile_columns
from hearth.session import checkpoint_dir, cut_lineage



def fill_constant(df: DataFrame, cols: Sequence[str], value: str = "None") -> DataFrame:
    """Absence category for text columns."""
    return df.na.fill(value, subset=[c for c in cols if c in df.columns])


def fill_zero(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Structural zero for numeric columns."""
    return df.na.fill(0, subset=[c for c in cols if c in df.columns])


def fill_from_column(df: DataFrame, c: str, other: str) -> DataFrame:
    """C4: missing ``c`` <- ``other`` (both coerced to numbers)."""
    if c not in df.columns or other not in df.columns:
        return df
    return df.withColumn(c, F.coalesce(to_num(c), to_num(other)))


def fill_level(df: DataFrame, cols: Sequence[str], level: str = "MISSING") -> DataFrame:
    """Explicit missing level for profiling."""
    s = set(cols)
    return df.select(*[F.coalesce(F.col(c).cast("string"), F.lit(level)).alias(c) if c in s
                       else F.col(f"`{c}`") for c in df.columns])


def modes(df: DataFrame, cols: Sequence[str]) -> dict:
    """Most frequent non-null value per column, lowest value among ties.

    Columns of the same type are unpivoted together, counted per (column,
    value) with map-side partial aggregation, and the top level per column is
    kept with a literal-bounded row_number (partial WindowGroupLimit), so no
    task ever holds every distinct value.  One row per column reaches the
    driver."""
    if not cols:
        return {}
    by_type: dict[str, list[str]] = {}
    for c in cols:
        by_type.setdefault(df.schema[c].dataType.simpleString(), []).append(c)
    out = {c: None for c in cols}
    w = Window.partitionBy("_f").orderBy(F.desc("_n"), F.asc("_v"))
    for _t, cs in by_type.items():
        long = df.select(*[F.col(f"`{c}`").alias(c) for c in cs]).unpivot(
            [], cs, "_f", "_v").filter(F.col("_v").isNotNull())
        top = (long.groupBy("_f", "_v").agg(F.count(F.lit(1)).alias("_n"))
               .withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= F.lit(1)))
        for r in top.collect():  # one row per column
            out[r["_f"]] = r["_v"]
    return out


def medians(df: DataFrame, cols: Sequence[str]) -> dict:
    """Exact (interpolated) median per column, in one plan over all columns."""
    if not cols:
        return {}
    row = quantile_columns(df, [], [F.count(F.lit(1)).alias("_n")], [(to_num(F.col(f"`{c}`")), 0.5, c) for c in cols], needs=[]).first()
    return {c: row[c] for c in cols}


class _StatsParams(Params):
    inputCols = Param(Params._dummy(), "inputCols", "columns", TypeConverters.toListString)
    stats = Param(Params._dummy(), "stats", "fitted statistics (JSON)", TypeConverters.toString)

    def _stats(self) -> dict:
        return json.loads(self.getOrDefault(self.stats))


class _FillModel(Model, _StatsParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fill NULLs of each column with its fitted value (skip if none)."""

    def __init__(self):
        super().__init__()

    def _transform(self, df: DataFrame) -> DataFrame:
        st = {c: v for c, v in self._stats().items() if v is not None and c in df.columns}
        return df.select(*[F.coalesce(F.col(f"`{c}`"), F.lit(st[c]).cast(
            df.schema[c].dataType)).alias(c) if c in st else F.col(f"`{c}`")
            for c in df.columns])


class ModeImputerModel(_FillModel):
    pass


class MedianImputerModel(_FillModel):
    """Filled columns become doubles: the median of integers may lie between two."""

    def _transform(self, df: DataFrame) -> DataFrame:
        st = {c: v for c, v in self._stats().items() if v is not None and c in df.columns}
        return df.select(*[F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(float(st[c]))).alias(c) if c in st else F.col(f"`{c}`")
                           for c in df.columns])


class ModeImputer(Estimator, _StatsParams, DefaultParamsReadable, DefaultParamsWritable):
    """Most frequent value per column (lowest value among ties)."""

    @keyword_only
    def __init__(self, inputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> ModeImputerModel:
        cols = [c for c in self.getOrDefault(self.inputCols) if c in df.columns]
        m = ModeImputerModel()
        m._set(inputCols=cols, stats=json.dumps(modes(df, cols), default=str))
        return m


class MedianImputer(Estimator, _StatsParams, DefaultParamsReadable, DefaultParamsWritable):
    """Median of every numeric column (exact, one aggregate)."""

    @keyword_only
    def __init__(self, inputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> MedianImputerModel:
        cols = [c for c in self.getOrDefault(self.inputCols) if c in df.columns]
        m = MedianImputerModel()
        m._set(inputCols=cols, stats=json.dumps(medians(df, cols)))
        return m


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NumericType) and f.name not in set(exclude)]


def other_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields
            if not isinstance(f.dataType, NumericType) and f.name not in set(exclude)]


class _MediansWriter(DefaultParamsWriter):
    """Saves the group medians as a table beside the model's parameters."""

    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        self.instance.medians().write.mode("overwrite").parquet(f"{path}/medians")


class _MediansReader(DefaultParamsReader):
    def load(self, path: str):
        model = super().load(path)
        return model._set(table=f"{path}/medians")


class GroupMedianImputerModel(Model, _StatsParams, MLReadable, MLWritable):
    """Fills from a table (g, m) with one row per level, joined at transform;
    it may have any number of levels."""

    groupCol = Param(Params._dummy(), "groupCol", "group column", TypeConverters.toString)
    table = Param(Params._dummy(), "table", "folder of the group medians", TypeConverters.toString)

    def __init__(self):
        super().__init__()

    def write(self):
        return _MediansWriter(self)

    @classmethod
    def read(cls):
        return _MediansReader(cls)

    def medians(self) -> DataFrame:
        spark = SparkSession.active()
        if not self.isDefined(self.table):
            return spark.createDataFrame([], "g string, m double")
        return spark.read.schema("g string, m double").parquet(self.getOrDefault(self.table))

    def _transform(self, df: DataFrame) -> DataFrame:
        c = self.getOrDefault(self.inputCols)[0]
        g = self.getOrDefault(self.groupCol)
        if c not in df.columns:
            return df
        fill = F.lit(self._stats()["global"]).cast("double")
        if g not in df.columns or not self.isDefined(self.table):
            return df.withColumn(c, F.coalesce(to_num(c), fill))
        table = self.medians().select(F.col("g").alias("_mg"), F.col("m").alias("_gm"))
        j = df.join(table, df[g].cast("string") == table["_mg"], "left")
        return j.withColumn(c, F.coalesce(to_num(c), F.col("_gm"), fill)).drop("_mg", "_gm")


class GroupMedianImputer(Estimator, _StatsParams, DefaultParamsReadable, DefaultParamsWritable):
    """Median of ``inputCol`` per level of ``groupCol``; fallback to the
    global median for missing groups, unseen groups and groups without data."""

    groupCol = Param(Params._dummy(), "groupCol", "group column", TypeConverters.toString)

    @keyword_only
    def __init__(self, inputCol=None, groupCol=None):
        super().__init__()
        kw = dict(self._input_kwargs)
        self._set(inputCols=[kw["inputCol"]], groupCol=kw["groupCol"])

    def _fit(self, df: DataFrame) -> GroupMedianImputerModel:
        c = self.getOrDefault(self.inputCols)[0]
        g = self.getOrDefault(self.groupCol)
        m = GroupMedianImputerModel()
        m._set(inputCols=[c], groupCol=g)
        if c not in df.columns:
            return m._set(stats=json.dumps({"global": 0.0}))
        glob = medians(df, [c])[c]
        m._set(stats=json.dumps({"global": glob if glob is not None else 0.0}))
        if g in df.columns:
            path = f"{checkpoint_dir(df.sparkSession)}/group-medians-{uuid.uuid4().hex}"
            keyed = df.filter(F.col(g).isNotNull()).select(F.col(g).cast("string").alias("g"), to_num(c).alias("_x"))
            grp = quantile_columns(keyed, ["g"], [F.count(F.lit(1)).alias("_n")], [("_x", 0.5, "m")], needs=[])
            grp.filter(F.col("m").isNotNull()).select("g", "m").write.parquet(path)
            m._set(table=path)
        return m


def group_median_fill(df: DataFrame, c: str, by: str, fit_on: DataFrame | None = None
                      ) -> DataFrame:
    """C3 as a pure plan: group medians joined back (no driver round trip).
    The statistics table has one row per level (AQE broadcasts it if small)."""
    src = fit_on if fit_on is not None else df
    x = to_num(c)
    # every row counts for its level and for the whole: both medians from the same passes
    cells = F.explode(F.array(F.struct(F.lit(True).alias("_all"), F.lit(None).cast(src.schema[by].dataType).alias("_by")), F.struct(F.lit(False).alias("_all"), F.col(by).alias("_by"))))
    both = src.select(x.alias("_x"), cells.alias("_c")).select("_x", "_c.*").filter(F.col("_all") | F.col("_by").isNotNull())
    both = cut_lineage(quantile_columns(both, ["_all", "_by"], [F.count(F.lit(1)).alias("_n")], [("_x", 0.5, "_m")], needs=[]).drop("_n"))
    grp = both.filter(~F.col("_all")).select(F.col("_by").alias(by), F.col("_m").alias("_gm"))
    glob = both.agg(F.max(F.when(F.col("_all"), F.col("_m"))).alias("_glob"))
    j = df.join(grp, by, "left").join(F.broadcast(glob), how="inner")
    return j.withColumn(c, F.coalesce(to_num(c), F.col("_gm"), F.col("_glob"))) \
            .drop("_gm", "_glob")


def defaults_profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One default per expected column as text: median for numbers,
    mode for text, 'NA' when the column has no value, NULL when absent."""
    spark = df.sparkSession
    present = [c for c in cols if c in df.columns]
    num = set(numeric_columns(df))
    if present:
        middle = medians(df, [c for c in present if c in num])
        text_modes = modes(df, [c for c in present if c not in num])
        wide = spark.range(1).select(*[F.coalesce(F.lit(middle[c]).cast("double").cast("string") if c in num
                                                  else F.lit(text_modes[c]).cast("string"), F.lit("NA")).alias(c) for c in present])
        long = wide.unpivot([], present, "feature", "default")
    else:
        long = spark.createDataFrame([], "feature string, default string")
    absent = [c for c in cols if c not in df.columns]
    if absent:
        long = long.unionByName(spark.createDataFrame(
            [(c, None) for c in absent], "feature string, default string"))
    return long


def apply_defaults(df: DataFrame, defaults: dict, schema_of: DataFrame | None = None
                   ) -> DataFrame:
    """Complete partial scoring rows: user value wins, else the default;
    absent columns are created from the defaults."""
    out = df
    for c, v in defaults.items():
        if c in out.columns:
            dtype = out.schema[c].dataType
            # the default of an integer column may lie between two integers
            to = "double" if isinstance(dtype, IntegralType) else dtype
            out = out.withColumn(c, F.coalesce(F.col(f"`{c}`").cast(to), F.lit(v).cast(to)))
        else:
            dtype = schema_of.schema[c].dataType if schema_of is not None and \
                c in schema_of.columns else None
            out = out.withColumn(c, F.lit(v).cast(dtype) if dtype else F.lit(v))
    return out


class FillTransformer(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """C1 + C2 + C4 as one persistable pipeline stage."""

    noneCols = Param(Params._dummy(), "noneCols", "text columns", TypeConverters.toListString)
    zeroCols = Param(Params._dummy(), "zeroCols", "numeric columns", TypeConverters.toListString)
    fromPairs = Param(Params._dummy(), "fromPairs", "target:source pairs",
                      TypeConverters.toListString)

    @keyword_only
    def __init__(self, noneCols=None, zeroCols=None, fromPairs=None):
        super().__init__()
        self._setDefault(noneCols=[], zeroCols=[], fromPairs=[])
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        d = fill_constant(df, self.getOrDefault(self.noneCols))
        d = fill_zero(d, self.getOrDefault(self.zeroCols))
        for pair in self.getOrDefault(self.fromPairs):
            a, b = pair.split(":", 1)
            d = fill_from_column(d, a, b)
        return d
