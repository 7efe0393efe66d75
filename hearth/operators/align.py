"""Projections, filters and predicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from hearth.functions.exprs import to_num, unlog
from hearth.operators.quantiles import exact_quantiles


def align_schema(df: DataFrame, expected: Sequence[str], id_col: str,
                 fill=0) -> tuple[DataFrame, list[str], list[str]]:
    """B1: exactly the expected feature columns in order (absent -> ``fill``),
    extras dropped, key first.  Returns (frame, missing, extra)."""
    if id_col not in df.columns:
        raise ValueError(f"id column {id_col!r} is required")
    present = set(df.columns)
    missing = [c for c in expected if c not in present]
    extra = [c for c in df.columns if c not in set(expected) and c != id_col]
    cols = [F.col(id_col)] + [
        (F.col(f"`{c}`") if c in present else F.lit(fill)).alias(c) for c in expected]
    return df.select(*cols), missing, extra


def to_numeric(df: DataFrame, cols: Sequence[str], dtype: str = "double") -> DataFrame:
    """B2: text that is not a number becomes NULL (no ANSI error)."""
    s = set(cols)
    return df.select(*[to_num(c, dtype).alias(c) if c in s else F.col(f"`{c}`")
                       for c in df.columns])


def log_target(df: DataFrame, target: str, out: str = "label") -> DataFrame:
    """label = log1p(target)."""
    return df.withColumn(out, F.log1p(F.col(target).cast("double")))


def unlog_pred(df: DataFrame, pred: str, out: str = "pred") -> DataFrame:
    """Back-transform max(expm1(p), 0)."""
    return df.withColumn(out, unlog(pred))


def thresholds(df: DataFrame, c: str, probs: list[float], names: list[str]) -> DataFrame:
    """One row with the requested exact quantiles of ``c``."""
    q = exact_quantiles(df, c, probs, out="_q")
    return q.select(*[F.col("_q")[i].alias(n) for i, n in enumerate(names)])


def trim_quantiles(df: DataFrame, c: str, lo: float = 0.01, hi: float = 0.99) -> DataFrame:
    """Keep rows between the lo and hi quantiles (inclusive).  The bound
    row is one aggregate, joined by broadcast."""
    b = thresholds(df, c, [lo, hi], ["_lo", "_hi"])
    return (df.join(F.broadcast(b), how="inner")
            .filter(F.col(c).between(F.col("_lo"), F.col("_hi"))).drop("_lo", "_hi"))


def segment_by_threshold(df: DataFrame, c: str, rule: str = "median", value: float | None = None,
                         out: str = "segment", labels: tuple[str, str] = ("high", "low")
                         ) -> DataFrame:
    """Two-level segment. rule 'fixed' (c > value), 'median' (c > median),
    'top_quartile' (c >= P75)."""
    x = F.col(c)
    if rule == "fixed":
        cond, j = x > F.lit(value), df
    else:
        p = 0.5 if rule == "median" else 0.75
        j = df.join(F.broadcast(thresholds(df, c, [p], ["_t"])), how="inner")
        cond = x > F.col("_t") if rule == "median" else x >= F.col("_t")
    return j.withColumn(out, F.when(cond, F.lit(labels[0])).otherwise(F.lit(labels[1]))) \
            .drop("_t")


def flag_top_share(df: DataFrame, c: str, share: float = 0.95, out: str = "is_top") -> DataFrame:
    """1 for rows at or above the ``share`` quantile of ``c``."""
    t = thresholds(df, c, [share], ["_t"])
    return (df.join(F.broadcast(t), how="inner")
            .withColumn(out, F.coalesce(F.col(c) >= F.col("_t"), F.lit(False)).cast("int"))
            .drop("_t"))


def drop_missing(df: DataFrame, subset: Sequence[str], numeric: bool = True) -> DataFrame:
    """Drop rows without a usable (numeric) value in ``subset``."""
    d = to_numeric(df, subset) if numeric else df
    return d.na.drop(subset=list(subset))


def schema_diff(spark: SparkSession, ref: DataFrame | Sequence[str],
                cur: DataFrame | Sequence[str], target: str | None = None) -> DataFrame:
    """Columns missing from / new in the current frame (target ignored).
    Works on schemas only: no data is read."""
    a = list(ref.columns if isinstance(ref, DataFrame) else ref)
    b = list(cur.columns if isinstance(cur, DataFrame) else cur)
    rows = ([(c, "missing") for c in a if c not in set(b) and c != target]
            + [(c, "new") for c in b if c not in set(a) and c != target])
    schema = StructType([StructField("feature", StringType()), StructField("change", StringType())])
    return spark.createDataFrame(rows, schema)


def with_default_columns(df: DataFrame, cols: Sequence[str], value=0) -> DataFrame:
    """Create absent input columns as ``value`` before arithmetic."""
    out = df
    for c in cols:
        if c not in out.columns:
            out = out.withColumn(c, F.lit(value))
    return out
