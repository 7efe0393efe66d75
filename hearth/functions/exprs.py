from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

__all__ = [
    "col_of", "flag", "ne_flag", "clip_lower", "to_num", "nan_to_null", "na_tokens_to_null",
    "DEFAULT_NA_TOKENS", "hash_uniform", "hash_bucket", "hash_key", "right_closed_bin",
    "left_closed_bin", "at_or_below", "rnd", "safe_div", "log1p0", "unlog",
]

# Tokens that pandas' CSV reader treats as missing by default.
DEFAULT_NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def flag(cond: Column) -> Column:
    """0/1 flag where a comparison with a missing value counts as False."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def ne_flag(a: str | Column, b: str | Column) -> Column:
    """0/1 inequality flag where a missing side counts as *different*."""
    return F.coalesce(col_of(a) != col_of(b), F.lit(True)).cast("int")


def clip_lower(c: str | Column, lo: float = 0) -> Column:
    """``clip(lower=lo)`` that keeps NULL (``greatest`` would turn it into lo)."""
    x = col_of(c)
    return F.when(x < lo, F.lit(lo)).otherwise(x)


def to_num(c: str | Column, dtype: str = "double") -> Column:
    """``to_numeric(errors='coerce')``: text that is not a number becomes NULL."""
    return col_of(c).try_cast(dtype)


def nan_to_null(c: str | Column) -> Column:
    """NaN -> NULL so that aggregates skip it like pandas does."""
    x = col_of(c)
    return F.when(F.isnan(x), F.lit(None)).otherwise(x)


def na_tokens_to_null(c: str | Column, tokens: Iterable[str] = DEFAULT_NA_TOKENS) -> Column:
    x = col_of(c)
    return F.when(x.isin(list(tokens)), F.lit(None).cast("string")).otherwise(x)


def hash_key(id_col: str | Column, seed: int) -> Column:
    """32-bit unsigned integer from md5(id:seed); identical in DuckDB via
    ``('0x' || substr(md5(id::varchar || ':seed'), 1, 8))::BIGINT``."""
    key = F.concat_ws(":", col_of(id_col).cast("string"), F.lit(str(seed)))
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint")


def hash_uniform(id_col: str | Column, seed: int) -> Column:
    """Deterministic uniform in [0, 1) that does not depend on partitioning."""
    return hash_key(id_col, seed) / F.lit(4294967296.0)


def hash_bucket(id_col: str | Column, seed: int, k: int) -> Column:
    return F.pmod(hash_key(id_col, seed), F.lit(k)).cast("int")


def right_closed_bin(x: str | Column, edges: Column) -> Column:
    """qcut/cut index (1-based) on sorted edges: bins are (a, b], the first
    bin also holds the minimum. Values above the last edge land in the last
    bin, so callers filter out-of-range rows when that matters."""
    xc = col_of(x)
    return F.when(xc.isNull(), F.lit(None)).otherwise(
        F.greatest(F.lit(1), F.size(F.filter(edges, lambda e: e < xc))))


def left_closed_bin(x: str | Column, edges: Column) -> Column:
    """np.histogram index (1-based): [a, b) bins, the last one closed."""
    xc = col_of(x)
    n = F.size(edges)
    return F.least(F.size(F.filter(edges, lambda e: e <= xc)), n - 1)


def at_or_below(edges: Column, x: Column, strict: bool = False, most: int = 1023) -> Column:
    """Number of the sorted ``edges`` (at most ``most``) at or below ``x``, or with ``strict`` below
    it, found by halving: an index beyond the array compares as NULL."""
    step, steps = 1, []
    while step <= most:
        steps.insert(0, F.lit(step))
        step *= 2

    def halved(at: Column, s: Column) -> Column:
        e = F.get(edges, at + s - 1)
        return at + F.when(e < x if strict else e <= x, s).otherwise(F.lit(0))

    return F.when(x.isNotNull(), F.aggregate(F.array(*steps), F.lit(0), halved))


def rnd(c: str | Column, digits: int = 6) -> Column:
    return F.round(col_of(c).cast("double"), digits)


def safe_div(a: str | Column, b: str | Column) -> Column:
    return F.try_divide(col_of(a), col_of(b))


def log1p0(c: str | Column) -> Column:
    """log1p of the value clipped at 0 (NULL stays NULL)."""
    return F.log1p(clip_lower(c, 0))


def unlog(c: str | Column) -> Column:
    """Back from log space: max(expm1(x), 0); NULL stays NULL (Spark's
    greatest() would skip it)."""
    x = col_of(c)
    return F.when(x.isNull(), F.lit(None).cast("double")).otherwise(
        F.greatest(F.expm1(x), F.lit(0.0)))
