"""Helpers shared by the training-data operators: shared tables, Arrow text access, hashing."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: white space that separates words in most contracts: space and U+0009..U+000D
SPACES = "\t\n\x0b\x0c\r"
#: rows of text handled at once inside a task, in bytes
CHUNK_BYTES = 1 << 20


def shared_dir(spark: SparkSession) -> str:
    """Folder that all executors share: ``spark.checkpoint.dir`` of the session.

    Only a local master (driver and executors are one process) may leave it unset; a
    scratch folder is then created and noted in the session for later calls.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("hearth.llm.dir", None)
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="hearth-llm-")
    spark.conf.set("hearth.llm.dir", path)
    return path


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: lineage ends at the files."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def row_key(df: DataFrame, name: str = "_row") -> DataFrame:
    """A key for each input row, so that repeated ids and rows stay apart.

    Only stable once the frame is materialised; every caller does that before using it twice.
    """
    return df.withColumn(name, F.monotonically_increasing_id())


def key_of(df: DataFrame, key_col: str | None, text_col: str) -> Column:
    """What an operator returns as ``key``: the caller's column, or a hash of the text."""
    return (F.xxhash64(F.col(text_col)) if key_col is None else F.col(key_col)).alias("key")


def key_field(df: DataFrame, key_col: str | None) -> T.StructField:
    return T.StructField("key", T.LongType() if key_col is None else df.schema[key_col].dataType)


def text_slices(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES):
    """Yield ``(first row, rows, bytes, offsets)`` of runs of rows with at most ``limit`` bytes.

    A longer text is a run of its own. Null texts count as empty. ``bytes`` is a uint8 view of
    the UTF-8 text and ``offsets`` the row bounds in it.
    """
    col = pc.fill_null(batch.column(batch.schema.get_field_index(column)), "")
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    kind = np.int64 if pa.types.is_large_string(col.type) else np.int32
    n = len(col)
    if not n:
        return
    offs = np.frombuffer(col.buffers()[1], kind)[col.offset:col.offset + n + 1].astype(np.int64)
    data = col.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        end = int(np.searchsorted(offs, offs[at] + limit, "right")) - 1
        end = min(max(end, at + 1), n)
        yield at, end - at, raw[offs[at]:offs[end]], offs[at:end + 1] - offs[at]
        at = end


def spans_of(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true bytes, and for each row the index of its first run.

    A run never crosses a row bound. The last array has one entry more than there are rows.
    """
    n = len(mask)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = mask[:-1]
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = mask[1:]
    starts = np.flatnonzero(mask & (~before | cut[:n]))
    ends = np.flatnonzero(mask & (~after | cut[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


_RNG = np.random.default_rng(20240607)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = _RNG.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads the bits of 64-bit hashes."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every span of bytes, without a Python loop over spans."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lens = ends - starts
    first = np.concatenate(([0], np.cumsum(lens)[:-1]))
    total = int(lens.sum())
    place = np.arange(total) - np.repeat(first, lens)
    power = np.full(int(lens.max()), _BASE, np.uint64)
    power[0] = 1
    power = np.cumprod(power, dtype=np.uint64)
    value = _BYTE[data[place + np.repeat(starts, lens)]] * power[place]
    return mix(np.add.reduceat(value, first) + lens.astype(np.uint64) * _BASE)


def run_hashes(words: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` consecutive words that stay inside a row, and their positions."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    x = np.full(n, np.uint64(k) * _STEP[63], np.uint64)
    for j in range(k):
        x += words[j:j + n] * _STEP[j]
    whole = np.ones(len(words) + 1, bool)
    for end in range(1, k):
        stop = bounds[1:] - end
        whole[stop[stop >= bounds[:-1]]] = False
    at = np.flatnonzero(whole[:n])
    return mix(x[at]), at


def as_long(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


__all__ = ["CHUNK_BYTES", "SPACES", "as_long", "key_field", "key_of", "materialize", "mix", "read_table", "row_key",
           "run_hashes", "shared_dir", "span_hashes", "spans_of", "text_slices"]
