"""Benchmark decontamination as a prefix-filtered set join.

Every item gives windows of ``window`` consecutive words. A window is the ordered set of its
shingles (runs of up to ``shingle`` words). A text contains the window only if it contains all of
them, so with the shingles ordered by their rarity in the corpus a prefix of length one is enough:
the rarest shingle. Texts emit only shingles that are some window's prefix, the join on it gives
candidates at one exact place in the text, the place and the window's length must fit in the
text, and the words there must equal the window's.

Tasks test shingles against a bit table of fixed size built from the items, so what they carry
does not grow with either side; a false hit of the table is dropped by the join.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearth.llm.common import as_long, key_field, key_of, materialize, row_key, run_hashes, span_hashes, spans_of, text_slices

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.zeros(256, bool)
_IS_WORD[0x30:0x3A] = _IS_WORD[0x61:0x7B] = _IS_WORD[0x80:] = True
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
#: bits of the table that tasks test shingles against (2 MB)
TABLE_BITS = 1 << 24


def _words(data: np.ndarray, offsets: np.ndarray):
    data = _LOWER[data]
    starts, ends, first = spans_of(_IS_WORD[data], offsets)
    return data, span_hashes(data, starts, ends), first


def windows(items: DataFrame, window: int, shingle: int, id_col: str, text_col: str) -> DataFrame:
    """Distinct windows: ``text``, number of words ``n``, its ``items`` and shingle ``hashes``."""
    kind = items.schema[id_col].dataType

    def work(batches):
        for batch in batches:
            ids = batch.column(0)
            for at, rows, data, offsets in text_slices(batch, "t"):
                data, words, first = _words(data, offsets)
                raw = data.tobytes()
                own, texts, sizes, hashes = [], [], [], []
                for i in range(rows):
                    w = _WORD.findall(raw[offsets[i]:offsets[i + 1]])
                    n = min(window, len(w))
                    if not n:
                        continue
                    h = as_long(run_hashes(words[first[i]:first[i + 1]], np.array([0, len(w)]), min(shingle, n))[0]).tolist()
                    k = n - min(shingle, n) + 1
                    for s in range(len(w) - n + 1):
                        own.append(at + i)
                        texts.append(b" ".join(w[s:s + n]).decode())
                        sizes.append(n)
                        hashes.append(h[s:s + k])
                yield pa.record_batch([ids.take(pa.array(own, pa.int64())), pa.array(texts, pa.string()), pa.array(sizes, pa.int32()), pa.array(hashes, pa.list_(pa.int64()))], names=["item", "window", "n", "hashes"])

    schema = T.StructType([T.StructField("item", kind), T.StructField("window", T.StringType()), T.StructField("n", T.IntegerType()), T.StructField("hashes", T.ArrayType(T.LongType()))])
    found = items.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("item"), F.col(text_col).alias("t")).mapInArrow(work, schema)
    return found.groupBy("window").agg(F.first("n").alias("n"), F.first("hashes").alias("hashes"), F.collect_set("item").alias("items"))


def _bit_table(hashes: DataFrame) -> np.ndarray:
    """Bits of the hashes in a table of fixed size; at most TABLE_BITS / 64 rows come back."""
    slot = F.col("h").bitwiseAND(F.lit(TABLE_BITS - 1))
    rows = (
        hashes.groupBy(F.shiftright(slot, 6).alias("at"))
        .agg(F.bit_or(F.expr(f"shiftleft(1L, cast((h & {TABLE_BITS - 1}) & 63 as int))")).alias("bits"))
        .collect()
    )
    table = np.zeros(TABLE_BITS // 64, np.int64)
    if rows:
        table[[r["at"] for r in rows]] = [r["bits"] for r in rows]
    return table.view(np.uint64)


def _hits(words: np.ndarray, first: np.ndarray, sizes: list[int], table: np.ndarray):
    """Shingles of the given sizes that the table holds: ``(size, hash, position)`` arrays."""
    for k in sizes:
        h, at = run_hashes(words, first, k)
        slot = h & np.uint64(TABLE_BITS - 1)
        hit = np.flatnonzero(table[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63)) & np.uint64(1))
        yield k, h[hit], at[hit]


def _counts(docs: DataFrame, text_col: str, sizes: list[int], table) -> DataFrame:
    """How often the texts hold each shingle of the items (and the few others with the same bit)."""
    def work(batches):
        for batch in batches:
            for _, _, data, offsets in text_slices(batch, "t"):
                _, words, first = _words(data, offsets)
                found = [h for _, h, _ in _hits(words, first, sizes, table.value)]
                h, n = np.unique(np.concatenate(found or [np.zeros(0, np.uint64)]), return_counts=True)
                yield pa.record_batch([pa.array(as_long(h)), pa.array(n.astype(np.int64))], names=["h", "n"])

    return docs.select(F.col(text_col).alias("t")).mapInArrow(work, "h long, n long").groupBy("h").agg(F.sum("n").alias("seen"))


def _scan(docs: DataFrame, id_col: str, text_col: str, window: int, sizes: list[int], table, key_col: str | None = None) -> DataFrame:
    """One row per text: its number of words and the prefix shingles in it with the words around."""
    hit_type = pa.struct([("h", pa.int64()), ("at", pa.int64()), ("lo", pa.int64()), ("words", pa.string())])

    def work(batches):
        for batch in batches:
            for at, rows, data, offsets in text_slices(batch, "t"):
                data, words, first = _words(data, offsets)
                out: list[list] = [[] for _ in range(rows)]
                raw, known = data.tobytes(), {}
                for k, hashes, places in _hits(words, first, sizes, table.value):
                    for h, p, row in zip(as_long(hashes).tolist(), places.tolist(), (np.searchsorted(first, places, "right") - 1).tolist()):
                        if row not in known:
                            known = {row: _WORD.findall(raw[offsets[row]:offsets[row + 1]])}
                        q = p - int(first[row])
                        lo = max(0, q - (window - k))
                        out[row].append({"h": h, "at": q, "lo": lo, "words": b" ".join(known[row][lo:q + window]).decode()})
                own = batch.slice(at, rows)
                yield pa.record_batch([own.column(0), own.column(1), pa.array(np.diff(first)), pa.array(out, pa.list_(hit_type))], names=["id", "key", "n_words", "hits"])

    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), key_field(docs, key_col), T.StructField("n_words", T.LongType()), T.StructField("hits", T.ArrayType(T.StructType([
        T.StructField("h", T.LongType()), T.StructField("at", T.LongType()), T.StructField("lo", T.LongType()), T.StructField("words", T.StringType())])))])
    return docs.select(F.col(id_col).alias("id"), key_of(docs, key_col, text_col), F.col(text_col).alias("t")).mapInArrow(work, schema)


def decontaminate(docs: DataFrame, items: DataFrame, window: int = 10, shingle: int = 3,
                  salts: int = 16, id_col: str = "doc_id", text_col: str = "text",
                  item_id: str = "item_id", item_text: str = "text", key_col: str | None = None) -> DataFrame:
    """One row for every row of ``docs``: ``id, key, n_words, n_hit, item_ids, spans``.

    Words are runs of ASCII letters and digits and of all characters beyond ASCII, A-Z lower-cased.
    A window is ``window`` consecutive words of an item; an item of fewer words, but not none, is
    one window. ``n_hit`` counts the words of the text inside any occurrence of a window,
    ``item_ids`` are the items with occurring windows and ``spans`` the occurrences as
    ``(start word, words)``; ``key`` is the row's ``key_col``, by default a hash of the text. Null, empty and blank texts have no words and no hits; items with a
    null id are left out; an empty item table hits nothing; repeated rows and ids each keep
    their own result; a window shared by many items names them all. Other columns are not used.
    """
    spark = docs.sparkSession
    grams = materialize(windows(items, window, shingle, item_id, item_text), "windows")
    sizes = sorted(r[0] for r in grams.select(F.least(F.lit(shingle), "n")).distinct().collect())
    each = grams.select("window", F.posexplode("hashes").alias("offset", "h"))
    table = spark.sparkContext.broadcast(_bit_table(each))
    seen = _counts(docs, text_col, sizes, table)
    # the prefix: the rarest shingle of the window, ties by hash and place
    ranked = each.join(seen, "h").groupBy("window").agg(
        F.count("*").alias("held"), F.min(F.struct("seen", "h", "offset")).alias("rarest"))
    prefix = materialize(
        grams.join(ranked, "window").filter(F.col("held") == F.size("hashes"))
        .select("window", "n", "items", F.col("rarest.h").alias("h"), F.col("rarest.offset").alias("offset")), "prefix")
    table = spark.sparkContext.broadcast(_bit_table(prefix))
    base = materialize(row_key(_scan(docs, id_col, text_col, window, sizes, table, key_col)), "scan")

    salted = prefix.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    hits = base.select("_row", "n_words", F.explode("hits").alias("x")).select("_row", "n_words", "x.*")
    hits = hits.withColumn("salt", F.pmod(F.xxhash64("_row", "at"), F.lit(salts)).cast("int"))
    place = F.col("at") - F.col("offset")
    there = F.array_join(F.slice(F.split("words", " "), (place - F.col("lo") + 1).cast("int"), F.col("n")), " ")
    fits = (place >= 0) & (place + F.col("n") <= F.col("n_words")) & (place >= F.col("lo"))
    found = (
        hits.join(salted, ["h", "salt"]).filter(fits)
        .filter(F.when(fits, there) == F.col("window"))
        .groupBy("_row").agg(F.collect_set(F.struct(place.alias("start"), F.col("n").cast("long").alias("n"))).alias("spans"),
                             F.array_distinct(F.flatten(F.collect_set("items"))).alias("item_ids"))
    )
    spans = F.sort_array(F.coalesce("spans", F.array().cast("array<struct<start:bigint,n:bigint>>")))
    covered = F.aggregate(
        spans, F.struct(F.lit(0).cast("long").alias("hit"), F.lit(0).cast("long").alias("to")),
        lambda a, s: F.struct(
            (a["hit"] + F.greatest(F.lit(0), s["start"] + s["n"] - F.greatest(a["to"], s["start"]))).alias("hit"),
            F.greatest(a["to"], s["start"] + s["n"]).alias("to")),
        lambda a: a["hit"])
    return base.join(found, "_row", "left").select(
        "id", "key", "n_words", covered.alias("n_hit"),
        F.coalesce("item_ids", F.array().cast(T.ArrayType(items.schema[item_id].dataType))).alias("item_ids"),
        spans.alias("spans"))
