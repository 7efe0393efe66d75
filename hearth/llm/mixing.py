"""Mixing sources to target weights: blocks of words, drawn slots, and a join by block index.

The documents of a source, in a seeded order, are one stream of words cut into blocks of ``block``
words (the last one shorter). A source's target in words gives its number of slots in the mix.
Slots are dealt to output shards by multinomial draws, shard after shard, weighted by the slots that
each source still has to place, so every source gets its number exactly. Slot k of a source with
n blocks is in round k div n, and the round's own pseudorandom permutation of 0..n-1 (a Feistel
network, walked until it falls into the range) maps k mod n to a block. No block comes again
before all of its source have come, and none more often than the targets allow. Slots
and blocks meet in a join on (source, index), keys that are alike in size whatever the sources' sizes.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.llm.common import materialize, mix as spread
from hearth.llm.order import running

#: slots that one row of a task stands for
CHUNK = 1 << 16
_WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: Sequence[int], weights: Sequence[float], repeats: int) -> list[float]:
    """Words of each source: shares of all words by weight, at most ``repeats`` times its own;
    what is above goes to the others by weight until none is above."""
    capped = [False] * len(sizes)
    while True:
        left = sum(sizes) - sum(float(repeats * s) for s, c in zip(sizes, capped) if c)
        weight = sum(w for w, c in zip(weights, capped) if not c)
        out = [float(repeats * s) if c else left * w / weight for s, w, c in zip(sizes, weights, capped)]
        above = [not c and t > repeats * s for t, s, c in zip(out, sizes, capped)]
        if not any(above):
            return out
        capped = [c or a for c, a in zip(capped, above)]


def draw(slots: Sequence[int], shards: int, seed: int) -> np.ndarray:
    """Slots of every source (columns) in every shard (rows); shards have equally many, at most one apart.

    Each shard's counts are multinomial with the sources' remaining slots as weights; what a draw
    takes beyond the remaining slots is drawn again among the others.
    """
    rng = np.random.default_rng(seed)
    left = np.array(slots, np.int64)
    total = int(left.sum())
    out = np.zeros((shards, len(left)), np.int64)
    for i in range(shards):
        want = total * (i + 1) // shards - total * i // shards
        while want:
            got = np.minimum(rng.multinomial(want, left / left.sum()), left)
            out[i] += got
            left -= got
            want -= int(got.sum())
    return out


def permuted(k: np.ndarray, n: int, key: int) -> np.ndarray:
    """Images of ``k`` under the pseudorandom permutation of 0..n-1 that ``key`` names."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    low = np.uint64((1 << half) - 1)
    rounds = [np.uint64((key * 4 + r) * 0x9E3779B97F4A7C15 & (1 << 64) - 1) for r in range(4)]
    x = k.astype(np.uint64)
    todo = np.arange(len(x))
    while len(todo):
        a, b = x[todo] >> np.uint64(half), x[todo] & low
        for r in rounds:
            a, b = b, a ^ (spread(b + r) & low)
        x[todo] = a << np.uint64(half) | b
        todo = todo[x[todo] >= n]
    return x.astype(np.int64)


def _slots(chunks: DataFrame, seed: int) -> DataFrame:
    """``shard, slot, src, index`` of every slot of the chunks (shard, src, held, place, first, count)."""
    def work(batches):
        for batch in batches:
            for r in batch.to_pylist():
                k = np.arange(r["first"], r["first"] + r["count"])
                turn, at = k // r["held"], k % r["held"]
                index = np.concatenate([permuted(at[turn == t], r["held"], (seed << 40) + (r["src"] << 8) + int(t)) for t in np.unique(turn)])
                yield pa.record_batch({"shard": pa.array(np.full(len(k), r["shard"], np.int32)), "slot": pa.array(np.arange(r["place"], r["place"] + r["count"])),
                                       "src": pa.array(np.full(len(k), r["src"], np.int32)), "index": pa.array(index)})

    return chunks.mapInArrow(work, "shard int, slot long, src int, index long")


class Mix:
    """What ``mix`` returns: ``rows`` (row, id, size, source, source_size, target) of all documents,
    ``sources`` (source, size, target, slots) as a list, and ``pieces`` (shard, slot, part, row, id,
    begin, words) of the mix: words ``begin`` to ``begin + words`` of a document. Slots count from 0
    in a shard; pieces of a slot are ordered by ``part``."""

    def __init__(self, rows: DataFrame, sources: list[tuple], pieces: DataFrame):
        self.rows, self.sources, self.pieces = rows, sources, pieces

    def taken(self) -> DataFrame:
        """Every row with the words that the mix takes of it, repeats counted."""
        sums = self.pieces.groupBy("row").agg(F.sum("words").alias("taken"))
        return self.rows.join(sums, "row", "left").withColumn("taken", F.coalesce("taken", F.lit(0).cast("long")))

    def texts(self) -> DataFrame:
        """The pieces with their words, joined by single spaces (of a mix made with ``texts``)."""
        words = F.regexp_extract_all(F.col("text"), F.lit(f"({_WORD})"), F.lit(0))
        own = F.slice(words, (F.col("begin") + 1).cast("int"), F.col("words").cast("int"))
        return self.pieces.join(self.rows.select("row", "text"), "row").withColumn("text", F.array_join(own, " "))


def mix(docs: DataFrame, shards: int = 64, block: int = 128, weights: Sequence[float] = (1, 2, 3), repeats: int = 3, seed: int = 42,
        texts: bool = False, most_sources: int = 10_000, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> Mix:
    """Mix all documents to the sources' weights.

    Words are runs of other characters than space and U+0009 to U+000D; a null text has none.
    Sources by code point, null last (a source of its own), weigh ``weights`` in turn. The driver
    holds a few numbers for every source; more than ``most_sources`` raise. Documents without words
    and sources without words take no part but are in ``rows``. Ids may be null or repeat: rows
    are told apart, and rows that agree in id, text and source are interchangeable. The same table
    and seed give the same mix. ``texts`` keeps the texts for ``Mix.texts``. An empty table gives empty results; other columns are not used.
    """
    spark = docs.sparkSession
    source = F.col(source_col).cast("string")
    # as a byte order: "=" before each name, the null source behind them
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), source.alias("source"),
                       F.coalesce(F.concat(F.lit("="), source), F.lit("~")).alias("stratum"),
                       F.coalesce(F.regexp_count(F.col(text_col), F.lit(_WORD)), F.lit(0)).cast("long").alias("size"),
                       F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col)).alias("shuffled"), *([F.col(text_col).alias("text")] if texts else []))
    rows = materialize(rows, "sizes")
    found = rows.groupBy("stratum").agg(F.sum("size").alias("n")).orderBy("stratum").limit(most_sources + 1).collect()
    if len(found) > most_sources:
        raise ValueError(f"more than {most_sources} sources: give the mixture fewer, larger ones")
    sizes = [r["n"] for r in found]
    goal = targets(sizes, [float(weights[i % len(weights)]) for i in range(len(found))], repeats) if sum(sizes) else [0.0] * len(found)
    blocks = [-(-n // block) for n in sizes]
    # in words of the source's mean block, so that its short one does not weigh
    slots = [min(repeats * b, round(t * b / n)) if n else 0 for n, t, b in zip(sizes, goal, blocks)]
    schema = "stratum string, src int, source_size long, target double"
    known = F.broadcast(spark.createDataFrame([(r["stratum"], i, n, t) for i, (r, n, t) in enumerate(zip(found, sizes, goal))], schema))
    rows = rows.join(known, "stratum")

    streams = running(rows.filter("size > 0").select("src", "shuffled", "id", "size", "row"), "src", ["shuffled", "id", "size", "row"], "size", label="streams")
    parts = streams.select("src", "row", "id", "start", "size", F.explode(F.expr(f"sequence(start div {block}, (start + size - 1) div {block})")).alias("index"))
    begin, end = F.greatest("start", F.col("index") * block), F.least(F.col("start") + F.col("size"), (F.col("index") + 1) * block)
    parts = parts.select("src", "index", "row", "id", begin.alias("part"), (begin - F.col("start")).alias("begin"), (end - begin).alias("words"))

    counts = draw(slots, shards, seed)
    first, place = np.cumsum(counts, 0) - counts, np.cumsum(counts, 1) - counts
    dealt = [(i, s, blocks[s], int(place[i, s]), int(first[i, s]), int(counts[i, s])) for i in range(shards) for s in np.flatnonzero(counts[i]).tolist()]
    dealt = spark.createDataFrame(dealt, "shard int, src int, held long, place long, first long, count long")
    chunks = dealt.select("shard", "src", "held", "place", "first", "count", F.explode(F.expr(f"sequence(0L, count - 1, {CHUNK}L)")).alias("skip"))
    chunks = chunks.select("shard", "src", "held", *[(F.col(c) + F.col("skip")).alias(c) for c in ("place", "first")], F.least(F.col("count") - F.col("skip"), F.lit(CHUNK)).alias("count"))
    tasks = 1 + sum(slots) // (16 * CHUNK)
    drawn = _slots(chunks.repartition(tasks, "shard", "src", "first"), seed)
    # the few rows that slots come from say nothing of their number: both sides are sorted, none is broadcast
    pieces = drawn.hint("merge").join(parts, ["src", "index"]).select("shard", "slot", "part", "row", "id", "begin", "words")
    return Mix(rows.drop("stratum", "src", "shuffled"), [(r["stratum"][1:] if r["stratum"] != "~" else None, n, t, k) for r, n, t, k in zip(found, sizes, goal, slots)], pieces)
