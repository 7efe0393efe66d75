"""SimHash near-duplicates by multi-index hashing.

Fingerprints of whole texts are computed once per row. Rows collapse to distinct
fingerprints, so a group of copies of any size is one entry from then on. Each fingerprint is
entered in one table per segment and probes the tables with every key of a small Hamming ball
around its own segments; with segment radii that add up to ``max_bits - segments + 1`` a pair
within ``max_bits`` always meets in some table. Matches are verified on all bits.

A table entry that holds more than ``bucket_limit`` fingerprints would make pairs grow with its
square. The fingerprints that meet such an entry are instead linked through midpoints: two
fingerprints lie within ``max_bits`` exactly if some 64-bit value lies within half of that of
both, so each emits the values around it and every value links its holders to the smallest one.
That work is a fixed number of rows a fingerprint, and it loses no link.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearth.llm.common import key_field, key_of, materialize, spans_of, text_slices
from hearth.llm.components import connected_components

#: A-Z to a-z
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.ones(256, bool)
_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)
_BLOCK = 1 << 16


def _majority(hashes: list[int]) -> int:
    """The bits that are set in over half of the hashes."""
    h = np.array(hashes, np.uint64).astype(">u8").view(np.uint8).reshape(-1, 8)
    n, word = len(h), 0
    if n < 256:
        ones = np.unpackbits(h, axis=1).sum(axis=0)
    else:
        ones = np.concatenate([np.bincount(h[:, b], minlength=256) @ _BITS for b in range(8)])
    for bit in ones * 2 > n:
        word = word << 1 | int(bit)
    return word


def fingerprint(text: bytes, shingle: int, seed: int = 42) -> int:
    """Fingerprint of a text whose words are already separated by single spaces."""
    if not text:
        return 0
    ends = np.flatnonzero(np.frombuffer(text, np.uint8) == 32).tolist()
    ends.append(len(text))
    starts = [0, *(e + 1 for e in ends[:-1])]
    n, h = max(1, len(starts) - shingle + 1), xxhash.xxh64_intdigest
    stops = ends[shingle - 1:] if len(ends) >= shingle else ends[-1:]
    if n <= _BLOCK:
        return _majority([h(text[a:b], seed) for a, b in zip(starts, stops)])
    ones = np.zeros(64, np.int64)
    for at in range(0, n, _BLOCK):
        part = np.array([h(text[a:b], seed) for a, b in zip(starts[at:at + _BLOCK], stops[at:at + _BLOCK])], np.uint64)
        part = part.astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.concatenate([np.bincount(part[:, b], minlength=256) @ _BITS for b in range(8)])
    word = 0
    for bit in ones * 2 > n:
        word = word << 1 | int(bit)
    return word


def _joined(data: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    """Each row lower-cased, with its words separated by single spaces."""
    data = _LOWER[data]
    mask = _WORD[data]
    starts, ends, first = spans_of(mask, offsets)
    out = []
    raw = data.tobytes()
    for i in range(len(offsets) - 1):
        row = raw[offsets[i]:offsets[i + 1]]
        words = first[i + 1] - first[i]
        if not words:
            out.append(b"")
            continue
        a, b = starts[first[i]], ends[first[i + 1] - 1]
        # words and single spaces fill the row exactly when nothing has to be rebuilt
        kept = int((ends[first[i]:first[i + 1]] - starts[first[i]:first[i + 1]]).sum())
        if kept + words - 1 == b - a:
            out.append(raw[a:b].translate(_TO_SPACE))
        else:
            out.append(b" ".join(row.translate(_TO_SPACE).split()))
    return out


_TO_SPACE = bytes(32 if i in (9, 10, 11, 12, 13) else i for i in range(256))


def fingerprints(docs: DataFrame, shingle: int = 4, seed: int = 42, id_col: str = "doc_id",
                 text_col: str = "text", key_col: str | None = None) -> DataFrame:
    """``(id, key, fp)`` for every row: the fingerprint as a signed long, and the row's key."""

    def work(batches):
        for batch in batches:
            for at, n, data, offsets in text_slices(batch, "t"):
                fp = np.array([fingerprint(x, shingle, seed) for x in _joined(data, offsets)], np.uint64)
                own = batch.slice(at, n)
                yield pa.record_batch([own.column(0), own.column(1), pa.array(fp.view(np.int64))], names=["id", "key", "fp"])

    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), key_field(docs, key_col), T.StructField("fp", T.LongType())])
    return docs.select(F.col(id_col).alias("id"), key_of(docs, key_col, text_col), F.col(text_col).alias("t")).mapInArrow(work, schema)


def _segments(max_bits: int, segments: int) -> list[tuple[int, int, int]]:
    """``(shift, width, radius)`` of each segment; the radii add up to max_bits - segments + 1."""
    total = max(0, max_bits - segments + 1)
    radii = [total // segments + (i < total % segments) for i in range(segments)]
    # a segment probed exactly may be wider than one probed with a ball
    width = [64 // segments] * segments
    width[-1] += 64 - sum(width)
    out, shift = [], 0
    for w, r in zip(width, radii):
        out.append((shift, w, r))
        shift += w
    return out


def _flips(width: int, radius: int) -> list[int]:
    return [sum(1 << b for b in bits) for r in range(radius + 1) for bits in combinations(range(width), r)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _key(fp: Column, seg: int, shift: int, width: int) -> Column:
    part = F.shiftrightunsigned(fp, shift).bitwiseAND(F.lit((1 << width) - 1))
    return part.bitwiseOR(F.lit(_signed(seg << 60)))


def links(fps: DataFrame, max_bits: int = 4, segments: int = 3, bucket_limit: int = 64) -> DataFrame:
    """Links ``(a, b)`` between distinct fingerprints at ``max_bits`` or fewer differing bits.

    ``fps`` has one column ``fp`` of distinct longs. The links span every connected group of the
    full graph; inside crowded entries they are those to the smallest holder of a midpoint.
    Spark takes an exploded table for no larger than the one before, and would broadcast it: the
    joins are hinted to sort and merge.
    """
    parts = _segments(max_bits, segments)
    table = fps.select("fp", F.explode(F.array(*[_key(F.col("fp"), s, a, w) for s, (a, w, _) in enumerate(parts)])).alias("key"))
    crowded = materialize(table.groupBy("key").count().filter(F.col("count") > bucket_limit).select("key"), "crowded")
    balls = [_key(F.col("fp"), s, a, w).bitwiseXOR(F.lit(f)) for s, (a, w, r) in enumerate(parts) for f in _flips(w, r)]
    probes = fps.select(F.col("fp").alias("p"), F.explode(F.array(*balls)).alias("key"))
    pairs = (
        table.join(crowded, "key", "left_anti")
        .join(probes.hint("merge"), "key")
        .filter((F.col("p") < F.col("fp")) & (F.bit_count(F.col("p").bitwiseXOR(F.col("fp"))) <= max_bits))
        .select(F.col("p").alias("a"), F.col("fp").alias("b"))
    )
    inner, outer = max_bits // 2, max_bits - max_bits // 2
    near = [_signed(f) for f in _flips(64, inner)]
    far = [_signed(f) for f in _flips(64, outer)][len(near):]
    in_crowd = probes.join(crowded, "key", "left_semi").select(F.col("p").alias("fp")).distinct()
    around = in_crowd.select("fp", F.explode(F.array(*[F.lit(f) for f in near + far])).alias("f"))
    held = around.select("fp", F.col("fp").bitwiseXOR(F.col("f")).alias("mid"),
                         (F.bit_count("f") <= inner).alias("inner"))
    centre = held.filter("inner").groupBy("mid").agg(F.min("fp").alias("a"))
    stars = held.join(centre.hint("merge"), "mid").filter(F.col("a") != F.col("fp")).select("a", F.col("fp").alias("b"))
    return pairs.unionByName(stars).distinct()


def near_duplicates(docs: DataFrame, max_bits: int = 4, shingle: int = 4, seed: int = 42,
                    segments: int = 3, bucket_limit: int = 512, id_col: str = "doc_id",
                    text_col: str = "text", key_col: str | None = None) -> DataFrame:
    """``(id, key, fp, root, component_id)`` for every row of ``docs``.

    ``fp`` is the SimHash fingerprint (signed long) of the words between space and U+0009..U+000D,
    lower-cased A-Z, in shingles of ``shingle`` words counted with repeats; texts with fewer words
    have one shingle and texts with none (null, empty, blank) the fingerprint zero, which links
    like any other. Rows whose fingerprints differ in at most ``max_bits`` bits are linked;
    ``component_id`` is the smallest id reachable, ``root`` the smallest fingerprint and ``key`` the
    column ``key_col`` of the row, by default a hash of the text. Repeated rows stay; a null id is never the
    smallest unless its whole group has none. Other columns of ``docs`` are not used.
    """
    base = materialize(fingerprints(docs, shingle, seed, id_col, text_col, key_col), "fingerprints")
    fps = materialize(base.groupBy("fp").agg(F.min("id").alias("first")), "distinct")
    edges = links(fps.select("fp"), max_bits, segments, bucket_limit)
    roots = connected_components(edges)
    known = fps.join(roots.hint("merge"), fps["fp"] == roots["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = known.groupBy("root").agg(F.min("first").alias("component_id"))
    final = known.join(least.hint("merge"), "root").select("fp", "root", "component_id")
    return base.join(final.hint("merge"), "fp").select("id", "key", "fp", "root", "component_id")
