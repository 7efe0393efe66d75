"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Terms are words. A text is the vector of all its terms, each with log term frequency by inverse
document frequency, and one constant feature. The examples are a bounded sample of the labelled
rows; their whole vocabulary is indexed. A term that goes with the label in the sample weighs more
by its chi-square statistic over 1, its mean if term and label were independent; no term weighs
less than its TF-IDF and none is left out. Document frequencies are counted over all documents:
exactly for terms of the examples, and in ``REST`` hash buckets for terms that no example holds,
which only add to the length of a text. Equal vectors are one entry of the index with their votes.

The index holds, per term, postings in order of entry, cut in blocks of 64 entries, with the
largest weight of the term in every block; terms that more than an eighth of the entries hold have
their postings written out as rows of numbers. A query orders the blocks by their bounds (query
weights times block maxima), compares the first blocks, and of the others only those whose bound
reaches its k-th best cosine, so its neighbours are exactly those of a full comparison.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearth.llm.common import as_long, materialize, span_hashes, spans_of, text_slices

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LETTER = np.zeros(256, bool)
_LETTER[0x61:0x7B] = _LETTER[0x80:] = True
BLOCK = 64
#: buckets that count documents of terms no example holds
REST = 1 << 18
#: blocks compared before any is ruled out
FIRST = 6
#: scores of repeated texts that a task remembers
REMEMBERED = 10_000
_CONSTANT = 1.0


def _terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(row, hash, count)`` of the different terms of every row, in order of row and hash."""
    data = _LOWER[data]
    starts, ends, first = spans_of(_LETTER[data], offsets)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    h = span_hashes(data, starts, ends)
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (row[1:] != row[:-1]) | (h[1:] != h[:-1])
    at = np.flatnonzero(new)
    return row[at], h[at], np.diff(np.append(at, len(h)))


def _numbers(h: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Place of every term among ``hashes``, or beyond them the bucket it is counted in."""
    rest = len(hashes) + (h % np.uint64(REST)).astype(np.int64)
    if not len(hashes):
        return rest
    at = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
    return np.where(hashes[at] == h, at, rest)


def _example_terms(chosen: DataFrame) -> pa.Table:
    """``(id, toxic, terms, counts)`` of the examples."""
    def work(batches):
        for batch in batches:
            for at, n, data, offsets in text_slices(batch, "t"):
                row, h, count = _terms(data, offsets)
                cut = pa.array(np.searchsorted(row, np.arange(n + 1)), pa.int32())
                part = batch.slice(at, n)
                yield pa.record_batch([part.column(0), part.column(1), pa.ListArray.from_arrays(cut, pa.array(as_long(h))), pa.ListArray.from_arrays(cut, pa.array(count, pa.int64()))],
                                      names=["id", "toxic", "terms", "counts"])

    longs = T.ArrayType(T.LongType())
    schema = T.StructType([chosen.schema["id"], T.StructField("toxic", T.IntegerType()), T.StructField("terms", longs), T.StructField("counts", longs)])
    return chosen.select("id", "toxic", "t").mapInArrow(work, schema).toArrow()


def _frequencies(docs: DataFrame, text_col: str, hashes: np.ndarray) -> tuple[np.ndarray, int]:
    """Documents that hold each term or, after those, terms of each bucket, and all documents."""
    known = docs.sparkSession.sparkContext.broadcast(hashes)
    size = len(hashes) + REST

    def work(batches):
        total = np.zeros(size + 1, np.int64)
        for batch in batches:
            total[size] += batch.num_rows
            for _, _, data, offsets in text_slices(batch, "t"):
                total += np.bincount(_numbers(_terms(data, offsets)[1], known.value), minlength=size + 1)
        there = np.flatnonzero(total)
        yield pa.record_batch([pa.array(there), pa.array(total[there])], names=["i", "n"])

    table = docs.select(F.col(text_col).alias("t")).mapInArrow(work, "i long, n long").groupBy("i").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size + 1, np.int64)
    out[table["i"].to_numpy()] = table["n"].to_numpy()
    return out[:size], int(out[size])


class Space:
    """Weights of all terms: of those of the examples by place, of the others by bucket."""

    def __init__(self, hashes: np.ndarray, weight: np.ndarray):
        self.hashes, self.weight = hashes, weight

    def vectors(self, row: np.ndarray, h: np.ndarray, count: np.ndarray, rows: int):
        """For every row the numbers of its indexed terms and their weights, of unit length.

        Terms outside the index add to the length; the constant feature comes last, numbered
        after the indexed terms.
        """
        number = _numbers(h, self.hashes)
        w = (1 + np.log(count)) * self.weight[number]
        cut = np.searchsorted(row, np.arange(rows + 1))
        for a, b in zip(cut[:-1], cut[1:]):
            length = math.sqrt(float(w[a:b] @ w[a:b]) + _CONSTANT**2)
            known = np.flatnonzero(number[a:b] < len(self.hashes)) + a
            yield np.append(number[known], len(self.hashes)), np.round(np.append(w[known], _CONSTANT) / length, 9)


def class_weights(toxic: np.ndarray, held: np.ndarray, t: int, n: int) -> np.ndarray:
    """Chi-square statistic, at least 1, of terms in ``held`` of ``n`` rows, ``toxic`` of them among the ``t`` toxic ones."""
    both = held * (n - held) * float(t) * (n - t)
    return np.maximum(1.0, np.divide(n * (toxic * float(n) - held * float(t)) ** 2, both, out=np.zeros(len(held)), where=both > 0))


def _ranges(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places from each start to its end, and how many each has."""
    size = end - start
    stop = np.cumsum(size)
    return np.arange(stop[-1] if len(stop) else 0) + np.repeat(start - stop + size, size), size


class Index:
    """Block-max inverted index over distinct example vectors."""

    def __init__(self, vectors: list, ids: list, labels: list, terms: int):
        entry: dict = {}
        for v, i, y in zip(vectors, ids, labels):
            e = entry.setdefault(self.key(v), [v, [], 0, 0])
            e[1].append(i)
            e[2 + y] += 1

        def place(key):  # entries that share their heaviest term side by side, so that blocks differ in their bounds
            numbers, weights = entry[key][0]
            top = int(np.argmax(weights))
            return int(numbers[top]), -float(weights[top]), key

        order = sorted(entry, key=place)
        self.entry = {key: i for i, key in enumerate(order)}
        self.ids = [sorted(entry[key][1], key=str)[:5] for key in order]
        self.clean = np.array([entry[key][2] for key in order], float)
        self.toxic = np.array([entry[key][3] for key in order], float)
        self.blocks = -(-len(order) // BLOCK)
        held = [entry[key][0] for key in order]
        term = np.concatenate([v[0] for v in held]) if held else np.zeros(0, np.int64)
        weight = np.concatenate([v[1] for v in held]) if held else np.zeros(0)
        where = np.repeat(np.arange(len(held)), [len(v[0]) for v in held])
        count = np.bincount(term, minlength=terms + 1)
        wide = np.flatnonzero(count * 8 > len(held))
        self.row = np.full(terms + 1, -1, np.int64)
        self.row[wide] = np.arange(len(wide))
        common = self.row[term] >= 0
        self.rows = np.zeros((self.blocks, len(wide), BLOCK))
        self.rows[where[common] // BLOCK, self.row[term[common]], where[common] % BLOCK] = weight[common]
        self.row_most = np.ascontiguousarray(self.rows.max(axis=2).T) if self.blocks else np.zeros((len(wide), 0))
        order = np.lexsort((where[~common], term[~common]))
        term, where, self.weight = term[~common][order], where[~common][order], weight[~common][order]
        self.place = where.astype(np.int32)
        # one block posting for every run of postings of a term in a block
        new = np.ones(len(term), bool)
        new[1:] = (term[1:] != term[:-1]) | (where[1:] // BLOCK != where[:-1] // BLOCK)
        at = np.flatnonzero(new)
        self.cut = np.append(at, len(term))
        self.block = (where[at] // BLOCK).astype(np.int32)
        self.most = np.maximum.reduceat(self.weight, at) if len(at) else np.zeros(0)
        self.first = np.searchsorted(term[at], np.arange(terms + 2))

    @staticmethod
    def key(vector: tuple) -> tuple[bytes, bytes]:
        return vector[0].tobytes(), vector[1].tobytes()

    def nearest(self, vector: tuple, k: int, without: int | None = None, own: int = 0) -> list[tuple[float, int]]:
        """``(cosine, entry)`` of the nearest entries that together hold ``k`` examples or more.

        Entries as near as the last one all count. ``without`` leaves one example of label
        ``own`` of that entry out.
        """
        numbers, weights = vector
        held = self.clean + self.toxic
        if without is not None:
            held[without] -= 1
        row = self.row[numbers]
        q = np.zeros(self.rows.shape[1])
        q[row[row >= 0]] = weights[row >= 0]
        numbers, weights = numbers[row < 0], weights[row < 0]
        flat, size = _ranges(self.first[numbers], self.first[numbers + 1])
        weight, block = np.repeat(weights, size), self.block[flat]
        bound = q @ self.row_most + np.bincount(block, weight * self.most[flat], self.blocks)
        order = np.argsort(-bound, kind="stable")
        entries, cosines, kth = np.zeros(0, np.int64), np.zeros(0), -1.0
        for take in (order[:FIRST], order[FIRST:]):
            take = take[bound[take] >= kth - 1e-8]
            if not len(take):
                break
            use = np.zeros(self.blocks, bool)
            use[take] = True
            some = np.flatnonzero(use[block])
            post, size = _ranges(self.cut[flat[some]], self.cut[flat[some] + 1])
            score = np.bincount(self.place[post], np.repeat(weight[some], size) * self.weight[post], self.blocks * BLOCK).reshape(-1, BLOCK)[take]
            score = score + np.array([q @ self.rows[b] for b in take])
            at = (take[:, None] * BLOCK + np.arange(BLOCK)).ravel()
            there = at < len(held)
            entries = np.append(entries, at[there])
            cosines = np.append(cosines, np.round(score.ravel()[there], 9))
            near = np.lexsort((entries, -cosines))
            enough = np.searchsorted(np.cumsum(held[entries[near]]), k)
            if enough < len(near):
                kth = cosines[near[enough]]
                near = near[cosines[near] >= kth]
            entries, cosines = entries[near], cosines[near]
        return list(zip(cosines.tolist(), entries.tolist()))

    def vote(self, vector: tuple, k: int, without: int | None = None, own: int = 0) -> tuple[float, list]:
        """Share of toxic among the neighbours, weighted by nearness, and the neighbours."""
        near = self.nearest(vector, k, without, own)
        yes = no = 0.0
        for c, e in near:
            w = 1 / (1.02 - c) if c < 1 else 50.0
            yes += w * (self.toxic[e] - (own if e == without else 0))
            no += w * (self.clean[e] - ((1 - own) if e == without else 0))
        return (yes / (yes + no) if yes + no else 0.0), near


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Centres and values of the increasing step function nearest to ``y`` (pooled neighbours)."""
    order = np.argsort(x, kind="stable")
    pools: list[list[float]] = []
    for i in order.tolist():
        pools.append([w[i], w[i] * y[i], w[i] * x[i], x[i]])
        while len(pools) > 1 and (pools[-1][3] == pools[-2][3] or pools[-2][1] / pools[-2][0] >= pools[-1][1] / pools[-1][0]):
            last = pools.pop()
            for j in range(3):
                pools[-1][j] += last[j]
            pools[-1][3] = last[3]
    return np.array([p[2] / p[0] for p in pools]), np.array([p[1] / p[0] for p in pools])


class Model:
    """What a task needs to score texts; its size is bounded by the sample of examples."""

    def __init__(self, space: Space, vectors: list, ids: list, labels: list, weights: list, k: int):
        self.space, self.k = space, k
        self.index = Index(vectors, ids, labels, len(space.hashes))
        known: dict = {}
        raw = []
        for v, y in zip(vectors, labels):
            e = self.index.entry[self.index.key(v)]
            if (e, y) not in known:
                known[e, y] = self.index.vote(v, k, e, y)[0]
            raw.append(known[e, y])
        x, y, w = np.array(raw), np.array(labels, float), np.array([weights[y] for y in labels])
        # two pseudo examples at the ends keep scores off 0 and 1
        x, y, w = np.append(x, [0, 1]), np.append(y, [0.5, 0.5]), np.append(w, [min(weights), min(weights)])
        self.x, self.y = isotonic(x, y, w)
        self.seen: dict = {}

    def score(self, vector: tuple) -> tuple[float, list]:
        key = hashlib.sha256(b"|".join(self.index.key(vector))).digest()
        if key not in self.seen:
            if len(self.seen) >= REMEMBERED:
                self.seen.clear()
            share, near = self.index.vote(vector, self.k)
            told = float(np.interp(share, self.x, self.y))
            proof = [(self.index.ids[e], c, float(self.index.toxic[e] / (self.index.toxic[e] + self.index.clean[e]))) for c, e in near[:5]]
            self.seen[key] = (min(max(told, 0.0), 1.0), proof)
        return self.seen[key]


def train(docs: DataFrame, labels: DataFrame, per_class: int, k: int, id_col: str, text_col: str, label_col: str) -> Model | None:
    known = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("toxic"))
    known = known.withColumn("order", F.xxhash64("id"))
    totals = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    picked = known.filter("toxic = 1").orderBy("order", "id").limit(per_class).unionByName(known.filter("toxic = 0").orderBy("order", "id").limit(per_class))
    # at most 2 * per_class ids
    chosen = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).join(F.broadcast(picked.select("id", "toxic")), "id")
    sample = sorted(_example_terms(materialize(chosen, "examples")).to_pylist(), key=lambda r: (str(r["id"]), r["toxic"], r["terms"], r["counts"]))
    ys = [r["toxic"] for r in sample]
    if len(set(ys)) < 2:
        return None
    terms = [np.array(r["terms"], np.int64).view(np.uint64) for r in sample]
    h, row = np.concatenate(terms), np.repeat(np.arange(len(sample)), [len(x) for x in terms])
    count = np.concatenate([np.array(r["counts"], np.int64) for r in sample])
    hashes, place = np.unique(h, return_inverse=True)
    held = np.bincount(place, minlength=len(hashes)).astype(float)
    toxic = np.bincount(place, np.array(ys, float)[row], len(hashes))
    found, rows = _frequencies(docs, text_col, hashes)
    weight = np.log((1 + rows) / (1 + np.minimum(found, rows))) + 1
    weight[:len(hashes)] *= class_weights(toxic, held, sum(ys), len(ys))
    space = Space(hashes, weight)
    # each class weighs as in all labelled rows
    weights = [totals[y] / ys.count(y) for y in (0, 1)]
    return Model(space, list(space.vectors(row, h, count, len(sample))), [r["id"] for r in sample], ys, weights, k)


def score(docs: DataFrame, labels: DataFrame, per_class: int = 2000, k: int = 15, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """``id, score, evidence`` for every row of ``docs``.

    ``labels`` are the rows to learn from, at most ``per_class`` of either class by a hash of the
    id; other ids' labels must be left out by the caller. ``score`` is the calibrated probability
    of label 1 and ``evidence`` up to five nearest examples as ``(id, cosine, toxic share)``. Null
    and empty texts have only the constant feature. Without labelled texts of both classes every
    score is 0.5. Of several labels of an id the highest counts; repeated rows are scored one by
    one; other columns are not used.
    """
    model = train(docs, labels, per_class, k, id_col, text_col, label_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    id_type = docs.schema[id_col].dataType
    proof = pa.list_(pa.struct([("id", pa.string()), ("cosine", pa.float64()), ("toxic", pa.float64())]))

    def work(batches):
        m = shared.value
        for batch in batches:
            for at, n, data, offsets in text_slices(batch, "t"):
                told = [m.score(v) for v in m.space.vectors(*_terms(data, offsets), n)] if m else [(0.5, [])] * n
                seen = [[{"id": str(i), "cosine": c, "toxic": y} for ids, c, y in near for i in ids[:1]] for _, near in told]
                yield pa.record_batch([batch.column(0).slice(at, n), pa.array([x[0] for x in told], pa.float64()), pa.array(seen, proof)], names=["id", "score", "evidence"])

    schema = T.StructType([T.StructField("id", id_type), T.StructField("score", T.DoubleType()), T.StructField("evidence", T.ArrayType(T.StructType([
        T.StructField("id", T.StringType()), T.StructField("cosine", T.DoubleType()), T.StructField("toxic", T.DoubleType())])))])
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).mapInArrow(work, schema)


def remainder(column: Column, by: int) -> Column:
    """crc32 of the id written as text, modulo ``by``; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")), F.lit(by))
