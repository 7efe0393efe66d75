"""Language-model scores: a unigram base and a log-bilinear model trained by noise contrast.

Both learn from all training documents. The log-bilinear model predicts a token's class from the
two classes before it: frequent tokens and the end of a text are classes of their own, other
tokens share a class by their ending. Classes lie in groups; a group and then its member are
predicted, so that scores are normalised exactly at the cost of twice the root of the classes. A
token of a shared class then takes its smoothed share of the class's count.

Training is noise-contrastive estimation in rounds, each over its own part of the training texts
by a hash: tasks sum gradients over the tokens of the round's texts, the sums are added up in
Spark, and their total, whose size is that of the model, makes one step on the driver. A pass over
all rounds has used every training token once.

Frequent tokens and class totals travel with the tasks (bounded by parameters). The counts of the
rest, which grow with the corpus, stay in a table: tasks emit, for every token of a block of
documents, one row with the documents that hold it; joined with the counts these rows become
partial sums per document. A hot token is either a class of its own or one row a block.
"""

from __future__ import annotations

import math
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from hearth.llm.common import as_long, materialize, shared_dir, span_hashes, spans_of, text_slices

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.ones(256, bool)
_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
#: hash of the end of a text, which no word has
END = 0
ENDINGS = 128
#: bytes of text of a block of documents, and different tokens held before they are emitted
BLOCK_BYTES, HELD = 16 << 20, 1 << 21


def _tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token hashes with an end after every row, their ending classes, and each row's first token."""
    data = _LOWER[data]
    starts, ends, first = spans_of(_WORD[data], offsets)
    h = span_hashes(data, starts, ends)
    h[h == END] = 1
    last = data[ends - 1].astype(np.int64) if len(ends) else ends
    prior = np.where(ends - starts > 1, data[np.maximum(ends - 2, 0)], 0) if len(ends) else ends
    ending = (last * 31 + prior * 7) % ENDINGS
    at = first[1:]
    return np.insert(h, at, END), np.insert(ending, at, 0), first + np.arange(len(first))


def _runs(batches, ids: int):
    """Text slices of up to a block's bytes, with the columns before the text."""
    for batch in batches:
        for at, n, data, offsets in text_slices(batch, "t", 1 << 20):
            part = batch.slice(at, n)
            yield [part.column(i) for i in range(ids)], n, data, offsets


def token_counts(docs: DataFrame) -> DataFrame:
    """``(h, ending, n)`` over the texts ``t``: every different token and how often it occurs."""
    def merged(parts):
        h = np.concatenate([p[0] for p in parts])
        u, at, inv = np.unique(h, return_index=True, return_inverse=True)
        return u, np.concatenate([p[1] for p in parts])[at], np.bincount(inv, np.concatenate([p[2] for p in parts])).astype(np.int64)

    def work(batches):
        parts, size = [], 0
        for _, _, data, offsets in _runs(batches, 0):
            h, ending, _ = _tokens(data, offsets)
            parts.append(merged([(h, ending, np.ones(len(h), np.int64))]))
            size += len(parts[-1][0])
            if size > HELD:
                parts = [merged(parts)]
                size = len(parts[0][0])
                if 2 * size > HELD:
                    yield _counted(*parts.pop())
                    size = 0
        if parts:
            yield _counted(*merged(parts))

    def _counted(h, ending, n):
        return pa.record_batch([pa.array(as_long(h)), pa.array(ending.astype(np.int32)), pa.array(n)], names=["h", "ending", "n"])

    return docs.select("t").mapInArrow(work, "h long, ending int, n long").groupBy("h").agg(F.max("ending").alias("ending"), F.sum("n").alias("n"))


class Vocabulary:
    """Frequent tokens with their counts, the totals of the ending classes, and of everything."""

    def __init__(self, rows, totals):
        rows = sorted(rows, key=lambda r: r["h"] % 2**64)
        self.frequent = np.array([r["h"] % 2**64 for r in rows], np.uint64)
        self.count = np.array([r["n"] for r in rows], np.int64)
        self.class_tokens, self.class_types = np.zeros(ENDINGS), np.zeros(ENDINGS)
        for r in totals:
            self.class_tokens[r["ending"]], self.class_types[r["ending"]] = r["tokens"], r["types"]
        self.tokens = int(self.count.sum() + self.class_tokens.sum())
        self.types = len(rows) + int(self.class_types.sum())
        self.classes = len(rows) + ENDINGS
        #: base probability of a token seen c times: (c + 1/2) / scale
        self.scale = self.tokens + 0.5 * (self.types + 1)

    def classify(self, h: np.ndarray, ending: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Class of each token, and whether it is a frequent one."""
        if not len(self.frequent):
            return ending.copy(), np.zeros(len(h), bool)
        at = np.minimum(np.searchsorted(self.frequent, h), len(self.frequent) - 1)
        known = self.frequent[at] == h
        return np.where(known, at, len(self.frequent) + ending), known


def contexts(classes: np.ndarray, first: np.ndarray, start: int) -> np.ndarray:
    """The two classes before each token as one number; ``start`` stands before every text."""
    one = np.empty(len(classes), np.int64)
    two = np.empty(len(classes), np.int64)
    one[1:], two[2:] = classes[:-1], classes[:-2]
    begin = first[:-1]
    one[begin] = start
    two[begin] = start
    second = begin[np.diff(first) > 1] + 1
    two[second] = start
    return two * (start + 1) + one


class LogBilinear:
    """P(w | a, b) = P(group of w | a, b) P(w | its group, a, b), each proportional to exp(h . q + bias).

    ``h = r_a * A + r_b * B`` for the classes a and b before w. About as many groups as there are
    classes in a group, so that both parts are normalised exactly at the cost of twice the root.
    """

    NAMES = ("r", "q", "far", "near", "bias", "top", "top_bias")
    #: noise tokens expected for every observed one
    NOISE = 20.0

    def __init__(self, classes: int, unigram: np.ndarray, size: int = 24, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.classes = classes
        self.width = max(1, math.isqrt(max(0, classes - 1)) + 1)
        self.groups = -(-classes // self.width)
        noise = (unigram + 0.5) / (unigram.sum() + 0.5 * classes)
        self.share = np.append(noise, 0.0)
        self.top_noise = np.add.reduceat(noise, np.arange(0, classes, self.width))
        self.noise = noise / self.top_noise[np.arange(classes) // self.width]
        self.r = rng.normal(0, 0.1, (classes + 1, size))
        self.q = rng.normal(0, 0.1, (classes, size))
        self.top = rng.normal(0, 0.1, (self.groups, size))
        self.far, self.near = np.eye(size) * 0.5, np.eye(size) * 0.5
        self.bias, self.top_bias = np.log(self.noise), np.log(self.top_noise)
        self.sizes = {n: np.full_like(getattr(self, n), 1e-4) for n in self.NAMES}

    def _members(self, g: int) -> slice:
        return slice(g * self.width, min((g + 1) * self.width, self.classes))

    def zeros(self) -> list[np.ndarray]:
        """Sums of gradients: by far and near class, of q and top with their biases, and the tokens."""
        size = self.r.shape[1]
        return [np.zeros(s) for s in ((self.classes + 1, size), (self.classes + 1, size), (self.classes, size + 1), (self.groups, size + 1), 1)]

    def _rows(self) -> list[np.ndarray]:
        """By far class, near class, class and group, with biases in the last column."""
        wide = ((self.r @ self.far, 1.0), (self.r @ self.near, 0.0), (self.q, self.bias), (self.top, self.top_bias))
        return [np.column_stack((x, np.broadcast_to(more, len(x)))).astype(np.float32) for x, more in wide]

    def add(self, total: list[np.ndarray], context: np.ndarray, word: np.ndarray) -> None:
        """Add the noise-contrastive gradients of observed tokens: tell them from the noise.

        The noise is not drawn: its expectation is taken over all groups and over all members of
        the token's group. Normalising constants are taken as one while training.
        """
        order = _sorted(word, self.classes)
        a, b = np.divmod(context[order], self.classes + 1)
        w = word[order]
        far, near, q, top = self._rows()
        hid = far[a] + near[b]
        down = _contrast(hid, top, self.NOISE * self.top_noise, w // self.width, total[3])
        bounds = np.searchsorted(w, np.arange(self.groups + 1) * self.width)
        for g in np.flatnonzero(np.diff(bounds)).tolist():
            at, own = slice(bounds[g], bounds[g + 1]), self._members(g)
            down[at] += _contrast(hid[at], q[own], self.NOISE * self.noise[own], w[at] - own.start, total[2][own])
        for into, at in ((total[0], a), (total[1], b)):
            order = _sorted(at, self.classes + 1)
            _scatter(into, at[order], down[order, :-1])
        total[4] += len(w)

    def step(self, total: list[np.ndarray], rate: float) -> None:
        """One step along gradient sums, scaled by the running size of each weight's gradients.

        A row's gradient is a mean over its expected tokens, drawn to zero where they are few.
        """
        far, near, q, top, (m,) = total
        if not m:
            return
        own = m * self.share + 20
        top_own = m * self.top_noise + 20
        g = {"r": (far @ self.far.T + near @ self.near.T) / own[:, None], "far": self.r.T @ far / m, "near": self.r.T @ near / m,
             "q": q[:, :-1] / own[:-1, None], "bias": q[:, -1] / own[:-1], "top": top[:, :-1] / top_own[:, None], "top_bias": top[:, -1] / top_own}
        for x, step in g.items():
            self.sizes[x] += step * step
            getattr(self, x)[...] += rate * step / np.sqrt(self.sizes[x])

    def fit(self, context: np.ndarray, word: np.ndarray, count: np.ndarray, epochs: int = 4, batch: int = 4096, rate: float = 0.1, seed: int = 11) -> None:
        """The same training on arrays in one process, a step a batch."""
        rng = np.random.default_rng(seed)
        order = np.repeat(np.arange(len(word)), count)
        for _ in range(epochs):
            rng.shuffle(order)
            for at in range(0, len(order), batch):
                pick = order[at:at + batch]
                total = self.zeros()
                self.add(total, context[pick], word[pick])
                self.step(total, rate)

    def log10(self, context: np.ndarray, word: np.ndarray, batch: int = 1 << 17) -> np.ndarray:
        """Normalised log10 probabilities, one matrix product a group of a batch."""
        out = np.empty(len(word))
        far, near, q, top = self._rows()
        order = _sorted(word, self.classes)
        for at in range(0, len(word), batch):
            pick = order[at:at + batch]
            a, b = np.divmod(context[pick], self.classes + 1)
            w = word[pick]
            hid = far[a] + near[b]
            logp = _log_share(hid, top, w // self.width)
            bounds = np.searchsorted(w, np.arange(self.groups + 1) * self.width)
            for g in np.flatnonzero(np.diff(bounds)).tolist():
                mine, own = slice(bounds[g], bounds[g + 1]), self._members(g)
                logp[mine] += _log_share(hid[mine], q[own], w[mine] - own.start)
            out[pick] = logp
        return out / np.log(10)


#: rows of scores that stay in a core's cache
_CACHED = 4096


def _contrast(hid: np.ndarray, q: np.ndarray, noise: np.ndarray, target: np.ndarray, into: np.ndarray) -> np.ndarray:
    """Add to the gradient of ``q``, given the noise expected of its rows; the gradient of ``hid``."""
    out = np.empty_like(hid)
    even = (1 / noise).astype(np.float32)
    noise = noise.astype(np.float32)
    minus = -q.T
    for at in range(0, len(hid), _CACHED):
        h, t = hid[at:at + _CACHED], target[at:at + _CACHED]
        row = np.arange(len(t))
        # the noise of every class by the odds that the model takes it for observed
        x = h @ minus
        with np.errstate(over="ignore"):
            np.exp(x, out=x)
        x += even
        np.reciprocal(x, out=x)
        x[row, t] -= 1 - x[row, t] / noise[t]
        into -= x.T @ h
        np.negative(x @ q, out=out[at:at + _CACHED])
    return out


def _log_share(hid: np.ndarray, q: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log of the targets' shares in the sums of exponentials."""
    out = np.empty(len(hid))
    q = np.ascontiguousarray(q.T)
    for at in range(0, len(hid), _CACHED):
        t = target[at:at + _CACHED]
        s = hid[at:at + _CACHED] @ q
        s -= s.max(axis=1, keepdims=True)
        mine = s[np.arange(len(t)), t].astype(np.float64)
        np.exp(s, out=s)
        out[at:at + _CACHED] = mine - np.log(s.sum(axis=1, dtype=np.float64))
    return out


def _sorted(at: np.ndarray, n: int) -> np.ndarray:
    """The stable order of places below ``n``; by radix where two bytes hold them."""
    return np.argsort(at.astype(np.uint16) if n <= 1 << 16 else at, kind="stable")


def _scatter(into: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
    """Add rows to their places, which are in order."""
    if len(at):
        start = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        into[at[start]] += np.add.reduceat(rows, start, axis=0)


#: tokens whose gradients are summed at once, and parts in which sums of gradients are added up
BATCH_TOKENS, PARTS = 1 << 17, 16


def _class_rows(docs: DataFrame, vocabulary, rounds: int) -> DataFrame:
    """``(classes, round)``: the classes of every text ``t``, written a folder a round."""
    def work(batches):
        v = vocabulary.value
        for (order,), n, data, offsets in _runs(batches, 1):
            h, ending, first = _tokens(data, offsets)
            classes = v.classify(h, ending)[0].astype("<i4" if v.classes > 1 << 16 else "<u2")
            held = [classes[a:b].tobytes() for a, b in zip(first[:-1], first[1:])]
            yield pa.record_batch([pa.array(held, pa.binary()), order], names=["classes", "round"])

    spark = docs.sparkSession
    path = f"{shared_dir(spark)}/llm-classes-{uuid.uuid4().hex}"
    placed = docs.select(F.pmod("order", F.lit(rounds)).cast("int").alias("round"), "t")
    # a task writes a file a round
    placed = placed.coalesce(2 * spark.sparkContext.defaultParallelism).mapInArrow(work, "classes binary, round int")
    placed.write.partitionBy("round").parquet(path)
    return spark.read.schema(placed.schema).parquet(path)


def _gradient_total(rows: DataFrame, shared) -> list[np.ndarray] | None:
    """The sums of gradients over the texts' classes, null without texts."""
    def work(batches):
        model = shared.value
        total, held, size = model.zeros(), [], 0

        def summed():
            first = np.concatenate(([0], np.cumsum([len(x) for x in held])))
            classes = np.concatenate(held).astype(np.int64)
            pair = contexts(classes, first, model.classes)
            for at in range(0, len(pair), BATCH_TOKENS):
                model.add(total, pair[at:at + BATCH_TOKENS], classes[at:at + BATCH_TOKENS])

        for batch in batches:
            for x in batch.column(0):
                held.append(np.frombuffer(x.as_buffer(), "<i4" if model.classes > 1 << 16 else "<u2"))
                size += len(held[-1])
                if size >= BATCH_TOKENS:
                    summed()
                    held, size = [], 0
        if held:
            summed()
        if total[-1][0]:
            parts = np.array_split(np.concatenate([x.ravel() for x in total]), PARTS)
            yield pa.record_batch([pa.array(np.arange(PARTS, dtype=np.int32)), pa.array([x.tobytes() for x in parts], pa.binary())], names=["part", "sums"])

    def added(table):
        sums = sum(np.frombuffer(x.as_buffer()) for x in table.column("sums"))
        return pa.table([table.column("part").slice(0, 1), pa.array([sums.tobytes()], pa.binary())], names=["part", "sums"])

    rows = rows.select("classes").coalesce(2 * rows.sparkSession.sparkContext.defaultParallelism)
    found = rows.mapInArrow(work, "part int, sums binary").groupBy("part").applyInArrow(added, "part int, sums binary").collect()
    if not found:
        return None
    flat = np.concatenate([np.frombuffer(r["sums"]) for r in sorted(found, key=lambda r: r["part"])])
    empty = shared.value.zeros()
    return [x.reshape(z.shape) for x, z in zip(np.split(flat, np.cumsum([z.size for z in empty])[:-1]), empty)]


def train(training: DataFrame, frequent: int, sample_tokens: int | None, rounds: int = 16, rate: float = 0.1) -> tuple[DataFrame, Vocabulary, LogBilinear]:
    """Counts of all training texts ``t`` (with ``order``, a hash of the row), and the model."""
    spark = training.sparkSession
    counts = materialize(token_counts(training), "counts")
    # the end of a text always is a class of its own
    top = counts.filter(F.col("h") == END).unionByName(counts.filter(F.col("h") != END).orderBy(F.desc("n"), "h").limit(frequent))
    top = materialize(top.select("h", "n"), "frequent")
    rows = top.collect()
    totals = counts.join(F.broadcast(top.select("h")), "h", "left_anti").groupBy("ending").agg(F.sum("n").alias("tokens"), F.count("*").alias("types")).collect()
    vocabulary = Vocabulary(rows, totals)
    shared = spark.sparkContext.broadcast(vocabulary)
    if sample_tokens is not None:
        share = min(1.0, sample_tokens / max(1, vocabulary.tokens))
        training = training.filter(F.pmod("order", F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    # the round does not follow from the bits that pick a sample
    classes = _class_rows(training.withColumn("order", F.xxhash64("order")), shared, rounds)
    model = LogBilinear(vocabulary.classes, np.concatenate([vocabulary.count, vocabulary.class_tokens]))
    for i in range(rounds):
        now = spark.sparkContext.broadcast(model)
        total = _gradient_total(classes.filter(F.col("round") == i), now)
        now.unpersist()
        if total:
            model.step(total, rate)
    return counts, vocabulary, model


def _scan_schema(id_type: T.DataType) -> T.StructType:
    kinds = {"h": T.LongType(), "block": T.LongType(), "docs": T.BinaryType(), "place": T.IntegerType(), "id": id_type,
             "n_tokens": T.LongType(), "n_frequent": T.LongType(), "base": T.DoubleType(), "model": T.DoubleType()}
    return T.StructType([T.StructField(n, k) for n, k in kinds.items()])


def _scan(docs: DataFrame, shared) -> DataFrame:
    """Rows of two kinds. Of a document (``h`` null): its block, place and sums over frequent tokens.

    Of a token of a block: the places of the documents with it and how often, as pairs of integers.
    """
    schema = _scan_schema(docs.schema["id"].dataType)
    id_type = to_arrow_type(schema["id"].dataType)

    def flush(parts, block):
        h = np.concatenate([p[0] for p in parts])
        place = np.concatenate([p[1] for p in parts])
        n = np.concatenate([p[2] for p in parts])
        order = np.argsort(h, kind="stable")
        h, place, n = h[order], place[order], n[order]
        start = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1]))) if len(h) else np.zeros(0, np.int64)
        both = np.empty((len(h), 2), "<u2")
        both[:, 0], both[:, 1] = place, n
        raw = both.tobytes()
        bounds = np.append(start, len(h)) * 4
        held = pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(bounds.astype(np.int32).tobytes()), pa.py_buffer(raw)])
        for at in range(0, len(start), 100_000):
            size = min(100_000, len(start) - at)
            none = [pa.nulls(size, t) for t in (pa.int32(), id_type, pa.int64(), pa.int64(), pa.float64(), pa.float64())]
            yield pa.record_batch([pa.array(as_long(h[start[at:at + size]])), pa.array(np.full(size, block)), held.slice(at, size), *none], names=schema.names)

    def work(batches):
        v, model = shared.value
        block, used, place, parts = TaskContext.get().partitionId() << 32, 0, 0, []
        for (rows,), n, data, offsets in _runs(batches, 1):
            if used and (used + len(data) > BLOCK_BYTES or place + n > 65_000):
                yield from flush(parts, block)
                block, used, place, parts = block + 1, 0, 0, []
            used += len(data)
            h, ending, first = _tokens(data, offsets)
            size = np.diff(first)
            classes, known = v.classify(h, ending)
            own = np.repeat(np.arange(n), size)
            logp = model.log10(contexts(classes, first, v.classes), classes)
            shared_class = classes[~known] - len(v.frequent)
            logp[~known] -= np.log10(v.class_tokens + 0.5 * (v.class_types + 1))[shared_class]
            base = np.bincount(own[known], np.log10(v.count + 0.5)[classes[known]], n) if known.any() else np.zeros(n)
            rare, where, times = _pairs(h[~known], own[~known])
            while len(times) and times.max() > 65_535:
                # a pair holds 16 bits; what is over goes to a second one
                over = np.flatnonzero(times > 65_535)
                rare, where = np.append(rare, rare[over]), np.append(where, where[over])
                times = np.append(np.minimum(times, 65_535), times[over] - 65_535)
            parts.append((rare, where + place, times))
            yield pa.record_batch([
                pa.nulls(n, pa.int64()), pa.array(np.full(n, block)), pa.nulls(n, pa.binary()), pa.array((np.arange(n) + place).astype(np.int32)), rows,
                pa.array(size), pa.array(np.bincount(own[known], minlength=n)), pa.array(base), pa.array(np.bincount(own, logp, n))], names=schema.names)
            place += n
        if parts:
            yield from flush(parts, block)

    return docs.select("id", "t").mapInArrow(work, schema)


def _pairs(h: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different (token, row) pairs and how often they occur."""
    if not len(h):
        return h, own, own
    order = np.lexsort((h, own))
    h, own = h[order], own[order]
    start = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (own[1:] != own[:-1]))))
    return h[start], own[start], np.diff(np.append(start, len(h)))


def _sums(found: DataFrame) -> DataFrame:
    """``(block, place, known, base)``: sums over the rarer tokens of every document."""
    def work(batches):
        for batch in batches:
            block = np.asarray(batch.column(0))
            docs = batch.column(1)
            n = np.asarray(batch.column(2))
            lens = np.asarray(pc.binary_length(docs)) // 4
            both = np.frombuffer(b"".join(docs.to_pylist()), "<u2").reshape(-1, 2).astype(np.int64)
            seen = np.repeat(n, lens)
            key, at = _keys(np.repeat(block, lens), both[:, 0])
            base = np.bincount(at, both[:, 1] * np.log10(seen + 0.5), len(key[0]))
            known = np.bincount(at, both[:, 1] * (seen > 0), len(key[0])).astype(np.int64)
            yield pa.record_batch([pa.array(key[0]), pa.array(key[1].astype(np.int32)), pa.array(known), pa.array(base)], names=["block", "place", "known", "base"])

    return found.select("block", "docs", "n").mapInArrow(work, "block long, place int, known long, base double").groupBy("block", "place").agg(
        F.sum("known").alias("known"), F.sum("base").alias("rare"))


def _keys(block: np.ndarray, place: np.ndarray):
    names, at = np.unique(block, return_inverse=True)
    key, inverse = np.unique(at * 65_536 + place, return_inverse=True)
    return (names[key // 65_536], key % 65_536), inverse


def score(docs: DataFrame, training: DataFrame, frequent: int = 4095, sample_tokens: int | None = None,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_tokens, n_known, train_tokens, base_score, score`` for every row of ``docs``.

    Tokens are the words between space and U+0009..U+000D, A-Z lower-cased, and one end a text.
    Counts cover all rows of ``training`` (same columns) and so does the neural part, unless
    ``sample_tokens`` asks for about so many tokens of whole texts, picked by a hash; ``frequent``
    tokens are classes of their own. Scores are log10 probabilities of the whole text. Null, empty and blank texts are
    their end alone; without training rows every token is unknown and the classes are even;
    repeated rows are scored one by one and count as often. Other columns are not used.
    """
    spark = docs.sparkSession
    picked = training.select(F.coalesce(F.col(text_col), F.lit("")).alias("t"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("order"))
    counts, vocabulary, model = train(picked, frequent, sample_tokens)
    shared = spark.sparkContext.broadcast((vocabulary, model))
    scan = materialize(_scan(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")), shared), "scan")
    found = scan.filter("h is not null").select("h", "block", "docs").join(counts.select("h", "n"), "h", "left").na.fill(0, ["n"])
    own = scan.filter("h is null").join(_sums(found), ["block", "place"], "left").na.fill(0, ["known", "rare"])
    base = F.col("base") + F.col("rare") - F.col("n_tokens") * F.log10(F.lit(float(vocabulary.scale)))
    return own.select("id", "n_tokens", (F.col("n_frequent") + F.col("known")).alias("n_known"), F.lit(vocabulary.tokens).cast("long").alias("train_tokens"),
                      base.alias("base_score"), (F.col("model") + F.col("rare")).alias("score"))
