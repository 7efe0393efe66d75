"""Repair of conversation structure: the cheapest edits that give ``system? (user assistant)+``.

Rows are repartitioned by conversation and sorted by turn, and every partition is streamed once.
A row may be kept, get another role, or be deleted, and empty turns may be inserted. The forward
dynamic programme over four states (nothing yet, after system, after user, after assistant) keeps
for each state the cost of the best edits so far and the order of the states' edit strings, which
is all that later rows need: the strings of two states differ, and neither begins the other, since
both end with the edit of the same row. Relative costs and orders take few values, so a step is
looked up by (values, kind of row). What a step leaves behind is one byte a state: where it came
from, the inserts before it, and the edit.

These bytes and the rows of the open conversation are buffered; beyond ``memory`` bytes they go to
unnamed scratch files of the task, as Spark's own sorts spill, and a repeated task writes them
anew. The trace back reads the file from its end in pieces, so a conversation of any length takes bounded
memory. One conversation is one task's stream: the states of a row depend on all rows before.
"""

from __future__ import annotations

import hashlib
import struct
import tempfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
_INF = 1 << 40
#: state reached by inserting (or giving a row) the next role: nothing, system, user, assistant
_NEXT = (2, 2, 3, 2)
_ROLE = {2: "user", 3: "assistant"}
_OPS = "DKR"
_START = ((0, _INF, _INF, _INF), (0, -1, -1, -1))
_END = {0: 0, 3: 0, 2: 1, 1: 2}  # inserts that complete each state
MEMORY = 8 << 20
_PIECE = 1 << 16


def _step(state: tuple, kind: tuple) -> tuple[tuple, int, bytes]:
    """``(next state, cost to add, one byte a state)`` for a row of a kind (initial, truncated, must go)."""
    costs, ranks = state
    initial, truncated, gone = kind
    best: list = [None] * 4
    for p in range(4):
        if costs[p] >= _INF:
            continue
        q = p
        for inserts in range(3):
            cost = costs[p] + INSERT * inserts
            edits = [("D", q, DELETE)]
            if not gone:
                extra = TRUNCATED * truncated
                keeps = {"s": 1 if q == 0 else -1, "u": 2 if q != 2 else -1, "a": 3 if q == 2 else -1}.get(initial, -1)
                if keeps > 0:
                    edits.append(("K", keeps, KEEP + extra))
                edits.append(("R", _NEXT[q], REROLE + extra))
            for op, to, price in edits:
                told = (cost + price, ranks[p], "I" * inserts + op, p)
                if best[to] is None or told < best[to]:
                    best[to] = told
            q = _NEXT[q]
    order = sorted((b[1], b[2]) for b in best if b)
    least = min(b[0] for b in best if b)
    new = (tuple(b[0] - least if b else _INF for b in best), tuple(order.index((b[1], b[2])) if b else -1 for b in best))
    # two bits each: edit, inserts, former state
    mark = bytes(_OPS.index(b[2][-1]) << 4 | (len(b[2]) - 1) << 2 | b[3] if b else 0xFF for b in best)
    return new, least, mark


class _Spool:
    """Bytes that are appended, then read or changed at places; in memory up to a bound."""

    def __init__(self, memory: int):
        self.memory = memory
        self.clear()

    def add(self, data: bytes) -> None:
        self.file.write(data)

    def read(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return self.file.read(n)

    def put(self, at: int, data: bytes) -> None:
        self.file.seek(at)
        self.file.write(data)

    def stream(self) -> Iterator[bytes]:
        """The appended length-prefixed records, in order."""
        self.file.seek(0)
        while head := self.file.read(8):
            yield self.file.read(struct.unpack("<q", head)[0])

    def clear(self) -> None:
        self.file = tempfile.SpooledTemporaryFile(max_size=self.memory)


class _Conversation:
    """The open conversation of a stream."""

    def __init__(self, memory: int, steps: dict):
        self.marks, self.rows, self.steps = _Spool(memory), _Spool(memory), steps
        self.key = None
        self.reset()

    def reset(self) -> None:
        self.marks.clear()
        self.rows.clear()
        self.state, self.cost, self.n = _START, 0, 0
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.first = self.last = None
        self.turns = 0
        self.before: tuple | None = None

    def add(self, turn: int | None, role: str, text: str, fault: str, seen: bool) -> None:
        if turn is not None:
            self.first = turn if self.first is None else self.first
            self.turns += turn != self.last
            self.last = turn
        if fault != "blank" and (seen or self.before == (turn, role, text)):
            fault = "duplicate"
        if self.before is not None:
            self.illegal += self.before[1][:1] + role[:1] not in ("su", "ua", "au")
        self.before = (turn, role, text)
        self.blank += fault == "blank"
        self.duplicate += fault == "duplicate"
        self.truncated += fault == "truncated"
        initial = role[:1]
        kind = (initial if initial in ("s", "u", "a") else "", fault == "truncated", fault in ("blank", "duplicate"))
        got = self.steps.get((self.state, kind))
        if got is None:
            got = self.steps[self.state, kind] = _step(self.state, kind)
        self.state, cost, mark = got
        self.cost += cost
        self.marks.add(mark)
        a, b = role.encode(), text.encode()
        self.rows.add(struct.pack("<qq", 8 + len(a) + len(b), len(a)) + a + b)
        self.n += 1

    def trace(self) -> tuple[int, int]:
        """``(cost, inserts at the end)``; the first of a row's four bytes becomes the chosen one."""
        costs, ranks = self.state
        cost, _, at = min((costs[p] + INSERT * _END[p], ranks[p], p) for p in range(4) if costs[p] < _INF)
        last = _END[at]
        end = self.n
        while end:
            begin = max(0, end - _PIECE)
            data = bytearray(self.marks.read(4 * begin, 4 * (end - begin)))
            for i in range(len(data) - 4, -1, -4):
                mark = data[i + at]
                data[i] = mark
                at = mark & 3
            self.marks.put(4 * begin, bytes(data))
            end = begin
        return self.cost + cost, last

    def edits(self, last: int) -> Iterator[tuple[str, str, str]]:
        """``(edit, role, text)`` in order, deleted rows included."""
        state, rows = 0, self.rows.stream()
        for begin in range(0, self.n, _PIECE):
            data = self.marks.read(4 * begin, 4 * min(_PIECE, self.n - begin))
            for i in range(0, len(data), 4):
                row = next(rows)
                size = struct.unpack("<q", row[:8])[0]
                role, text = row[8:8 + size].decode(), row[8 + size:].decode()
                for _ in range(data[i] >> 2 & 3):
                    state = _NEXT[state]
                    yield "I", _ROLE[state], ""
                op = _OPS[data[i] >> 4]
                if op == "R":
                    state = _NEXT[state]
                    role = _ROLE[state]
                elif op == "K":
                    state = {"s": 1, "u": 2, "a": 3}[role[0]]
                yield op, role, text
        for _ in range(last):
            state = _NEXT[state]
            yield "I", _ROLE[state], ""


def _sorted(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, present: Column | None) -> DataFrame:
    """Rows with their own faults, dealt by conversation and sorted by turn.

    Whether a role and text were seen at an earlier turn is known from one aggregate over narrow
    columns; only those that occur at several turns are joined back.
    """
    role, text = F.coalesce(F.col(role_col), F.lit(" ")), F.coalesce(F.col(text_col), F.lit(" "))
    blank = ~F.rlike(text, F.lit(r"[^\x20\x09-\x0D]"))
    ended = F.rlike(text, F.lit(r"[.!?][\x20\x09-\x0D]*\z"))
    fault = F.when(blank, "blank").when(~ended, "truncated").otherwise("")
    told = rows.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"), role.alias("role"), text.alias("text"), fault.alias("fault"),
                       (F.lit(True) if present is None else F.coalesce(present, F.lit(False))).alias("present"))
    told = told.withColumn("known", F.coalesce(F.concat(F.lit("="), F.col("conv").cast("string")), F.lit("-"))).withColumn("same", F.md5(F.concat_ws(":", F.length("role"), "role", "text")))
    # the earliest turn, with null before all numbers
    firsts = told.filter("present and fault != 'blank'").groupBy("known", "same").agg(
        F.max(F.col("turn").isNull()).alias("from_null"), F.min("turn").alias("from"), F.max("turn").alias("to"))
    firsts = firsts.filter("to is not null and (from_null or from < to)").select("known", "same", "from_null", "from")
    told = told.join(firsts, ["known", "same"], "left")
    seen = F.col("turn").isNotNull() & (F.col("from_null") | (F.col("from") < F.col("turn")))
    told = told.select("known", "conv", "turn", "role", "text", "fault", "present", F.coalesce(seen, F.lit(False)).alias("seen"))
    return told.repartition("known").sortWithinPartitions("known", F.col("turn").asc_nulls_first(), "role", "text")


def _stream(batches: Iterator[pd.DataFrame], memory: int) -> Iterator[_Conversation]:
    """Each conversation of a partition when its last row has come; it is reset afterwards."""
    open_, steps = None, {}
    for batch in batches:
        for known, conv, turn, role, text, fault, present, seen in zip(*(batch[c].tolist() for c in batch.columns)):
            if open_ is None or open_.key[0] != known:
                if open_ is not None:
                    yield open_
                    open_.reset()
                else:
                    open_ = _Conversation(memory, steps)
                open_.key = (known, conv)
            if present:
                open_.add(None if turn is None else int(turn), role, text, fault, seen)
    if open_ is not None:
        yield open_


def report(rows: DataFrame, present: Column | None = None, memory: int = MEMORY, conv_col: str = "conv_id", turn_col: str = "turn",
           role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row a conversation: ``conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``.

    Every row has at most one fault: blank (nothing but white space), duplicate (its role and text
    came earlier in the conversation) or truncated (does not end with ``.``, ``!`` or ``?``).
    ``gaps`` counts the turns missing between the first and the last, ``illegal`` neighbours whose
    roles may not follow each other (by their first letters). Keeping a row is free, another role costs 3,
    deleting 4 (blank and duplicate rows must go), an inserted empty turn 3, and a truncated
    row that stays 3 more. ``audit`` holds the first letters of the cheapest edits in order, of
    equally cheap ones the first by ASCII; ``repaired_sha256`` is of the repaired ``role:text`` lines.

    Null roles and texts count as one space; null turns come first and are no turns for ``gaps``;
    a null conversation id is a conversation. Rows of one turn are ordered by role and text; repeated
    rows are duplicates. Rows for which ``present`` is not true only make their conversation
    appear: without other rows it has zeros, an empty audit and the hash of nothing. An empty table
    gives no rows. Other columns are not used.
    """
    told = _sorted(rows, conv_col, turn_col, role_col, text_col, present)
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")

    def work(batches):
        out: list = []
        size = 0
        for c in _stream(batches, memory):
            cost, last = c.trace()
            digest, audit, first = hashlib.sha256(), [], True
            for op, role, text in c.edits(last):
                audit.append(op)
                if op != "D":
                    digest.update(("" if first else "\n").encode() + f"{role}:{text}".encode())
                    first = False
            gaps = 0 if c.first is None else c.last - c.first + 1 - c.turns
            out.append((c.key[1], gaps, c.blank, c.duplicate, c.truncated, c.illegal, cost, "".join(audit), digest.hexdigest()))
            size += len(audit) + 200
            if size > 1 << 20:
                yield pd.DataFrame(out, columns=["conv", *names, "audit", "repaired_sha256"])
                out, size = [], 0
        if out:
            yield pd.DataFrame(out, columns=["conv", *names, "audit", "repaired_sha256"])

    # ids pass Python as text, so that null ones do not turn numbers into floats
    schema = T.StructType([T.StructField("conv", T.StringType())] + [T.StructField(c, T.LongType()) for c in names] + [T.StructField(c, T.StringType()) for c in ("audit", "repaired_sha256")])
    kind = rows.schema[conv_col].dataType
    found = told.withColumn("conv", F.col("conv").cast("string")).withColumn("turn", F.col("turn").cast("string")).mapInPandas(work, schema)
    return found.withColumn("conv", F.col("conv").cast(kind))


def repair(rows: DataFrame, memory: int = MEMORY, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The edits of all conversations: ``conv, place, edit, role, text``, places counting from 0.

    ``edit`` is K(eep), R(erole), I(nsert) or D(elete); without the deleted rows these are the
    repaired conversations. Costs and edge cases are those of ``report``.
    """
    told = _sorted(rows, conv_col, turn_col, role_col, text_col, None)

    def work(batches):
        out: list = []
        size = 0
        for c in _stream(batches, memory):
            _, last = c.trace()
            for place, (op, role, text) in enumerate(c.edits(last)):
                out.append((c.key[1], place, op, role, text))
                size += len(text) + 50
                if size > 1 << 20:
                    yield pd.DataFrame(out, columns=["conv", "place", "edit", "role", "text"])
                    out, size = [], 0
        if out:
            yield pd.DataFrame(out, columns=["conv", "place", "edit", "role", "text"])

    kind = rows.schema[conv_col].dataType
    found = told.withColumn("conv", F.col("conv").cast("string")).withColumn("turn", F.col("turn").cast("string")).mapInPandas(
        work, "conv string, place long, edit string, role string, text string")
    return found.withColumn("conv", F.col("conv").cast(kind))
