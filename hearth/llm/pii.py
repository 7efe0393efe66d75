"""Personal data by base rules and bootstrapped contextual extraction, in DataFrame functions only.

Base rules find emails, IPv4 addresses, card and phone numbers. Their instances seed the method:
every identifier-shaped string is an instance (base ones known, others not) and the words right
before it are lexical patterns, which gives a graph of patterns and instances. Round by round a
pattern is scored by the distinct instances it introduces: known ones of its main kind against known
ones of other kinds and unknown ones whose shape the kind never has. Unknown ones that fit the kind
say nothing about it, however many. High-confidence patterns with enough support make these known,
which feeds the next round, until none is added.

Only the words before a string and the string itself leave the text; the graph is aggregated to
distinct edges before it is joined, so a string or pattern that occurs in a third of all
documents counts once per edge.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from hearth.llm.common import key_of, materialize, row_key
from hearth.llm.quality import _once

KINDS = ["email", "ip", "card", "phone"]
# The base rules. Possessive forms and starts bound to the start of a run (or to the end of the
# last match) find the same matches without retrying inside long runs.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_DOT = r"(?: ?[\[({](?:\.|dot|DOT)[\])}] ?| \. )"
_HEX = "[0-9A-Fa-f]{1,4}"
#: identifier-shaped strings that no base rule may have taken: numbers, addresses written out, and
#: hosts: four bytes with dots in brackets or between spaces, and IPv6
SHAPES = {
    "number": r"(?<![A-Za-z0-9.+(])[(]?[0-9](?:[ ().:/-]{0,2}[0-9]){6,24}+(?![A-Za-z0-9])",
    "address": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?[\[({](?:at|AT)[\])}] ?[A-Za-z0-9-]{1,63}(?:(?: ?[\[({](?:dot|DOT)[\])}] ?|\.)[A-Za-z0-9-]{1,63})+",
    "host": rf"(?<![A-Za-z0-9.:-])(?:{_BYTE}(?:{_DOT}{_BYTE}){{3}}|(?:{_HEX}:){{7}}{_HEX}|(?:{_HEX}:){{1,6}}(?::{_HEX}){{1,6}})(?![A-Za-z0-9:-])",
}
_CONTEXT = 80


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]+", "")


def _luhn(digits: Column) -> Column:
    def add(total, i):
        d = F.substring(F.reverse(digits), i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(i % 2 == 0, twice).otherwise(d)
    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _valid() -> Column:
    """Whether a match of a base rule stands."""
    digits = _digits(F.col("value"))
    n = F.length(digits)
    return (
        F.when(F.col("kind") == "email", F.lit(True))
        .when(F.col("kind") == "ip", F.col("value").rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$"))
        .when(F.col("kind") == "card", F.when((n >= 12) & (n <= 19), _luhn(digits)).otherwise(False))
        .when(F.col("kind") == "phone", (n >= 9) & (n <= 15))
        .otherwise(False))


def search(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", key_col: str | None = None) -> DataFrame:
    """``id, key, hits`` for every row: the matches of all rules and shapes, in order of each kind.

    A hit has its ``kind``, its number ``i``, the ``value``, the length of the ``gap`` since the
    last match of its kind (or the start of the text) and the end of the text ``before`` it.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    d = docs.select(F.col(id_col).alias("id"), key_of(docs, key_col, text_col), text.alias("t"))
    has = {"email": F.contains("t", F.lit("@")), "phone": F.contains("t", F.lit("+")), "address": F.col("t").rlike(r"(?:at|AT)[\])}]"),
           "host": F.col("t").rlike(r"[0-9] ?[\[({](?:\.|dot|DOT)[\])}]|[0-9] \. [0-9]|[0-9A-Fa-f]:(?::|[0-9A-Fa-f]{1,4}:)[0-9A-Fa-f]")}
    digit = F.col("t").rlike("[0-9]")
    rules = BASE | SHAPES
    none = F.array().cast("array<string>")
    d = _once(d, **{f"m_{k}": F.when(has.get(k, digit), F.regexp_extract_all("t", F.lit(r), F.lit(0))).otherwise(none) for k, r in rules.items()})
    d = _once(d, **{f"p_{k}": F.when(F.size(f"m_{k}") > 0, F.split("t", r, -1)).otherwise(none) for k, r in rules.items()})

    def found(k: str) -> Column:
        return F.when(F.size(f"m_{k}") > 0, F.transform(f"m_{k}", lambda m, i: F.struct(
            F.lit(k).alias("kind"), i.alias("i"), m.alias("value"), F.length(F.get(f"p_{k}", i)).alias("gap"),
            F.right(F.get(f"p_{k}", i), F.lit(_CONTEXT)).alias("before")))).otherwise(
                F.array().cast("array<struct<kind:string,i:int,value:string,gap:int,before:string>>"))

    return d.select("id", "key", F.concat(*[found(k) for k in rules]).alias("hits"))


def strings(searched: DataFrame) -> DataFrame:
    """Matches as rows: ``_row, kind, start, end, value, before``, in code points.

    ``searched`` has ``hits`` and a row key ``_row`` that no other row has. A rule's matches and
    the text between them follow one another, so a match ends at the sum of the lengths up to it.
    """
    hits = searched.select("_row", F.explode("hits").alias("x")).select("_row", "x.*")
    upto = W.partitionBy("_row", "kind").orderBy("i").rowsBetween(W.unboundedPreceding, 0)
    hits = hits.withColumn("end", F.sum(F.col("gap") + F.length("value")).over(upto))
    return hits.select("_row", "kind", (F.col("end") - F.length("value")).alias("start"), "end", "value", "before")


def _instances(hits: DataFrame) -> DataFrame:
    """Standing base matches, and the shapes that overlap none of them (``kind`` null)."""
    own = hits.withColumn("base", F.col("kind").isin(KINDS)).filter(~F.col("base") | _valid())
    by = W.partitionBy("_row").orderBy("start", "end")
    earlier = F.max(F.when(F.col("base"), F.col("end"))).over(by.rowsBetween(W.unboundedPreceding, -1))
    later = F.min(F.when(F.col("base"), F.col("start"))).over(by.rowsBetween(1, W.unboundedFollowing))
    own = own.withColumn("earlier", earlier).withColumn("later", later)
    free = (F.coalesce("earlier", F.lit(0)) <= F.col("start")) & (F.col("later").isNull() | (F.col("later") >= F.col("end")))
    own = own.filter(F.col("base") | free)
    shape = F.when(F.col("base"), F.lit(None)).otherwise(F.col("kind"))
    name = F.when(F.col("value").rlike("@"), F.lower("value")).when(F.col("kind") == "host", F.regexp_replace(F.lower("value"), " ", "")).otherwise(F.regexp_replace(F.lower("value"), r"[ ().:/+-]+", ""))
    return own.select("_row", F.when(F.col("base"), F.col("kind")).alias("kind"), shape.alias("shape"), "start", "end", "value", "before", name.alias("name"))


def _patterns() -> Column:
    """Lexical patterns of a string: the last word and the last two words before it."""
    words = F.regexp_extract_all(F.regexp_replace(F.lower("before"), "[0-9]", "0"), F.lit(r"[^ \t-\r]+"), F.lit(0))
    n = F.size("w")
    one = F.when(n >= 1, F.concat(F.lit("1 "), F.get("w", n - 1)))
    two = F.when(n >= 2, F.concat(F.lit("2 "), F.get("w", n - 2), F.lit(" "), F.get("w", n - 1)))
    return words, F.array_compact(F.array(one, two))


def _fits(kind: Column, shape: Column, name: Column) -> Column:
    n = F.length(_digits(name))
    return ((shape == "address") & (kind == "email")) | ((shape == "host") & (kind == "ip")) | ((shape == "number") & (
        ((kind == "phone") & (n >= 7) & (n <= 15)) | ((kind == "card") & (n >= 12) & (n <= 19))))


def bootstrap(found: DataFrame, support: int = 8, confidence: float = 0.9, rounds: int | None = None) -> DataFrame:
    """``(name, shape, learned)``: unknown instances and the kind that confident patterns give them.

    Rounds go on until one adds none (instances are only added, so that comes), or for ``rounds``.
    """
    words, patterns = _patterns()
    edges = materialize(
        found.select("name", "shape", "kind", words.alias("w")).select("name", "shape", "kind", F.explode(patterns).alias("pattern"))
        .groupBy("pattern", "name", "shape").agg(F.max("kind").alias("kind")), "edges")
    learned = None
    last = 0
    for _ in itertools.count() if rounds is None else range(rounds):
        seen = edges if learned is None else edges.join(learned, ["name", "shape"], "left").withColumn("kind", F.coalesce("kind", "learned"))
        by_kind = seen.groupBy("pattern").agg(
            *[F.sum(F.when(F.col("kind") == k, 1).otherwise(0)).alias(k) for k in KINDS],
            *[F.sum(F.when(F.col("kind").isNull() & _fits(F.lit(k), F.col("shape"), F.col("name")), 1).otherwise(0)).alias(f"fit_{k}") for k in KINDS],
            F.sum(F.when(F.col("kind").isNull(), 1).otherwise(0)).alias("unknown"))
        best = F.greatest(*[F.struct(F.col(k).alias("n"), F.lit(k).alias("kind"), F.col(f"fit_{k}").alias("fit")) for k in KINDS])
        others = sum((F.col(k) for k in KINDS), F.lit(0)) - F.col("best.n")
        scored = by_kind.withColumn("best", best).withColumn("score", F.col("best.n") / (F.col("best.n") + others + F.col("unknown") - F.col("best.fit")))
        good = scored.filter((F.col("best.n") >= support) & (F.col("score") >= confidence) & (F.col("best.fit") > 0)).select("pattern", F.col("best.kind").alias("learned"), "score")
        new = edges.filter("kind is null").join(good, "pattern").filter(_fits(F.col("learned"), F.col("shape"), F.col("name")))
        # an instance is accepted with the kind whose patterns together leave the least doubt
        doubt = new.groupBy("name", "shape", "learned").agg(F.sum(F.log(1.0001 - F.col("score"))).alias("doubt"))
        new = doubt.groupBy("name", "shape").agg(F.min(F.struct("doubt", "learned")).alias("x")).select("name", "shape", "x.learned")
        if learned is not None:
            new = learned.unionByName(new.join(learned, ["name", "shape"], "left_anti"))
        learned = materialize(new, "learned")
        now = learned.count()
        if now == last:
            break
        last = now
    return learned


def personal_data(docs: DataFrame, support: int = 8, confidence: float = 0.9, rounds: int | None = None,
                  id_col: str = "doc_id", text_col: str = "text", key_col: str | None = None) -> DataFrame:
    """``id, key, base, spans`` for every row of ``docs``.

    ``base`` and ``spans`` are arrays of ``(start, rank, kind, end)`` in code points, end exclusive,
    in order of start and kind: the base rules' and all. ``key`` is the row's ``key_col``, by default a hash of the text. Null and
    empty texts have none; texts of any length are searched whole; repeated rows are searched one
    by one, and count once as evidence; an empty table learns nothing. Other columns are not used.
    """
    # a key of its own for each row, fixed by writing it: rows that agree in id and text stay apart
    rows = materialize(row_key(search(docs, id_col, text_col, key_col)), "searched")
    found = materialize(_instances(strings(rows)), "strings")
    learned = bootstrap(found, support, confidence, rounds)
    kind = F.coalesce("kind", "learned")
    rank = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("k")).cast("int")
    spans = (
        found.join(learned, ["name", "shape"], "left").withColumn("k", kind).filter("k is not null")
        .groupBy("_row").agg(
            F.sort_array(F.collect_set(F.struct("start", rank.alias("rank"), F.col("k").alias("kind"), "end"))).alias("spans"),
            F.sort_array(F.collect_set(F.when(F.col("kind").isNotNull(), F.struct("start", rank.alias("rank"), F.col("k").alias("kind"), "end")))).alias("base")))
    none = F.array().cast("array<struct<start:bigint,rank:int,kind:string,end:bigint>>")
    return rows.select("_row", "id", "key").join(spans, "_row", "left").select(
        "id", "key", F.coalesce("base", none).alias("base"), F.coalesce("spans", none).alias("spans"))


def redact(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; overlapping spans by the first."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))

    def cut(a, s):
        kept = F.concat(a["out"], F.substring(text, (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int")), F.lit("["), F.upper(s["kind"]), F.lit("]"))
        return F.when(s["start"] >= a["at"], F.struct(kept.alias("out"), s["end"].alias("at"))).otherwise(
            F.struct(a["out"].alias("out"), F.greatest(a["at"], s["end"]).alias("at")))

    return F.aggregate(spans, start, cut, lambda a: F.concat(a["out"], F.substring(text, (a["at"] + 1).cast("int"), F.length(text))))
