"""Quality rules with risk-controlled thresholds, in DataFrame functions only.

Signals of every text are put on integer grids. For each stratum and rule the labelled good
documents give, at every cutoff of the grid, the number that the rule would reject by mistake.
A cutoff is certified if, were its true false-rejection rate ``alpha / rules`` or more, so few
mistakes would have had a probability of at most ``delta / (strata * rules)`` (an exact binomial
bound, Bonferroni over strata and rules). Mistakes only grow as a cutoff gets stricter, so the
cutoffs form a fixed sequence that ends at the first failure and need no further correction.
All certified cutoffs hold at once with confidence ``1 - delta``; the strictest is used. The labels
serve the certificate alone, no other choice is made with them.
A stratum with too few labels to certify anything is judged by the base rules alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from hearth.llm.common import key_of, materialize

#: rule: grid steps for one unit of the signal; cutoffs run from 0 to GRID - 1
RULES = {"symbols": 50, "dup_lines": 100, "word_length": 10, "repeats": 100, "capitals": 100, "sameness": 100}
GRID = 400


def _once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are computed once a row, however often they are used later."""
    packed = F.explode(F.array(F.struct(*[c.alias(n) for n, c in columns.items()])))
    return df.withColumn("_p", packed).select(*df.columns, *[F.col(f"_p.{n}").alias(n) for n in columns])


def signals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang", key_col: str | None = None) -> DataFrame:
    """``id, key, stratum``, the base counts and the integer signal of every rule, per row.

    Words are runs of anything but space and U+0009..U+000D. ``key`` is a hash of the text, which
    tells apart rows that share an id. Null texts have no words; a null stratum is a stratum.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    d = docs.select(F.col(id_col).alias("id"), key_of(docs, key_col, text_col),
                    F.coalesce(F.concat(F.lit("="), F.col(stratum_col).cast("string")), F.lit("-")).alias("stratum"), text.alias("t"))
    d = _once(d, w=F.array_remove(F.split("t", r"[ \t-\r]+"), ""),
              lines=F.filter(F.split("t", "\n"), lambda x: F.btrim(x, F.lit(" \t\x0b\x0c\r")) != ""))
    d = _once(d, n=F.size("w"), triples=F.when(F.size("w") >= 3, F.transform(
        F.sequence(F.lit(0), F.size("w") - 3), lambda i: F.xxhash64(F.get("w", i), F.get("w", i + 1), F.get("w", i + 2))))
        .otherwise(F.array().cast("array<bigint>")))
    m = F.size("triples")
    # places of triples that occur twice or more: equal neighbours once sorted
    order = F.sort_array(F.transform("triples", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    d = _once(d, order=F.when(F.size(F.array_distinct("triples")) < m, order).otherwise(F.array().cast("array<struct<h:bigint,i:int>>")))
    k = F.greatest(F.size("order") - 1, F.lit(0))
    twice = F.flatten(F.zip_with(F.slice("order", 1, k), F.slice("order", 2, k), lambda a, b: F.when(
        a["h"] == b["h"], F.array(a["i"], a["i"] + 1, a["i"] + 2, b["i"], b["i"] + 1, b["i"] + 2)).otherwise(F.array().cast("array<int>"))))
    distinct_words = F.size(F.array_distinct("w"))
    d = d.select(
        "id", "key", "stratum", F.col("n").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("t", "[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.array_distinct(twice)).cast("long").alias("n_repeat_words"),
        F.size("lines").alias("n_lines"), distinct_words.alias("n_distinct"),
        F.length(F.regexp_replace("t", "[^A-Z]+", "")).alias("n_capitals"))
    words, lines, chars = (F.greatest(F.col(c), F.lit(1)) for c in ("n_words", "n_lines", "word_chars"))
    value = {"symbols": F.col("n_symbols") / words, "dup_lines": F.col("n_dup_lines") / lines,
             "word_length": F.col("word_chars") / words, "repeats": F.col("n_repeat_words") / words,
             "capitals": F.col("n_capitals") / chars, "sameness": 1 - F.col("n_distinct") / words}
    bins = [F.least(F.lit(GRID), F.floor(value[r] * s)).cast("int").alias(f"bin_{r}") for r, s in RULES.items()]
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return d.select("id", "key", "stratum", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), *bins)


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """Log of P(Binomial(n, p) <= k), summed term by term; for ``k <= n * p``."""
    step = F.lit(p / (1 - p))
    start = F.struct((n * F.log1p(F.lit(-p))).alias("term"), F.lit(1.0).alias("sum"))

    def add(a, i):
        grown = F.log((n - i + 1) / i * step)
        return F.struct((a["term"] + grown).alias("term"), (a["sum"] * F.exp(-grown) + 1.0).alias("sum"))

    steps = F.when(k >= 1, F.sequence(F.lit(1).cast("long"), F.greatest(k, F.lit(1)).cast("long"))).otherwise(F.array().cast("array<bigint>"))
    return F.aggregate(steps, start, add, lambda a: a["term"] + F.log(a["sum"]))


def certified_cutoffs(labelled: DataFrame, alpha: float = 0.01, delta: float = 0.05) -> DataFrame:
    """``(stratum, rule, cutoff)``: reject where the signal's bin is above the cutoff.

    ``labelled`` has ``stratum``, the ``bin_*`` columns and ``quality`` (1 good, 0 bad).
    """
    rules = len(RULES)
    strata = labelled.select(F.countDistinct("stratum").alias("strata"))
    long = labelled.select("stratum", "quality", F.explode(F.array(*[
        F.struct(F.lit(r).alias("rule"), F.col(f"bin_{r}").alias("bin")) for r in RULES])).alias("x")).select("stratum", "quality", "x.*")
    # one entry a cutoff: at most GRID + 1 a stratum and rule
    counts = long.groupBy("stratum", "rule", "bin").agg(F.sum("quality").alias("good"), F.sum(1 - F.col("quality")).alias("bad"))
    by = W.partitionBy("stratum", "rule")
    above = by.orderBy(F.desc("bin")).rowsBetween(W.unboundedPreceding, -1)
    at = counts.select(
        "stratum", "rule", F.col("bin").alias("cutoff"),
        F.coalesce(F.sum("good").over(above), F.lit(0)).alias("wrong"), F.coalesce(F.sum("bad").over(above), F.lit(0)).alias("right"),
        F.sum("good").over(by).alias("n_good"), F.sum("bad").over(by).alias("n_bad"))
    rate = alpha / rules
    at = at.filter(F.col("wrong") <= F.col("n_good") * rate).crossJoin(F.broadcast(strata))
    passed = binomial_tail(F.col("wrong"), F.col("n_good"), rate) <= F.log(F.lit(delta) / (F.col("strata") * rules))
    # the strictest one that the certificate allows; a rule that no bad row breaks stays unused
    return at.filter(passed & (F.col("right") > 0)).groupBy("stratum", "rule").agg(F.min("cutoff").alias("cutoff"))


def judge(docs: DataFrame, labels: DataFrame, alpha: float = 0.01, delta: float = 0.05,
          id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang", label_col: str = "quality", key_col: str | None = None) -> DataFrame:
    """The signals of every row with ``kept`` and the names of the rules that reject it (``failed``).

    ``kept`` is false under 50 words, with more than half of the words in repeated three-word
    windows, or above a certified cutoff of the row's stratum. Null and empty texts have no words
    and fail; an empty or null-only label table certifies nothing; of several labels of an id the
    lowest counts; repeated rows are judged one by one; other columns are not used.
    """
    base = materialize(signals(docs, id_col, text_col, stratum_col, key_col), "signals")
    known = labels.filter(F.col(label_col).isin(0, 1)).groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).alias("quality"))
    cutoffs = certified_cutoffs(base.join(known, "id"), alpha, delta)
    # the table has a row only for strata with enough labels to certify a cutoff
    table = materialize(cutoffs.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cut")), "cutoffs")
    over = F.array_compact(F.array(*[F.when(F.col(f"bin_{r}") > F.col("cut")[r], F.lit(r)) for r in RULES]))
    joined = base.join(table, "stratum", "left").withColumn("failed", F.coalesce(over, F.array().cast("array<string>")))
    return joined.withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0)).drop("cut")
