"""URL filter by a character language-model ratio, in DataFrame functions only.

Two variable-order Markov models over characters, one of accepted and one of rejected URLs, give
every character a probability from the longest context seen down to the empty one, interpolated
by Witten-Bell: an order with many different next characters gives more weight to the shorter
context. A URL's score is the mean log ratio of the two over its characters. The cut-off is set on
labelled URLs that the models have not seen.

Everything a character's ratio depends on is the window of ``order`` characters before it, so the
ratio is computed once for each distinct window of the table and joined to the URLs' windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearth.llm.common import materialize, row_key
from hearth.operators.quantiles import quantile_columns

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: symbols a character is drawn from before any context is known
ALPHABET = 256


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or without ``://``."""
    parts = r"(?s)^.*?://([^/?#]*+)([^?#]*+)"
    text = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(text, parts, 1), UPPER, LOWER), F.regexp_extract(text, parts, 2)


def rule_for(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """``(rule, verdict)`` of the longest rule that fits, else nulls.

    A rule is ``(host/path, verdict)``; it fits its host and all subdomains if the path starts
    with the rule's.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, told in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        own, _, rest = text.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith("/" + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(told)).otherwise(verdict)
    return rule, verdict


def _windows(text: Column, order: int) -> Column:
    """For each character and the end: the ``order`` characters before it, and itself."""
    chars = F.concat(F.array_repeat(F.lit("\x02"), order), F.filter(F.split(text, ""), lambda c: c != ""), F.array(F.lit("\x03")))
    return F.transform(F.sequence(F.lit(1), F.size("_c") - order), lambda i: F.array_join(F.slice("_c", i, order + 1), "")), chars


def _grams(df: DataFrame, order: int, *keep: str) -> DataFrame:
    """One row for each window of ``text``."""
    windows, chars = _windows(F.col("text"), order)
    once = df.select(*keep, F.explode(F.array(chars)).alias("_c"))
    return once.select(*keep, F.explode(windows).alias("gram"))


def _suffixes(order: int) -> Column:
    return F.explode(F.array(*[F.right("gram", F.lit(k + 1)) for k in range(order + 1)]))


def fit(labelled: DataFrame, order: int) -> tuple[DataFrame, DataFrame]:
    """Counts of the two models from ``text`` and ``accepted``.

    ``(suffix, a, r)``: occurrences of a context with its next character, any order;
    ``(context, na, ta, nr, tr)``: occurrences of a context and its different next characters.
    """
    grams = _grams(labelled, order, "accepted").groupBy("gram").agg(
        F.sum(F.col("accepted").cast("long")).alias("a"), F.sum((~F.col("accepted")).cast("long")).alias("r"))
    suffix = materialize(grams.select(_suffixes(order).alias("suffix"), "a", "r").groupBy("suffix").agg(F.sum("a").alias("a"), F.sum("r").alias("r")), "suffixes")
    context = suffix.groupBy(F.expr("substring(suffix, 1, char_length(suffix) - 1)").alias("context")).agg(
        F.sum("a").alias("na"), F.sum((F.col("a") > 0).cast("long")).alias("ta"), F.sum("r").alias("nr"), F.sum((F.col("r") > 0).cast("long")).alias("tr"))
    return suffix, context


def window_ratios(grams: DataFrame, suffix: DataFrame, context: DataFrame, order: int) -> DataFrame:
    """``(gram, ratio)``: log of accepted over rejected probability of a window's last character.

    Every window has the empty context, so its one row of counts is not met by a join on a key.
    """
    seen = ["na", "ta", "nr", "tr"]
    empty = context.filter("context = ''").agg(*[F.coalesce(F.max(c), F.lit(0)).alias(f"empty_{c}") for c in seen])
    own = F.when(F.length("suffix") == 1, F.concat(F.lit("\x04"), "gram")).otherwise(F.expr("substring(suffix, 1, char_length(suffix) - 1)"))
    each = grams.select("gram", _suffixes(order).alias("suffix")).withColumn("context", own)
    found = each.join(suffix, "suffix", "left").join(context.filter("context <> ''"), "context", "left").crossJoin(F.broadcast(empty))
    found = found.na.fill(0, ["a", "r", *seen])
    found = found.withColumns({c: F.when(F.length("suffix") == 1, F.col(f"empty_{c}")).otherwise(F.col(c)) for c in seen})
    steps = found.groupBy("gram").agg(F.sort_array(F.collect_list(F.struct(F.length("suffix").alias("k"), "a", "na", "ta", "r", "nr", "tr"))).alias("steps"))

    def blend(p: Column, n: Column, seen: Column, kinds: Column) -> Column:
        return F.when(seen > 0, (n + kinds * p) / (seen + kinds)).otherwise(p)

    even = F.lit(1.0 / ALPHABET)
    ratio = F.aggregate("steps", F.struct(even.alias("a"), even.alias("r")), lambda p, s: F.struct(
        blend(p["a"], s["a"], s["na"], s["ta"]).alias("a"), blend(p["r"], s["r"], s["nr"], s["tr"]).alias("r")), lambda p: F.log(p["a"]) - F.log(p["r"]))
    return steps.select("gram", ratio.alias("ratio"))


def scores(rows: DataFrame, suffix: DataFrame, context: DataFrame, order: int, salts: int = 8) -> DataFrame:
    """``(_row, score)``: mean log ratio over the characters of ``text`` and its end.

    Common windows occur in nearly every URL; both sides of the join are salted for them. Both
    are exploded, which Spark's estimate of their size ignores: the join is hinted to sort and merge.
    """
    grams = _grams(rows, order, "_row")
    ratios = window_ratios(grams.select("gram").distinct(), suffix, context, order)
    ratios = ratios.withColumn("salt", F.explode(F.array(*[F.lit(i) for i in range(salts)])))
    salted = grams.withColumn("salt", F.pmod(F.xxhash64("_row"), F.lit(salts)).cast("int"))
    return salted.join(ratios.hint("merge"), ["gram", "salt"]).groupBy("_row").agg(F.avg("ratio").alias("score"))


def calibrate(scored: DataFrame, false_rejection: float) -> tuple[DataFrame, Column]:
    """The cut-off from held-out URLs (``score``, ``accepted``): a table of one row.

    Halfway between the bulk of the rejected and of the accepted where they are apart, else the
    score that ``false_rejection`` of the accepted stay below. The quantiles are exact, whatever the
    number of URLs.
    """
    low = F.when(F.col("accepted"), F.col("score"))
    high = F.when(~F.col("accepted"), F.col("score"))
    found = quantile_columns(scored, [], [F.count(F.lit(1)).alias("n")], [(low, false_rejection, "low"), (high, 1 - false_rejection, "high")], needs=[])
    return found.select(
        F.when(F.col("high") < F.col("low"), (F.col("high") + F.col("low")) / 2).otherwise(F.col("low")).alias("cutoff"))


def seed_labels(host: Column, terms: list[str]) -> Column:
    """False where a part of the host between dots and hyphens is one of the terms, else true."""
    parts = F.split(host, "[.-]")
    return ~F.arrays_overlap(parts, F.array(*[F.lit(t) for t in terms]))


def filter_urls(pages: DataFrame, labelled: DataFrame, rules: list[tuple[str, str]], order: int = 5,
                false_rejection: float = 0.005, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``id, url, host, path, rule, score, verdict`` for every row of ``pages``.

    ``labelled`` has ``url`` and ``accepted``; all its distinct URLs are used: by a hash, four fifths
    fit the models and the rest set the cut-off. The verdict
    is the rule's, else ``allow`` if the score reaches the cut-off. Null URLs, those without
    ``://`` and others with neither host nor path are blocked unless a rule fits. Without labels of
    both kinds all other URLs are allowed. Repeated rows are judged one by one; other columns are
    not used.
    """
    host, path = split_url(F.col(url_col))
    rows = row_key(pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))).withColumn("host", host).withColumn("path", path)
    rows = materialize(rows.withColumn("text", F.concat("host", "path")), "urls")
    host, path = split_url(F.col("url"))
    known = labelled.select(F.concat(host, path).alias("text"), "accepted").filter("text <> '' and accepted is not null")
    known = known.groupBy("text").agg(F.every("accepted").alias("accepted")).withColumn("order", F.xxhash64("text"))
    picked = materialize(row_key(known), "labelled")
    suffix, context = fit(picked.filter(F.pmod("order", F.lit(5)) != 0), order)
    held = picked.filter(F.pmod("order", F.lit(5)) == 0)
    cutoff = calibrate(held.join(scores(held, suffix, context, order), "_row"), false_rejection)
    judged = rows.join(scores(rows.filter("text <> ''"), suffix, context, order), "_row", "left").crossJoin(F.broadcast(cutoff))
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("text") == "", "block").when(F.col("cutoff").isNull() | (F.col("score") >= F.col("cutoff")), "allow").otherwise("block")
    return judged.select("id", "url", "host", "path", rule.alias("rule"), "score", F.coalesce(verdict, own).alias("verdict"))
