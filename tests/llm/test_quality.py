import math
import re
from collections import Counter

from hearth.llm.quality import RULES, binomial_tail, certified_cutoffs, judge, signals
from pyspark.sql import functions as F


def brute(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    triples = Counter(zip(w, w[1:], w[2:]))
    again = {j for i in range(len(w) - 2) if triples[tuple(w[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(again),
            len(w) < 50 or 100 * len(again) > 50 * len(w))


def test_base_equals_brute_force(docs, doc_rows):
    got = signals(docs).collect()
    got = sorted(((r["id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) for r in got), key=str)
    assert got == sorted(((d, *brute(t)) for d, t, *_ in doc_rows), key=str)


def test_binomial_tail_is_exact(spark):
    cases = [(0, 100, 0.02), (1, 100, 0.02), (5, 900, 0.01), (40, 20_000, 0.004), (0, 1_000_000, 0.001)]
    for k, n, p in cases:
        got = spark.range(1).select(binomial_tail(F.lit(k), F.lit(n), p)).first()[0]
        terms = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p) for i in range(k + 1)]
        top = max(terms)
        assert math.isclose(got, top + math.log(sum(math.exp(t - top) for t in terms)), rel_tol=1e-6)


def test_cutoffs_hold_the_certified_rate(spark):
    bins = {f"bin_{r}": F.lit(0) for r in RULES}
    good = spark.range(20_000).select(F.lit("a").alias("stratum"), F.lit(1).alias("quality"), (F.col("id") % 200 == 0).cast("int").alias("odd"))
    bad = spark.range(2000).select(F.lit("a").alias("stratum"), F.lit(0).alias("quality"), F.lit(300).alias("odd"))
    few = spark.range(100).select(F.lit("b").alias("stratum"), (F.col("id") % 2).cast("int").alias("quality"), F.lit(9).alias("odd"))
    rows = good.unionByName(bad).unionByName(few).select("stratum", "quality", *[(F.col("odd") if c == "bin_symbols" else v).alias(c) for c, v in bins.items()])
    # one in 200 good rows lies above 0: too many for 0.01 / 6 a rule, so the cutoff is 1
    assert [tuple(r) for r in certified_cutoffs(rows).collect()] == [("a", "symbols", 1)]
    # at 0.2 / 6 one in 200 is allowed, and the strictest cutoff is taken
    loose = certified_cutoffs(rows, alpha=0.2).collect()
    assert [tuple(r) for r in loose] == [("a", "symbols", 0)]


def test_verdicts_and_edges(spark, docs, no_docs, doc_rows):
    labels = spark.createDataFrame([(i, 1, 0) for i in range(5)] + [(None, 1, None), (3, 0, 0), (4, None, 1)], "doc_id long, quality int, toxic int")
    rows = judge(docs, labels).collect()
    assert len(rows) == len(doc_rows) and all(r["kept"] == (not r["base_failed"]) for r in rows)
    assert judge(no_docs, labels).collect() == []
    assert judge(docs, labels.limit(0)).count() == len(doc_rows)
