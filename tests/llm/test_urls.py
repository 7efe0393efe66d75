import math
from collections import Counter, defaultdict

import numpy
import pytest
from hearth.llm.queries import URL_RULES, URL_TERMS
from hearth.llm.urls import calibrate, filter_urls, fit, rule_for, scores, seed_labels, split_url
from pyspark.sql import functions as F


def brute_split(url):
    _, sep, rest = (url or "").partition("://")
    if not sep:
        return "", ""
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, rest = rest[:cut], rest[cut:]
    cut = min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), rest[:cut]


URLS = [None, "", "no scheme", "http://", "HTTP://A.Example.NET/en/x?y#z", "https://example.net", "https://example.net/EN/", "x://a://b/c", "http://É.org/fr/1",
        "http://notexample.com/de/1", "http://www.example.com/de/1", "http://org/fr/", "http://net/", "http://a.net?x", "http://u@h.org:80/fr/\n1#", "s://h/" + "p" * 20_000]


def brute_rule(host, path):
    best = (None, None)
    for text, verdict in URL_RULES:
        own, _, rest = text.partition("/")
        if (host == own or host.endswith("." + own)) and path.startswith("/" + rest) and (best[0] is None or len(text) > len(best[0])):
            best = (text, verdict)
    return best


def test_parts_and_rules(spark):
    host, path = split_url(F.col("url"))
    df = spark.createDataFrame(list(enumerate(URLS)), "i int, url string").select("i", host.alias("h"), path.alias("p"))
    rule, verdict = rule_for(F.col("h"), F.col("p"), URL_RULES)
    for r in df.select("*", rule.alias("rule"), verdict.alias("verdict")).collect():
        assert (r["h"], r["p"]) == brute_split(URLS[r["i"]])
        assert (r["rule"], r["verdict"]) == brute_rule(r["h"], r["p"])


def brute_scores(train, texts, order):
    counts = {True: defaultdict(Counter), False: defaultdict(Counter)}
    windows = lambda t: [(("\x02" * order + t + "\x03")[i:i + order], (t + "\x03")[i]) for i in range(len(t) + 1)]
    for t, accepted in train:
        for context, c in windows(t):
            for k in range(order + 1):
                counts[accepted][context[order - k:]][c] += 1

    def p(model, context, c):
        out = 1 / 256
        for k in range(order + 1):
            seen = counts[model].get(context[order - k:])
            if seen:
                out = (seen[c] + len(seen) * out) / (sum(seen.values()) + len(seen))
        return out

    return [sum(math.log(p(True, h, c) / p(False, h, c)) for h, c in windows(t)) / (len(t) + 1) for t in texts]


def test_scores_equal_brute_force(spark):
    train = [("abc.com/en", True), ("abd.com/de", True), ("win-win.com", False), ("é😀.net", False), ("abc.com/en", False)]
    texts = ["abc.com/en", "win", "zzz", "é😀", "a"]
    suffix, context = fit(spark.createDataFrame(train, "text string, accepted boolean"), 3)
    rows = spark.createDataFrame(list(enumerate(texts)), "_row long, text string")
    got = {r["_row"]: r["score"] for r in scores(rows, suffix, context, 3).collect()}
    for i, want in enumerate(brute_scores(train, texts, 3)):
        assert got[i] == pytest.approx(want, abs=1e-9)


def test_filter_catches_held_out_hosts(spark):
    good = [f"https://{n}.example.com/en/{i}" for n in ("garden", "history", "music", "science") for i in range(40)]
    bad = [f"http://{n}.example.com/en/{i}" for n in ("casino-win", "cheap-pills", "free-bets", "adult-x") for i in range(40)]
    new = ["http://casino-free.example.com/en/9", "http://cheap-bets.example.com/en/1", "https://garden-music.example.com/en/2"]
    pages = spark.createDataFrame([*enumerate([*good, *bad, *new]), (None, None), (7, good[0]), (7, good[0])], "page_id long, url string").withColumn("score", F.lit("clash"))
    labelled = pages.limit(320).select("url", seed_labels(split_url(F.col("url"))[0], URL_TERMS).alias("accepted"))
    rows = filter_urls(pages, labelled, [("example.com/en/39", "allow")]).collect()
    assert len(rows) == len(good) + len(bad) + len(new) + 3
    told = {r["url"]: r for r in rows}
    assert all(told[u]["verdict"] == "allow" for u in [*good, new[2]])
    assert all(told[u]["verdict"] == ("allow" if u.endswith("/39") else "block") for u in [*bad, *new[:2]])
    assert told[None]["verdict"] == "block" and told[None]["score"] is None


def test_without_labels_or_rows(spark):
    pages = spark.createDataFrame([(1, "http://a.org/fr/x"), (2, "http://b.net/"), (3, "http://c.com/")], "page_id long, url string")
    none = pages.select("url", F.lit(True).alias("accepted")).limit(0)
    assert {r["id"]: r["verdict"] for r in filter_urls(pages, none, URL_RULES).collect()} == {1: "allow", 2: "block", 3: "allow"}
    assert filter_urls(pages.limit(0), none, URL_RULES).collect() == []


def test_all_labelled_urls_fit_the_models(spark, monkeypatch):
    # 20,500 accepted URLs and one rejected: every distinct one fits or sets the cut-off
    from hearth.llm import urls
    held = {}

    def fitted(labelled, order):
        held["fit"] = labelled.count()
        return fit(labelled, order)

    def cut(scored, false_rejection):
        held["cut"] = scored.count()
        return calibrate(scored, false_rejection)

    monkeypatch.setattr(urls, "fit", fitted)
    monkeypatch.setattr(urls, "calibrate", cut)
    known = spark.range(20_500).select(F.concat(F.lit("http://a/"), F.col("id").cast("string")).alias("url"), F.lit(True).alias("accepted"))
    known = known.unionByName(spark.createDataFrame([("http://bets/", False)], known.schema))
    pages = spark.createDataFrame([(1, "http://a/1"), (2, "http://bets/1")], "page_id long, url string")
    assert len(filter_urls(pages, known, [], order=1).collect()) == 2
    assert held["fit"] + held["cut"] == 20_501


def test_cutoff_is_the_exact_quantile(spark):
    good, bad = [i * 0.37 % 5 for i in range(501)], [i * 0.11 % 3 for i in range(77)]
    df = spark.createDataFrame([*((x, True) for x in good), *((x, False) for x in bad), (None, True)], "score double, accepted boolean")
    assert calibrate(df, 0.005).first()["cutoff"] == pytest.approx(numpy.quantile(good, 0.005), abs=1e-12)
    assert calibrate(df.filter(F.col("accepted")), 0.5).first()["cutoff"] == pytest.approx(numpy.quantile(good, 0.5), abs=1e-12)
    assert calibrate(df.limit(0), 0.5).first()["cutoff"] is None
