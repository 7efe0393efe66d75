import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from hearth.llm.lm import LogBilinear, contexts, score
from pyspark.sql import functions as F

LOWER = {i: i + 32 for i in range(65, 91)}


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)), None]


def test_base_equals_brute_force(docs, doc_rows):
    learn = [r for r in doc_rows if r[0] is not None and r[0] % 3]
    count = Counter(w for _, t, *_ in learn for w in tokens(t))
    n = sum(count.values())
    scale = n + 0.5 * (len(count) + 1)
    got = score(docs, docs.filter("doc_id % 3 <> 0"), frequent=20, sample_tokens=50_000).collect()
    want = {}
    for d, t, *_ in doc_rows:
        ws = tokens(t)
        want.setdefault((d, len(ws), sum(count[w] > 0 for w in ws)), []).append(sum(math.log10((count[w] + 0.5) / scale) for w in ws))
    assert len(got) == len(doc_rows)
    for r in got:
        assert r["train_tokens"] == n
        assert any(r["base_score"] == pytest.approx(b, rel=1e-9) for b in want[r["id"], r["n_tokens"], r["n_known"]])
    held = [r for r in got if r["id"] is not None and r["id"] < 10**6 and r["id"] % 3 == 0]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_contexts_stay_inside_a_text():
    classes, first = np.array([3, 1, 2, 0, 0, 4, 0]), np.array([0, 4, 5, 7])
    start = 5
    pairs = [tuple(divmod(c, start + 1)) for c in contexts(classes, first, start).tolist()]
    assert pairs == [(5, 5), (5, 3), (3, 1), (1, 2), (5, 5), (5, 5), (5, 4)]


def test_model_is_normalised_and_learns():
    rng = np.random.default_rng(0)
    n = 6
    model = LogBilinear(n, np.array([10, 10, 10, 10, 10, 10.0]), size=8)
    context = rng.integers(0, (n + 1) ** 2, 3000)
    word = (context % (n + 1)) % n  # the next class is the one before
    before = model.log10(context, word).mean()
    model.fit(context, word, np.ones(3000, np.int64), epochs=30, batch=256)
    assert model.log10(context, word).mean() > before + 0.3
    one = np.full(n, 9)
    assert (10 ** model.log10(one, np.arange(n))).sum() == pytest.approx(1, abs=1e-5)
    # batches give what single calls give
    assert np.allclose(model.log10(context, word, batch=3), model.log10(context, word))


def test_probabilities_of_one_place_sum_to_one(spark):
    # every training token and one unseen token as one-word texts, less the end's share
    words = ["a", "b", "cc", "dd", "ee", "ff"]
    train = spark.createDataFrame([(i, " ".join(words[: i % 6 + 1])) for i in range(60)], "doc_id long, text string")
    ask = spark.createDataFrame([(i, w) for i, w in enumerate([*words, ""])], "doc_id long, text string")
    got = {r["id"]: r for r in score(ask, train, frequent=3, sample_tokens=10_000).collect()}
    assert all(r["score"] < 0 for r in got.values()) and all(got[i]["n_known"] == 2 for i in range(6))
    assert 0 < 10 ** got[6]["score"] < 1


def test_no_training_rows_and_no_rows(spark, docs, no_docs):
    rows = score(docs.limit(10), no_docs).collect()
    assert len(rows) == 10 and all(r["train_tokens"] == 0 and r["n_known"] == 0 and abs(r["base_score"]) < 1e-9 and r["score"] < 0 for r in rows)
    assert score(no_docs, docs.limit(10)).collect() == []


def test_a_token_of_many_repeats(spark):
    train = spark.createDataFrame([(1, "zz " * 70_000 + "yy"), (2, "x y z")], "doc_id long, text string")
    r = next(r for r in score(train, train.filter("doc_id = 2"), frequent=2).collect() if r["id"] == 1)
    n, v = 4, 4
    assert (r["n_tokens"], r["n_known"]) == (70_002, 1)
    scale = n + 0.5 * (v + 1)
    assert r["base_score"] == pytest.approx(70_001 * math.log10(0.5 / scale) + math.log10(1.5 / scale), rel=1e-9)
    assert train.select(F.count("*")).first()[0] == 2


def test_words_beyond_the_commonest_have_contexts(spark):
    # a rule between words of one ending, rarer than 300 others: which one follows, not just its ending
    rng = random.Random(2)
    common, rare = [f"c{i}" for i in range(300)], [f"{i}rr" for i in range(40)]

    def text(off):
        i = rng.randrange(40)
        return " ".join([*rng.choices(common, k=24), rare[i], rare[(i * 7 + off) % 40]])

    train = spark.createDataFrame([(i, text(3)) for i in range(6000)], "doc_id long, text string").repartition(4)
    ask = spark.createDataFrame([(i, text(3 + i % 2)) for i in range(400)], "doc_id long, text string")
    gain = [0.0, 0.0]
    for r in score(ask, train).collect():
        gain[r["id"] % 2] += (r["score"] - r["base_score"]) / 200
    assert gain[0] > gain[1] + 0.5


def test_gradients_add_up():
    rng = np.random.default_rng(4)
    model = LogBilinear(30, rng.integers(1, 50, 30).astype(float), size=8)
    context, word = rng.integers(0, 31**2, 500), rng.integers(0, 30, 500)
    whole, parts = model.zeros(), model.zeros()
    model.add(whole, context, word)
    for at in range(0, 500, 70):
        model.add(parts, context[at:at + 70], word[at:at + 70])
    assert all(np.allclose(a, b, rtol=1e-3, atol=1e-3) for a, b in zip(whole, parts)) and whole[-1][0] == 500
