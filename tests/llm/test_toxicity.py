import math
import random
import re
from collections import Counter

import numpy as np
from hearth.llm.toxicity import Index, isotonic, score
from pyspark.sql import functions as F


def brute_nearest(vectors, query, k):
    """Cosines and places of the k nearest vectors and of those as near as the last."""
    cos = sorted(((round(sum(w * dict(zip(*v)).get(t, 0.0) for t, w in zip(*query)), 9), i) for i, v in enumerate(vectors)), reverse=True)
    edge = cos[min(k, len(cos)) - 1][0]
    return {(c, i) for c, i in cos if c >= edge}


def test_block_max_search_is_exact():
    rng = random.Random(5)
    terms = 40
    plain = []
    for _ in range(700):
        # the first three terms are in most vectors, so both kinds of postings are met
        t = sorted({*rng.sample(range(3), rng.randint(0, 3)), *rng.sample(range(terms), rng.randint(0, 6))})
        w = [rng.random() for _ in t] + [0.3]
        n = sum(x * x for x in w) ** 0.5
        plain.append(((*t, terms), tuple(round(x / n, 9) for x in w)))
    plain += plain[:50]
    vectors = [(np.array(t), np.array(w)) for t, w in plain]
    labels = [rng.randint(0, 1) for _ in vectors]
    index = Index(vectors, list(range(len(vectors))), labels, terms)
    place = [index.entry[index.key(v)] for v in vectors]
    assert len(set(place)) == len({*plain}) and index.rows.shape[1] < terms
    for q in range(0, len(plain), 17):
        near = index.nearest(vectors[q], 9)
        want = brute_nearest(plain, plain[q], 9)
        assert {(round(c, 8), e) for c, e in near} == {(round(c, 8), place[i]) for c, i in want}
        assert near == sorted(near, key=lambda x: (-x[0], x[1]))


def _vectors(texts, labels):
    """Plain dictionaries of weights by the definition: every word of every text."""
    counts = [Counter(re.findall(r"[a-z\x80-\U0010ffff]+", t.lower())) for t in texts]
    df = Counter(w for c in counts for w in c)
    n, t = len(labels), sum(labels.values())
    out = []
    for c in counts:
        v = {"": 1.0}
        for w, f in c.items():
            held = [labels[i] for i in labels if w in counts[i]]
            a, m = sum(held), len(held)
            chi = n * (a * n - m * t) ** 2 / (m * (n - m) * t * (n - t)) if 0 < m < n else 0.0
            v[w] = (1 + math.log(f)) * (math.log((1 + len(texts)) / (1 + df[w])) + 1) * max(1.0, chi)
        size = math.sqrt(sum(x * x for x in v.values()))
        out.append({w: x / size for w, x in v.items()})
    return out


def test_evidence_equals_cosines_over_all_terms(spark):
    docs = _corpus(spark).filter("doc_id < 240").union(spark.createDataFrame([(5000, "", 0), (5001, "only newwords here, vile ones", 1)], "doc_id long, text string, toxic int"))
    rows = docs.orderBy("doc_id").collect()
    train = {i: r["toxic"] for i, r in enumerate(rows) if r["doc_id"] % 5}
    vectors = _vectors([r["text"] for r in rows], train)
    got = {r["id"]: r for r in score(docs, docs.filter("doc_id % 5 <> 0").select("doc_id", "toxic"), k=5).collect()}
    for i, r in enumerate(rows):
        want = sorted((sum(x * vectors[j].get(w, 0.0) for w, x in vectors[i].items()) for j in train), reverse=True)[:5]
        assert np.allclose([e["cosine"] for e in got[r["doc_id"]]["evidence"]], want, atol=1e-7)


def test_near_copies_of_toxic_examples_with_rare_words_are_found(spark):
    """No word of these is known as toxic: each example has rare words of its own."""
    rng = random.Random(8)
    docs = _corpus(spark)
    word = lambda: "".join(rng.choice("mnopqrst") for _ in range(7))
    rare = [[word() for _ in range(40)] for _ in range(20)]
    extra = [(10_000 + 16 * i + j, " ".join(w), 1) for i, w in enumerate(rare) for j in range(16)]
    copies = [(90_000 + i, " ".join(w[:3] + [word()] + w[4:]), 1) for i, w in enumerate(rare)]
    schema = "doc_id long, text string, toxic int"
    train = docs.union(spark.createDataFrame(extra, schema))
    got = score(train.union(spark.createDataFrame(copies, schema)), train.select("doc_id", "toxic")).filter("id >= 90000").collect()
    assert len(got) == 20 and all(r["score"] >= 0.7 for r in got)


def test_isotonic_is_increasing_and_keeps_the_mean():
    rng = np.random.default_rng(1)
    x, w = rng.random(200), np.ones(200)
    y = (rng.random(200) < x).astype(float)
    at, value = isotonic(x, y, w)
    assert (np.diff(at) > 0).all() and (np.diff(value) > 0).all() and value.min() >= 0 and value.max() <= 1


def _corpus(spark):
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(300)]
    rows = []
    for i in range(900):
        text = rng.choices(words, k=rng.randint(20, 80))
        if i % 6 == 0:
            text[rng.randrange(len(text))] = rng.choice(["vile", "nasty", "grossling", "grosslich"])
        rows.append((i, " ".join(text), int(i % 6 == 0)))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int")


def test_held_out_accuracy_and_evidence(spark):
    docs = _corpus(spark)
    got = score(docs.withColumn("score", F.lit("clash")), docs.filter("doc_id % 5 <> 0").select("doc_id", "toxic")).join(docs.withColumnRenamed("doc_id", "id"), "id").collect()
    held = [r for r in got if r["id"] % 5 == 0]
    right = [(r["score"] >= 0.7) == bool(r["toxic"]) for r in held]
    assert sum(right) / len(right) >= 0.98
    assert all(0 <= r["score"] <= 1 and r["evidence"] for r in got)


def test_edges(spark, docs, no_docs):
    train = _corpus(spark)
    labels = train.select("doc_id", "toxic")
    assert {r["score"] for r in score(docs.limit(30), labels.limit(0)).collect()} == {0.5}
    assert score(no_docs, labels).collect() == []
    odd = spark.createDataFrame([(None, None), (5000, ""), (5001, "vile " * 50_000), (5002, "x"), (5002, "x"), (5003, "\x00 é 123")], "doc_id long, text string")
    rows = score(train.select("doc_id", "text").unionByName(odd), labels.unionByName(spark.createDataFrame([(None, 1), (3, None)], "doc_id long, toxic int"))).filter("id is null or id >= 5000").collect()
    told = {r["id"]: r["score"] for r in rows}
    assert len(rows) == 6 and told[5001] > 0.7 and all(told[i] < 0.5 for i in (None, 5000, 5002, 5003))
