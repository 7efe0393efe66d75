import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from hearth.llm.merkle import fold, leaf_of, manifest, siblings

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, **changed):
    values = [changed.get(f, row[f]) for f in FIELDS]
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def tree(nodes, arity):
    """Root, and the siblings (left, right) of every node from the bottom up."""
    paths = [[] for _ in nodes]
    under = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        up, over = [], []
        for a in range(0, len(nodes), arity):
            run = nodes[a:a + arity]
            for j, below in enumerate(under[a:a + arity]):
                for i in below:
                    paths[i].append(("".join(run[:j]), "".join(run[j + 1:])))
            up.append(sha(*run))
            over.append(sum(under[a:a + arity], []))
        nodes, under = up, over
    return nodes[0], paths


def expected(rows, arity=2):
    groups = defaultdict(list)
    for r in rows:
        groups[r["lang"]].append(r)
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    subs, per = [], []
    for g in langs:
        own = sorted(groups[g], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        top, paths = tree([leaf(r) for r in own], arity)
        subs.append(top)
        per.append((own, paths))
    root, above = tree(subs, arity)
    return sorted(((r["doc_id"], leaf(r), sub, root, p + up) for sub, up, (own, paths) in zip(subs, above, per) for r, p in zip(own, paths)), key=str)


def refold(h, path):
    for left, right in path:
        h = sha(left, h, right)
    return h


@pytest.mark.parametrize("arity,levels", [(2, 8), (2, 3), (3, 2)])
def test_proofs_match_a_plain_tree(docs, arity, levels):
    rows = docs.collect()
    got = manifest(docs, FIELDS, arity=arity, levels=levels).collect()
    told = sorted(((r["id"], r["leaf"], r["subroot"], r["root"], [tuple(p) for p in r["path"]]) for r in got), key=str)
    assert told == expected(rows, arity)
    assert all(refold(r["leaf"], r["path"]) == r["root"] for r in got)


def test_claims_fold_to_other_roots(docs):
    claim = F.when(F.col("doc_id") % 3 == 0, leaf_of([F.col(f) + F.lit(1) if f == "n_chars" else F.col(f) for f in FIELDS]))
    found = manifest(docs, FIELDS, claim=claim)
    got = found.select("*", fold(F.coalesce("claim", "leaf"), F.col("path")).alias("folded"), siblings(F.col("path")).alias("beside")).collect()
    for r in got:
        changed = r["id"] is not None and r["id"] % 3 == 0
        assert (r["claim"] is not None) == changed
        assert r["folded"] == refold(r["claim"] or r["leaf"], r["path"]) and (r["folded"] == r["root"]) == (not changed)
        assert r["beside"] == "".join(a + b for a, b in r["path"])


def test_small_trees_and_none(docs, no_docs):
    assert manifest(no_docs, FIELDS).collect() == []
    one = manifest(docs.filter("doc_id = 1000003"), FIELDS).collect()
    assert len(one) == 1 and one[0]["leaf"] == one[0]["subroot"] == one[0]["root"] and one[0]["path"] == []


def test_repeated_rows_and_many_groups(spark):
    same = spark.range(700).selectExpr("if(id < 500, 7L, id) as doc_id", "'s' as source", "if(id % 2 = 0, 'x', concat('g', id)) as lang", "3L as n_chars", "'t' as text")
    got = manifest(same, FIELDS, levels=2).collect()
    told = sorted(((r["id"], r["leaf"], r["subroot"], r["root"], [tuple(p) for p in r["path"]]) for r in got), key=str)
    assert told == expected(same.collect())


def test_query(spark):
    from hearth.llm.queries import op13_merkle
    got = op13_merkle(spark, "/root/testdata/sf0.001").collect()
    assert got
    for r in got:
        assert r["verified"] == (zlib.crc32(str(r["doc_id"]).encode()) % 7 != 0) == (r["folded_root"] == r["root"])
