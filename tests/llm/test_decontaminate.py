import re

from helpers import rows_of
from hearth.llm.decontaminate import decontaminate, windows

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(doc_rows, items):
    grams = {}
    for item, text in items:
        w = words(text)
        n = min(10, len(w))
        for s in range(len(w) - n + 1 if n else 0):
            grams.setdefault(tuple(w[s:s + n]), set()).add(item)
    sizes = {len(g) for g in grams}
    out = []
    for doc, text, *_ in doc_rows:
        w, hit, found = words(text), set(), set()
        for n in sizes:
            for s in range(len(w) - n + 1):
                if (g := tuple(w[s:s + n])) in grams:
                    hit.update(range(s, s + n))
                    found |= grams[g]
        out.append((doc, len(w), len(hit), tuple(sorted(found))))
    return sorted(out, key=str)


def test_equals_brute_force(spark, docs, doc_rows):
    planted = [w for _, t, *_ in doc_rows[5:40:7] for w in [" ".join(words(t)[3:40])]]
    items = [(r["item_id"], r["text"]) for r in rows_of("benchmark")]
    items += [(900 + i, t) for i, t in enumerate([*planted, planted[0], "Word", "twice", "other text", "a b", None, "", " ,. "])]
    got = decontaminate(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    got = sorted(((r["id"], r["n_words"], r["n_hit"], tuple(sorted(r["item_ids"]))) for r in got), key=str)
    assert got == brute(doc_rows, items)
    assert sum(r[2] > 0 for r in got) > 20


def test_empty_tables(spark, docs, no_docs):
    items = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    assert decontaminate(no_docs, items).collect() == []
    assert all(r["n_hit"] == 0 and r["spans"] == [] for r in decontaminate(docs.limit(20), items.limit(0)).collect())


def test_windows_of_short_and_long_items(spark):
    items = spark.createDataFrame([(1, "A b"), (2, " ".join(map(str, range(12)))), (3, "a, B!"), (None, "x y")], "item_id long, text string")
    got = {r["window"]: (r["n"], sorted(r["items"]), len(r["hashes"])) for r in windows(items, 10, 3, "item_id", "text").collect()}
    assert got["a b"] == (2, [1, 3], 1)
    assert len(got) == 4 and got["0 1 2 3 4 5 6 7 8 9"] == (10, [2], 8)
