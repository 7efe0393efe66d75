import re
from collections import Counter

from hearth.llm.pii import KINDS, personal_data, redact

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def stands(kind, m):
    d = re.sub("[^0-9]", "", m)
    return {"email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in m.split(".")),
            "card": 12 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]


def brute(text):
    found = [(m.start(), k, kind, m.end()) for k, kind in enumerate(KINDS, 1) for m in re.finditer(BASE[kind], text or "") if stands(kind, m.group())]
    return tuple(sorted(found))


def test_base_equals_brute_force(docs, doc_rows):
    small = [r for r in doc_rows if (r[0] or 0) != 10**6 + 8]  # the plain patterns retry for ever inside its runs
    got = personal_data(docs).collect()
    assert len(got) == len(doc_rows)
    got = [r for r in got if r["id"] != 10**6 + 8]
    assert sorted(((r["id"], tuple(map(tuple, r["base"]))) for r in got), key=str) == sorted(((d, brute(t)) for d, t, *_ in small), key=str)
    assert sum(len(r["base"]) for r in got) > 20
    assert all(set(map(tuple, r["base"])) <= set(map(tuple, r["spans"])) for r in got)


def test_adjacent_matches(spark):
    texts = ["a@b.co_x@y.zz@k.de", "1.2.3.4.5.6.7.8", "x@y@z.w", "+1 (2) 3+4 555 555 555", "4111-1111 1111 1111  4111111111111112", "é 😀 me@x.org +49 30 1234567"]
    rows = personal_data(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r["id"]: tuple(map(tuple, r["base"])) for r in rows} == {i: brute(t) for i, t in enumerate(texts)}


def _corpus(unseen):
    lines = [f"tel. +1 212 555 {i:04d} thanks" for i in range(40)] + [f"host addr 10.0.{i}.7 up" for i in range(40)]
    lines += [f"the +1 313 555 {i:04d}" for i in range(10)] + [f"the 10.1.{i}.7" for i in range(10)]
    return list(enumerate([*lines, *unseen]))


def test_patterns_discover_unseen_identifiers(spark):
    unseen = ["tel. (212) 555-9876 ok", "tel. 030 555 1234 ok", "the 555 987 6543", "host addr 12345678", "later 030 555 1234 again", "tel. 12345"]
    rows = {r["id"]: r for r in personal_data(spark.createDataFrame(_corpus(unseen), "doc_id long, text string")).collect()}
    new = {i - 100: [(s["kind"], s["start"], s["end"]) for s in rows[i]["spans"]] for i in range(100, 106)}
    # taken after a word that introduces phones, there and wherever it occurs again; not after "the"
    assert new == {0: [("phone", 5, 19)], 1: [("phone", 5, 17)], 2: [], 3: [], 4: [("phone", 6, 18)], 5: []}
    assert all(r["base"] == r["spans"] for i, r in rows.items() if i < 100)


def test_a_hot_copy_is_one_instance(spark):
    rows = [(i, "id +1 212 555 0001 and") for i in range(500)] + [(1000, "id 212 555 7777 and")]
    got = {r["id"]: r for r in personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1000]["spans"] == [] and len(got[3]["base"]) == 1


def test_redaction_and_edges(spark, no_docs):
    df = spark.createDataFrame([(1, "é me@x.org, 1.2.3.4!"), (2, None), (3, "")], "doc_id long, text string")
    found = personal_data(df)
    out = df.join(found, found["id"] == df["doc_id"]).select("doc_id", redact(df["text"], found["spans"]).alias("t")).collect()
    assert dict(map(tuple, out)) == {1: "é [EMAIL], [IP]!", 2: None, 3: ""}
    assert personal_data(no_docs).collect() == []


def test_repeated_rows_keep_their_count(docs, doc_rows):
    got = Counter(r["id"] for r in personal_data(docs).select("id").collect())
    assert got == Counter(d for d, *_ in doc_rows)


def test_repeated_rows_keep_their_places(spark):
    text = "mail me@x.org or you@y.org and 1.2.3.4 then 5.6.7.8 end"
    rows = [(1, text), (1, text), (1, text), (None, text), (None, text), (2, "no " + text)]
    got = [(r["id"], tuple(map(tuple, r["base"]))) for r in personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sorted(got, key=str) == sorted(((i, brute(t)) for i, t in rows), key=str)


def test_unseen_identifiers_may_outnumber_the_seeds(spark):
    lines = [f"tel. +1 212 555 {i:04d} thanks" for i in range(20)] + [f"host addr 10.0.{i}.7 up" for i in range(20)]
    unseen = [(f"tel. 030 555 {i:04d} ok", "phone", 5, 17) for i in range(100)] + [(f"host addr 10[.]1[.]{i}[.]9 up", "ip", 10, 23 + len(str(i))) for i in range(100)]
    unseen += [("host addr 2001:db8::7 up", "ip", 10, 21)]
    # as many known of one kind, but most of what follows cannot be of it
    lines += [f"ref +1 313 555 {i:04d}" for i in range(20)] + [f"ref {i:06d}123456789012345" for i in range(40)] + ["ref 030 777 1234"]
    rows = {r["id"]: r for r in personal_data(spark.createDataFrame(list(enumerate([*lines, *[u[0] for u in unseen]])), "doc_id long, text string")).collect()}
    assert [[tuple(s)[0::2] + (s["end"],) for s in rows[len(lines) + i]["spans"]] for i in range(len(unseen))] == [[(a, k, z)] for _, k, a, z in unseen]
    assert all(rows[i]["spans"] == rows[i]["base"] for i in range(len(lines)))


def test_chains_of_patterns_are_followed_to_their_end(spark):
    lines = [f"w0 +1 212 555 {i:04d} x" for i in range(8)]
    for k in range(8):
        lines += [f"{w} {k + 2}30 555 {i:04d} x" for i in range(8) for w in (f"w{k}", f"w{k + 1}")]
    rows = personal_data(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")).collect()
    assert all([s["kind"] for s in r["spans"]] == ["phone"] for r in rows)
