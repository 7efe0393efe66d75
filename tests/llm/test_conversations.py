import hashlib
import random
import re
import zlib
from collections import defaultdict
from itertools import groupby

import pytest

from hearth.llm.conversations import repair, report
from hearth.llm.queries import damaged

SOLID = re.compile(r"[^\x20\x09-\x0D]")
SCHEMA = "conv_id long, turn long, role string, text string, conv string, known string, present boolean, seen int"


def faults(rows):
    out, seen = [], set()
    for role, text in rows:
        solid = SOLID.findall(text)
        out.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows):
    """All edit strings of every place and role sequence, tried one by one: least cost, then least string."""
    marks = faults(rows)
    best = {}

    def go(i, roles, cost, audit, out, inserts):
        # dearer by far than another way to the same place and role
        least = best.setdefault((i, roles[-1:]), cost)
        if cost > least + 6:
            return
        best[i, roles[-1:]] = min(least, cost)
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", roles):
            found.append((cost, audit, out))
        if inserts < 2:
            for r, name in (("u", "user"), ("a", "assistant")):
                if fits(roles + r):
                    go(i, roles + r, cost + 3, audit + "I", out + [f"{name}:"], inserts + 1)
        if i == len(rows):
            return
        role, text = rows[i]
        go(i + 1, roles, cost + 4, audit + "D", out, 0)
        if marks[i] in ("blank", "duplicate"):
            return
        more = 3 * (marks[i] == "truncated")
        if role[:1] and fits(roles + role[0]):
            go(i + 1, roles + role[0], cost + more, audit + "K", out + [f"{role}:{text}"], 0)
        for r, name in (("u", "user"), ("a", "assistant")):
            if fits(roles + r):
                go(i + 1, roles + r, cost + 3 + more, audit + "R", out + [f"{name}:{text}"], 0)

    def fits(roles):
        return re.fullmatch("s?(ua)*u?", roles) is not None

    found = []
    go(0, "", 0, "", [], 0)
    return min(found, key=lambda x: (x[0], x[1]))


def expected(rows, original):
    """Brute force over (conv, turn, role, text) rows; ``original`` ids without rows have zeros."""
    convs = defaultdict(list)
    for c, t, role, text in rows:
        convs[c].append((t, role if role is not None else " ", text if text is not None else " "))
    out = {}
    for c in original:
        own = sorted(convs[c], key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        turns = {t for t, *_ in own if t is not None}
        marks = faults([r[1:] for r in own])
        cost, audit, lines = cheapest([r[1:] for r in own])
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        out[c] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, marks.count("blank"), marks.count("duplicate"), marks.count("truncated"),
                  illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def made(n, seed):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(rng.randrange(0, 7)):
            turn = rng.choice([t, t, t, t + 1, None])
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "User"])
            text = rng.choice(["a.", "b!", "c", "d? \n", " \t", "", None, "é.", "e.f"])
            rows.append((c, turn, role, text))
            if rng.random() < 0.15:
                rows.append(rows[-1])
    rows += [(None, 0, "user", "x."), (None, 1, "assistant", "y."), (None, 1, "assistant", "y.")]
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash", False, 5) for r in rows], SCHEMA).repartition(3)


def told(found):
    return {r[0]: tuple(r)[1:] for r in found.collect()}


def test_cheapest_repairs(spark):
    rows = made(250, 1)
    assert told(report(frame(spark, rows))) == expected(rows, {r[0] for r in rows})


@pytest.mark.parametrize("batch", [1, 3])
def test_batches_and_scratch_files(spark, batch):
    """Conversations that cross Arrow batches, and buffers that spill at once, change nothing."""
    rows = made(60, 2)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        assert told(report(frame(spark, rows), memory=1)) == expected(rows, {r[0] for r in rows})
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_edits_give_the_report(spark):
    rows = made(80, 3)
    got = report(frame(spark, rows)).collect()
    edits = sorted(repair(frame(spark, rows)).collect(), key=lambda r: (r["conv"] is not None, r["conv"] or 0, r["place"]))
    per = {c: list(g) for c, g in groupby(edits, key=lambda r: r["conv"])}
    for r in got:
        own = per.get(r["conv"], [])
        assert "".join(e["edit"] for e in own) == r["audit"]
        lines = "\n".join(f"{e['role']}:{e['text']}" for e in own if e["edit"] != "D")
        assert hashlib.sha256(lines.encode()).hexdigest() == r["repaired_sha256"]
        assert re.fullmatch("(s?(ua)+)?", "".join(e["role"][0] for e in own if e["edit"] != "D"))


def test_giant_conversation(spark):
    """A third of all rows in one conversation, longer than a piece of the trace back."""
    n = 70_000
    rows = spark.range(3 * n).selectExpr("if(id < %d, -1L, id div 4) as conv_id" % n, "id as turn",
                                         "case when id %% 1000 = 7 then 'tool' when id %% 2 = 0 then 'user' else 'assistant' end as role".replace("%%", "%"), "concat(id, '.') as text")
    got = {r["conv"]: r for r in report(rows, memory=1 << 12).filter("conv = -1 or conv = 30000").collect()}
    assert got[-1]["cost"] == 3 * 70 and got[-1]["audit"] == "".join("R" if i % 1000 == 7 else "K" for i in range(n)) and got[-1]["gaps"] == 0
    assert got[30000]["audit"] == "KKKK" and got[30000]["cost"] == 0


def test_damage_and_query(spark, tmp_path):
    rows = [(c, t, r, x) for c, t, r, x in made(150, 4)]
    path = str(tmp_path / "conversations.parquet")
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(path)
    after = []
    for c, t, role, text in rows:
        role, text = role if role is not None else " ", text if text is not None else " "
        fault = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if fault:
            text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
            after += [(c, t, "user" if fault == 4 else role, text)] * (1 + (fault == 3))
    from hearth.llm.queries import op12_conversations
    got = op12_conversations(spark, str(tmp_path))
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert told(got) == expected(after, {r[0] for r in rows})
    assert damaged(spark.read.parquet(path)).filter("present").count() == len(after)


def test_empty(spark):
    empty = frame(spark, [])
    assert report(empty).collect() == [] and repair(empty).collect() == []
