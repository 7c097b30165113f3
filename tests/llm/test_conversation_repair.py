"""Repair of conversations, held against the cheapest edits of a search over all paths."""

import hashlib
import heapq
import random
import sys
import zlib
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from helpers import clashing  # noqa: E402
from tidegauge.llm import conversation_repair as cr  # noqa: E402
from tidegauge.llm.queries import QUERIES  # noqa: E402

SCHEMA = "conv_id long, turn long, role string, text string"
BLANK = " \t\n\v\f\r"


def fault(row, before):
    role, text = row
    body = text.rstrip(BLANK)
    if not text.strip(BLANK):
        return "blank"
    if row in before:
        return "duplicate"
    return None if body[-1] in ".!?" else "truncated"


def best(rows, faults):
    """(cost, audit, repaired rows) by Dijkstra over (row, last role initial), least audit first."""
    queue, done = [(0, "", 0, "", ())], {}
    while queue:
        cost, audit, i, last, made = heapq.heappop(queue)
        if (i, last) in done:
            continue
        done[i, last] = True
        if i == len(rows) and last in ("", "a"):
            return cost, audit, made
        follow = {"": "su", "s": "u", "u": "a", "a": "u"}[last]
        names = {"u": "user", "a": "assistant"}
        for initial in follow:
            if initial in names:
                heapq.heappush(queue, (cost + 5, audit + "I", i, initial, made + ((names[initial], ""),)))
        if i < len(rows):
            (role, text), extra = rows[i], 5 * (faults[i] == "truncated")
            heapq.heappush(queue, (cost + 2, audit + "D", i + 1, last, made))
            if faults[i] not in ("blank", "duplicate"):
                if role[:1] and role[:1] in follow:
                    heapq.heappush(queue, (cost + extra, audit + "K", i + 1, role[:1], made + ((role, text),)))
                for initial in follow:
                    if initial in names:
                        heapq.heappush(queue, (
                            cost + 1 + extra, audit + "R", i + 1, initial, made + ((names[initial], text),)))


def expected(rows):
    """What the contract asks of rows (turn, role, text) in order."""
    pairs = [(r, t) for _, r, t in rows]
    faults = [fault(p, pairs[:i]) for i, p in enumerate(pairs)]
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [r[:1] for r, _ in pairs]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    cost, audit, made = best(pairs, faults)
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest()
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)


def after_damage(rows):
    """{conv_id: rows in order} of (conv_id, turn, role, text) rows after the damage."""
    out = {}
    for conv_id, turn, role, text in rows:
        own = out.setdefault(conv_id, [])
        role, text = (" " if x is None else x for x in (role, text))
        told = ":".join(" " if x is None else str(x) for x in (conv_id, turn))
        kind = zlib.crc32(told.encode()) % 20
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        if kind == 4:
            role = "user"
        own += [(turn, role, text)] * (2 if kind == 3 else 1)
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])
    return {c: sorted(own, key=key) for c, own in out.items()}


def summary(rows):
    return {r[0]: tuple(r[1:]) for r in rows}


def random_rows(draw, conv_id, n):
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", "User", "ai"]
    texts = ["Yes.", "no", "Why? ", "", " \t", "Ab\xa0", "x!\n", "é?", "done"]
    return [(conv_id, draw.choice([None, i, i, i, i + 1, 7]), draw.choice(roles),
             draw.choice(texts) if draw.random() < 0.3 else f"text {draw.randrange(50)}" + draw.choice(["", ".", "!"]))
            for i in range(n)]


@pytest.mark.parametrize("piece", [1, 3, 32])
def test_against_all_paths(spark, monkeypatch, piece):
    monkeypatch.setattr(cr, "PIECE", piece)
    draw = random.Random(piece)
    rows = [r for c in range(120) for r in random_rows(draw, c, draw.randrange(0, 14))]
    rows += [(1000, i, ("user", "assistant")[i % 2], f"turn {i}.") for i in range(90)]
    rows += [(1001, i, "user", f"turn {i}.") for i in range(70)]
    rows += [(1002, i, ("system", "user", "assistant")[i % 3], f"turn {i}") for i in range(75)]
    got = summary(cr.repair(spark.createDataFrame(rows, SCHEMA)).collect())
    own = {}
    for c, *row in rows:
        own.setdefault(c, []).append(tuple(row))
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])
    assert got == {c: expected(sorted(mine, key=key)) for c, mine in own.items()}


def test_query_against_all_paths(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()
    got = summary(QUERIES["op12_conversation_repair"](spark, "/root/testdata/sf0.1").collect())
    assert got == {c: expected(own) for c, own in after_damage(map(tuple, rows)).items()}
    assert len(got) == len({r.conv_id for r in rows})


def test_odd_rows(spark):
    rows = [
        (None, 1, "user", "Hi."), (None, 2, "assistant", "Yes."), (None, 2, "assistant", "Yes."),
        (1, None, "user", "Hi."), (1, None, None, "No."), (1, None, "user", None), (2, None, None, None),
        (3, 5, "assistant", "Late."), (3, 9, "user", "x" * 300_000), (4, 0, "système", "Oui!"),
        (4, 1, "user", "\x00."), (4, 2, "assistant", "🙂"), (5, 1, "", ""),
    ]
    frame = clashing(spark.createDataFrame(rows, SCHEMA), "gone", "copy", "fault", "nth", "audit")
    got = summary(cr.repair(frame).collect())
    own = {}
    for c, turn, role, text in rows:
        own.setdefault(c, []).append((turn, " " if role is None else role, " " if text is None else text))
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])
    assert got == {c: expected(sorted(mine, key=key)) for c, mine in own.items()}
    damaged = cr.damaged(frame)
    assert summary(cr.repair(damaged, damaged["gone"], damaged["copy"]).collect()) == {
        c: expected(mine) for c, mine in after_damage(rows).items()}
    empty = spark.createDataFrame([], SCHEMA)
    assert cr.repair(empty).collect() == [] and cr.repaired_turns(empty).collect() == []


def test_turns_are_those_of_the_digest(spark):
    draw = random.Random(9)
    rows = [r for c in range(40) for r in random_rows(draw, c, draw.randrange(0, 90))]
    frame = spark.createDataFrame(rows, SCHEMA)
    told = summary(cr.repair(frame).collect())
    made = {}
    for r in sorted(cr.repaired_turns(frame).collect(), key=lambda r: (r.conv_id, r.position)):
        made.setdefault(r.conv_id, []).append(r)
    for conv_id, summed in told.items():
        own = made.get(conv_id, [])
        assert [r.position for r in own] == list(range(len(own)))
        assert "".join(r.edit for r in own) == summed[6].replace("D", "")
        lines = "\n".join(f"{r.role}:{r.text}" for r in own)
        assert hashlib.sha256(lines.encode()).hexdigest() == summed[7]


def test_string_ids(spark):
    frame = spark.createDataFrame([("a", 1, "user", "Hi."), ("b", 1, "user", "Hi.")],
                                  "conv_id string, turn int, role string, text string")
    assert sorted(r.conv_id for r in cr.repair(frame).collect()) == ["a", "b"]


def test_one_shuffle_and_no_cross_join(spark):
    frame = spark.createDataFrame([(1, 1, "user", "Hi.")], SCHEMA)
    plan = cr.repair(frame)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
