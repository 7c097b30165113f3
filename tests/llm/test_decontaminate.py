"""Decontamination, held against a scan of every window in plain Python."""

import random
import re
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from helpers import DOCS, clashing, no_docs, odd_docs, odd_rows  # noqa: E402
from tidegauge.llm import decontaminate as dc  # noqa: E402

TESTS = "item_id long, text string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def windows(text):
    found = WORD.findall(lowered(text))
    return {tuple(found[i:i + 10]) for i in range(max(len(found) - 10, 0) + 1)} if found else set()


def brute(text, tests):
    """(words, hit places, item names) of a text."""
    found, hit, items = WORD.findall(lowered(text)), set(), set()
    for item, own in tests:
        for window in windows(own):
            for i in range(len(found) - len(window) + 1):
                if tuple(found[i:i + len(window)]) == window:
                    hit |= set(range(i, i + len(window)))
                    items.add("" if item is None else str(item))
    return len(found), hit, sorted(items)


def cut(text, hit):
    """The text without the hit words and what stands before each."""
    out, at = [], 0
    for i, m in enumerate(WORD.finditer(lowered(text))):
        if i not in hit:
            out.append(text[at:m.end()])
        at = m.end()
    return "".join(out) + text[at:]


def text_of(draw, n):
    return draw.choice([" ", ", ", "\n", "-"]).join(
        draw.choice(["Alpha", "beta", "gAmma", "été", "x1", "漢字", "İ"]) for _ in range(n))


@pytest.fixture(scope="module")
def tests():
    draw = random.Random(4)
    rows = [(i, text_of(draw, draw.choice([10, 11, 14, 25]))) for i in range(12)]
    rows += [(2, rows[5][1]), (20, rows[3][1].upper()), (None, rows[7][1]), (30, "..."), (31, None),
             (32, ""), (33, "Delta epsilon"), (33, "Delta epsilon"), (34, "zeta"), (100, text_of(draw, 12))]
    return rows


@pytest.fixture(scope="module")
def texts(tests):
    draw = random.Random(5)
    whole = [t for _, t in tests if t]
    made = []
    for i in range(60):
        parts = [text_of(draw, draw.randrange(0, 12)) for _ in range(3)]
        if i % 2:
            parts.insert(1, draw.choice(whole))
        if i % 5 == 0:
            parts.insert(2, " ".join(draw.choice(whole).split()[2:13]))
        if i % 7 == 0:
            parts.append("said delta, EPSILON; zeta!")
        made.append((100 + i, " ; ".join(parts), "en", "a", 1))
    return made + odd_rows()


@pytest.mark.parametrize("broadcast_bytes", [dc.BROADCAST_BYTES, 700])
def test_scan_against_every_window(spark, tests, texts, broadcast_bytes):
    found = dc.scan(spark.createDataFrame(texts, DOCS), spark.createDataFrame(tests, TESTS),
                    broadcast_bytes=broadcast_bytes)
    got = sorted(((r.doc_id, r.n_words, r.n_hit, r["items"], {p for s in r.spans for p in range(s.begin, s.end)})
                  for r in found.collect()), key=str)
    want = []
    for doc_id, text, *_ in texts:
        n, hit, items = brute(text, tests)
        want.append((doc_id, n, len(hit), items, hit))
    assert got == sorted(want, key=str)
    assert sum(w[2] > 0 for w in want) > 20 and sum(w[2] == 0 for w in want) > 20


def test_spans_are_merged_and_apart(spark, tests, texts):
    for r in dc.scan(spark.createDataFrame(texts, DOCS), spark.createDataFrame(tests, TESTS)).collect():
        assert all(a.end < b.begin for a, b in zip(r.spans, r.spans[1:]))
        assert all(s.begin < s.end for s in r.spans)


def test_cleaned_texts(spark, tests, texts):
    frame = clashing(spark.createDataFrame(texts, DOCS), "doc", "mark", "items", "told", "decontamination")
    cases = spark.createDataFrame(tests, TESTS)
    cleaned = dc.decontaminate(frame, cases)
    assert cleaned.columns == [*DOCS.replace(" long", "").replace(" string", "").split(", "),
                               "doc", "mark", "items", "told", "decontamination"]
    got = sorted(((r.doc_id, r.text, r.lang, r.doc) for r in cleaned.collect()), key=str)
    want = []
    for doc_id, text, lang, *_ in texts:
        _, hit, _ = brute(text, tests)
        want.append((doc_id, cut(text, hit) if hit else text, lang, "extra"))
    assert got == sorted(want, key=str)
    kept = dc.decontaminate(frame, cases, whole=True)
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(
        str(d) for d, text, *_ in texts if not brute(text, tests)[1])


def test_empty_tables(spark, tests):
    none = spark.createDataFrame([], TESTS)
    cases = spark.createDataFrame(tests, TESTS)
    assert dc.scan(no_docs(spark), cases).collect() == []
    assert dc.decontaminate(no_docs(spark), cases).collect() == []
    for r in dc.scan(odd_docs(spark), none).collect():
        assert r.n_hit == 0 and r.spans == [] and r["items"] == []
    assert dc.decontaminate(odd_docs(spark), none).count() == len(odd_rows())


def test_native_and_broadcast(spark, tests):
    plan = dc.scan(odd_docs(spark), spark.createDataFrame(tests, TESTS))._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan and "Python" not in plan and "Arrow" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
