from hypothesis import given, settings
from hypothesis import strategies as st

from helpers import clashing, no_docs, odd_docs, odd_rows
from tidegauge.llm import line_dedup


def brute(rows, width=3):
    """(doc_id, text) without later occurrences of repeated windows; ids are distinct."""
    seen, out = set(), {}
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        if text is None:
            out[doc_id] = None
            continue
        lines, gone = text.split("\n"), set()
        for at in range(max(1, len(lines) - width + 1)):
            window = tuple(lines[at:at + width])
            if not any(line.strip(" ") for line in window):
                continue
            if window in seen:
                gone.update(range(at, at + width))
            seen.add(window)
        out[doc_id] = "\n".join(line for i, line in enumerate(lines) if i not in gone)
    return out


def cleaned(spark, rows, **options):
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    return {r.doc_id: r.text for r in line_dedup.dedup_lines(frame, **options).collect()}


def test_passages(spark):
    rows = [
        (1, "intro\np1\np2\np3\np4\nend"), (2, "other\np1\np2\np3\np4\ntail"), (3, "p2\np3"), (4, "p2\np3"),
        (5, "p1\np2\nx"), (6, "a\nb\nc\na\nb\nc\nd"), (7, "z\nz\nz\nz\nz"), (8, "\n\n\n"), (9, "\n\n\n"),
        (10, "intro\np1\np2\np3\np4\nend"), (11, ""), (12, None), (13, "é\n漢\n\nq"), (14, "r\né\n漢\n\nq"),
    ]
    found = cleaned(spark, rows)
    assert found == brute(rows)
    assert found[2] == "other\ntail" and found[4] == "" and found[6] == "a\nb\nc\nd" and found[10] == ""
    assert found[9] == "\n\n\n" and found[3] == "p2\np3"


@given(st.lists(st.lists(st.sampled_from("abc "), max_size=9).map("\n".join), min_size=1, max_size=8))
@settings(max_examples=12, deadline=None)
def test_against_brute_force(spark, texts):
    rows = list(enumerate(texts))
    assert cleaned(spark, rows) == brute(rows)


def test_odd_rows_keep_their_columns(spark):
    docs = clashing(odd_docs(spark), "doc", "id", "mark", "at", "starts", "h1", "body")
    found = line_dedup.dedup_lines(docs)
    assert found.columns == [*docs.columns, "line_dedup"]
    rows = found.collect()
    assert len(rows) == len(odd_rows())
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, []).append(r.text)
    # Equal rows are cleaned alike; of documents 7 and 9, which are equal, the first keeps its text.
    assert by_id[None][0] == by_id[None][1] != ""
    assert by_id[8][0] == by_id[8][1] and by_id[9] == [""] and by_id[7][0] == odd_rows()[8][1]
    assert by_id[1] == [None] and by_id[2] == [""] and by_id[3] == [" \n\t "]
    assert line_dedup.dedup_lines(no_docs(spark)).collect() == []


def test_long_text(spark):
    text = "\n".join(f"line {i % 50_000}" for i in range(100_000))
    found = cleaned(spark, [(1, text), (2, "fresh\nline 7\nline 8\nline 9\nends")])
    assert found == brute([(1, text), (2, "fresh\nline 7\nline 8\nline 9\nends")])
