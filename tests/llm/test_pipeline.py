"""The stages on a small corpus, each held against what its method says of its own input."""

import sys
from collections import Counter
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from helpers import clashing, no_docs, odd_docs  # noqa: E402
from test_line_dedup import brute as without_repeats  # noqa: E402
from test_shingle_join import brute as joined, words  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs.collect()]
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, SF), name)
        if name != "packing":
            assert docs.columns == columns
        out.append(docs.collect())
    return out


def test_stages_are_the_asked_ones():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id", "line_dedup", "ngram_jaccard_join", "source_mix", "packing"]


def test_language_stage_keeps_clean_documents(steps):
    before, after = {r.doc_id: r for r in steps[0]}, {r.doc_id: r for r in steps[1]}
    assert all(before[i] == r for i, r in after.items())
    lost = set(before) - set(after)
    assert len(lost) <= 2


def test_line_stage(steps):
    want = without_repeats([(r.doc_id, r.text) for r in steps[1]])
    assert {r.doc_id: r.text for r in steps[2]} == {i: t for i, t in want.items() if t != ""}
    assert all(r.n_chars == len(r.text) for r in steps[2])


def test_join_stage_keeps_one_of_each_group(steps):
    rows = [(r.doc_id, r.text) for r in steps[2]]
    assert sorted(r.doc_id for r in steps[3]) == sorted(i for i, _, root in joined(rows) if i == root)


def test_mix_stage_comes_to_the_targets(steps):
    from tidegauge.llm.mixing import water_filled

    sizes, taken = Counter(), Counter()
    for r in steps[3]:
        sizes[r.source] += len(words(r.text))
    for r in steps[4]:
        taken[r.source] += len(words(r.text))
    names = sorted(sizes)
    goals = water_filled([sizes[n] for n in names], [(1, 2, 3)[i % 3] for i in range(len(names))],
                         sum(sizes.values()), 3)
    for name, goal in zip(names, goals):
        assert abs(taken[name] - goal) <= 1
    most = Counter(r.doc_id for r in steps[4])
    assert max(most.values()) <= 4 and all(r.n_chars == len(r.text) for r in steps[4])


def test_packing_stage_holds_every_document_of_the_mix(steps):
    assert Counter(r.doc_id for r in steps[5] if r.start == 0) == Counter(r.doc_id for r in steps[4])


def test_run_gives_the_last_stage(spark, steps):
    key = lambda r: (r.doc_id, r.start, r.length, r.ids_crc32)
    assert sorted(map(key, corpus_pipeline.run(spark, SF).collect())) == sorted(map(key, steps[5]))


SYLLABLES = {
    "aa": "ba lo mi ne tu", "bb": "kra sch ung tz pfl", "cc": "é oui eau çon ître", "dd": "да не про ств ого",
    "ee": "のは です ます した から", "ff": "ქვე ლის აში ობა იდა", "gg": "gwy llan ddu fach mawr", "hh": "xhu qe shq ipë rin",
}


def made_text(draw, languages, words=120):
    return " ".join(
        "".join(draw.choice(SYLLABLES[languages[i * len(languages) // words]].split()) for _ in range(draw.randrange(1, 4)))
        for i in range(words))


@pytest.mark.parametrize("n", [2, 4, 8])
def test_language_stage_rejects_foreign_text_and_keeps_the_rest(spark, n):
    import random
    import string

    draw, known = random.Random(n), list(SYLLABLES)[:n]
    rows, clean, foreign = [], set(), set()

    def put(text, lang, where):
        rows.append((len(rows), text, lang, "s", len(text or "")))
        where.add(len(rows) - 1)

    for lang in known:
        for _ in range(25):
            put(made_text(draw, [lang]), lang, clean)
    for _ in range(12):  # text that switches, up to evenly over all languages
        put(made_text(draw, draw.sample(known, draw.randrange(2, n + 1))), None, clean)
        put(made_text(draw, known), None, clean)
        put(" ".join("".join(draw.choices(string.ascii_lowercase, k=draw.randrange(2, 10))) for _ in range(80)), None, foreign)
        put("Съешь же ещё этих мягких французских булок выпей чаю " * draw.randrange(1, 9) if n < 4 else
            "Η γρήγορη καφετιά αλεπού πηδά πάνω από το τεμπέλικο σκυλί " * draw.randrange(1, 9), None, foreign)
    for text in (None, "", " \n", "123 !!"):
        put(text, None, foreign)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r.doc_id for r in corpus_pipeline.identify_language(spark, docs, SF).collect()}
    assert clean - kept == set() and kept & foreign == set()


def test_language_stage_on_given_documents(spark):
    """All ordinary documents stay; random letters put among them go."""
    import random
    import string

    draw = random.Random(1)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(10_000_000 + i, " ".join("".join(draw.choices(string.ascii_lowercase, k=draw.randrange(2, 10)))
             for _ in range(60)), None, "x", 1) for i in range(40)]
    added = docs.select("doc_id", "text", "lang", "source", "n_chars").unionByName(
        spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"))
    kept = {r.doc_id for r in corpus_pipeline.identify_language(spark, added, SF).select("doc_id").collect()}
    lost = {r.doc_id: r.text for r in docs.collect() if r.doc_id not in kept}
    assert not any(i in kept for i, *_ in rows)
    assert len(lost) <= docs.count() * 0.01, [t[:80] for t in list(lost.values())[:20]]


def test_own_columns_of_any_name_stay(spark):
    docs = clashing(spark.read.parquet(f"{SF}/documents.parquet"), "language", "line_dedup", "doc", "kept_mark", "told")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.columns
        docs = corpus_pipeline.stored(stage(spark, docs, SF), name)
        assert docs.columns == before
        assert docs.where("language = 'extra' AND line_dedup = 'extra' AND doc = 'extra'").count() == docs.count() > 0


def test_dedup_with_a_column_of_its_name(spark):
    from tidegauge.llm.line_dedup import dedup_lines

    docs = clashing(odd_docs(spark), "line_dedup")
    found = dedup_lines(docs)
    assert found.columns == docs.columns and found.where("line_dedup.n_lines >= 0").count() == docs.count()


def test_odd_rows_and_no_rows(spark):
    for docs in (clashing(odd_docs(spark), "doc", "language", "kept_mark"), no_docs(spark)):
        rows = docs.count()
        for name, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.stored(stage(spark, docs, SF), name)
            if name in ("line_dedup", "ngram_jaccard_join"):
                texts = [r.text for r in docs.collect()]
                assert "" not in texts and len(texts) <= rows
        assert docs.count() == 0 if rows == 0 else docs.where("doc_tokens > 0").count() == docs.count()
