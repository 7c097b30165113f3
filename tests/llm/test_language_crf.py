import random
import zlib
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import LONG, clashing, no_docs, odd_docs
from tidegauge.llm import language_crf, queries


def test_forward_backward_against_all_labellings():
    rng = np.random.default_rng(2)
    n, length = 3, 4
    scores, moves, begins = rng.normal(size=(2, length, n)), rng.normal(size=(n, n)), rng.normal(size=n)
    there = np.array([[True] * 4, [True, True, False, False]])
    likely, pairs, logs = language_crf.forward_backward(scores, there, moves, begins)
    all_pairs = np.zeros((n, n))
    for c in range(2):
        size = int(there[c].sum())
        weights = {}
        for labels in product(range(n), repeat=size):
            total = begins[labels[0]] + sum(scores[c, t, y] for t, y in enumerate(labels))
            weights[labels] = np.exp(total + sum(moves[a, b] for a, b in zip(labels, labels[1:])))
        z = sum(weights.values())
        assert logs[c] == pytest.approx(np.log(z))
        for t in range(length):
            for y in range(n):
                want = sum(w for l, w in weights.items() if l[t] == y) / z if t < size else 0
                assert likely[c, t, y] == pytest.approx(want)
        for labels, w in weights.items():
            for a, b in zip(labels, labels[1:]):
                all_pairs[a, b] += w / z
    assert pairs == pytest.approx(all_pairs)


def slots_of(word):
    if len(word) <= language_crf.SHORT:
        slots, places = language_crf.features([word])
        return sorted(slots[slots > 0]), sorted(places[places >= 0])
    parts = list(language_crf.long_features(word))
    return sorted(np.concatenate([a for a, _ in parts])), sorted(np.concatenate([b for _, b in parts]))


def test_features_tell_words_apart_and_share_affixes():
    a, b, c = (slots_of(w)[0] for w in ("walking", "talking", "walking" + "x" * 40))
    assert len({*a} ^ {*b}) > 3 and len({*a} & {*b}) > 8
    assert len({*a} & {*c}) >= 8


def test_all_letters_of_long_words_count(monkeypatch):
    middle = lambda x: "begin" + "a" * 20 + x + "b" * 20 + "end"
    assert slots_of(middle("mno")) != slots_of(middle("pqr"))
    word = "".join(random.Random(3).choice("abcdéф漢") for _ in range(700))
    whole = slots_of(word)
    monkeypatch.setattr(language_crf, "_LETTERS_AT_ONCE", 64)
    assert slots_of(word) == whole


def test_long_words_have_the_n_grams_of_short_ones(monkeypatch):
    for word in ("walking", "ab", "a" * 24, "été"):
        short = slots_of(word)
        monkeypatch.setattr(language_crf, "SHORT", 0)
        if len(word) >= 4:  # the long form takes affixes for granted
            assert len({*slots_of(word)[0]} ^ {*short[0]}) == 2  # but for the word itself
        monkeypatch.undo()


@pytest.fixture(scope="module")
def field():
    rng = random.Random(1)
    halves = {"xx": ["ba", "lo", "mi", "ba"], "yy": ["kra", "sch", "ung", "tz"], "zz": ["é", "oui", "eau", "la"]}
    make = lambda lang: " ".join(
        "".join(rng.choice(halves[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(60))
    return language_crf.train([(lang, make(lang)) for lang in halves for _ in range(20)], rounds=25)


def test_switching_text_is_labelled_in_runs(field):
    text = "balo milo balomi lo " * 5 + "krasch ungtz schung kra " * 5 + "ouieau éla oui " * 6
    (language, score, runs, _), = language_crf.label(field, [text], spans=True)
    assert [(l, n) for l, n in runs] == [("xx", 20), ("yy", 20), ("zz", 18)]
    assert language in ("xx", "yy") and 0.3 < score < 0.4


def test_labels_of_odd_texts(field, monkeypatch):
    texts = [None, "", " \n", "123 !!! ½ _", "balomi", "balo " * 5000, "漢字", "BALO MILO"]
    found = language_crf.label(field, texts)
    assert [f[:2] for f in found[:4]] == [("und", 0.0)] * 4
    assert found[4][0] == found[5][0] == found[7][0] == "xx" and found[6][0] in field.languages
    assert all(0 <= s <= 1 for _, s, _, _ in found)
    monkeypatch.setattr(language_crf, "_CHARACTERS_AT_ONCE", 100)
    again = language_crf.label(field, texts)
    assert [f[0] for f in again] == [f[0] for f in found]
    assert again[5][1] == pytest.approx(found[5][1], abs=1e-6)


def test_blocks_are_one_unbroken_chain(field, monkeypatch):
    rng = random.Random(8)
    vocabulary = ["balo", "mi", "krasch", "ung", "oui", "éla", "xq", "baung", "7", "schla"]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(n)) for n in (1, 5, 90, 300, 1000)]
    monkeypatch.setattr(language_crf, "BLOCK", 10_000)
    whole = language_crf.label(field, texts, spans=True)
    for block, characters in ((7, 1 << 19), (64, 1 << 19), (5, 100)):
        monkeypatch.setattr(language_crf, "BLOCK", block)
        monkeypatch.setattr(language_crf, "_CHARACTERS_AT_ONCE", characters)
        for a, b in zip(whole, language_crf.label(field, texts, spans=True)):
            assert (a[0], a[2]) == (b[0], b[2])
            assert a[1] == pytest.approx(b[1], abs=1e-5) and a[3] == pytest.approx(b[3])


def test_sample_is_that_of_the_smallest_hashes(spark, monkeypatch):
    monkeypatch.setattr(language_crf, "DOCUMENTS_PER_LANGUAGE", 20)
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("word "), "id").alias("text"),
        F.when(F.col("id") % 100 == 0, "rare").when(F.col("id") < 2995, "en").otherwise("few").alias("lang"))
    want = {}
    rows = docs.select("lang", "text", F.shiftrightunsigned(
        language_crf.seeded(5, F.col("doc_id"), F.length("text")), 1).alias("place")).collect()
    for r in sorted(rows, key=lambda r: r.place):
        want.setdefault(r.lang, []).append(r.text)
    got = {}
    for lang, text in language_crf.sample(docs.unionByName(docs), F.lit(True)):
        got.setdefault(lang, []).append(text)
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v[:20]) for k, v in want.items()}


def test_whole_text_counts(field):
    (language, *_), = language_crf.label(field, ["balo " * 300 + "krasch " * 2000])
    assert language == "yy"


def test_query_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.QUERIES["op5_language_crf"](spark, sf).collect()
    assert {r.doc_id for r in rows} == set(truth) and len(rows) == len(truth)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert r.lang_pred in {"en", "de", "fr", "es", "und"} and 0 <= r.score <= 1
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) >= 0.98


def test_held_out_labels_are_never_learned_from(spark):
    docs = spark.range(40).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("word"), "id").alias("text"),
        F.when(language_crf.held_out(F.col("id")), "secret").otherwise("open").alias("lang"))
    assert {r.language.lang_pred for r in language_crf.identify(docs).collect()} == {"open"}


def test_odd_rows(spark):
    docs = clashing(odd_docs(spark), "place", "passage", "score", "n", "spans")
    rows = language_crf.identify(docs, spans=True).collect()
    assert len(rows) == docs.count() and rows[0].asDict().keys() == {*docs.columns, "language"}
    by_id = {r.doc_id: r.language for r in rows}
    for i in (1, 2, 3, 10):
        assert by_id[i][:2] == ("und", 0.0) and by_id[i].spans == []
    assert sum(s.words for s in by_id[11].spans) == len(language_crf._WORDS.findall(LONG))
    assert language_crf.identify(no_docs(spark)).collect() == []


def test_nothing_to_learn_from(spark):
    docs = odd_docs(spark).withColumn("lang", F.lit(None).cast("string"))
    assert {r.language.lang_pred for r in language_crf.identify(docs).collect()} == {"und"}


def test_predictions_do_not_look_at_other_columns(spark):
    docs = odd_docs(spark)
    trained = language_crf.train(language_crf.sample(docs, F.lit(True)), rounds=5)
    a = language_crf.identify(docs, field=trained)
    b = language_crf.identify(docs.withColumn("lang", F.lit("q")).withColumn("source", F.lit("q")), field=trained)
    key = lambda r: (str(r.text), r.language)
    assert sorted(map(key, a.collect()), key=repr) == sorted(map(key, b.collect()), key=repr)
