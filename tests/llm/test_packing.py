import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from helpers import clashing, no_docs, odd_docs, odd_rows
from tidegauge.llm import packing
from tidegauge.llm.common import table


@pytest.fixture(scope="module")
def reference():
    tokenizer = Tokenizer.from_file(packing.public_vocabulary()[0])
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def check(rows, texts, reference, capacity):
    """Every id of every document lies in exactly one piece, and sequences have no gaps."""
    wanted = sorted((i is None, i or 0, reference(t)) for i, t in texts)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for doc_id in by_doc:
        mine = [ids for n, i, ids in wanted if (None if n else i) == doc_id]
        pieces = sorted((r.start, r.length, r.ids_crc32, r.doc_tokens) for r in by_doc[doc_id])
        expected = sorted(
            (s, len(ids[s:s + capacity]), zlib.crc32(np.array(ids[s:s + capacity], "<u4").tobytes()), len(ids))
            for ids in mine for s in range(0, len(ids), capacity)
        )
        assert pieces == expected
    assert sum(len(ids) for *_, ids in wanted) == sum(r.length for r in rows)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return by_sequence


def test_odd_rows(spark, reference):
    rows = packing.pack(odd_docs(spark), *packing.public_vocabulary(), capacity=256).collect()
    check(rows, [(r[0], r[1]) for r in odd_rows()], reference, 256)


def test_whole_table_with_little_padding(spark, reference):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    rows = packing.pack(docs, *packing.public_vocabulary()).collect()
    sequences = check(rows, [(r.doc_id, r.text) for r in docs.collect()], reference, 2048)
    total = sum(r.length for r in rows)
    assert len(sequences) * 2048 < total * 1.05 + 2048


def test_extra_columns_and_no_rows(spark):
    docs = clashing(odd_docs(spark), "start", "pack_group", "sequence_id")
    assert packing.pack(docs, *packing.public_vocabulary()).columns[0] == "doc_id"
    assert packing.pack(docs, *packing.public_vocabulary()).count() > 0
    assert packing.pack(no_docs(spark), *packing.public_vocabulary()).collect() == []


def test_long_texts_are_split_where_no_token_spans(reference, monkeypatch):
    monkeypatch.setattr(packing, "CHARACTERS_AT_ONCE", 50)
    encoder = packing.Encoder(*packing.public_vocabulary())
    text = "It's  a test,  of \n\n splits ' s 12 3 x" * 40 + "y" * 300 + " end  "
    assert [*np.concatenate(list(encoder.ids(text))), 1] == reference(text)


@pytest.mark.parametrize("text", [
    "x <|endoftext|> y", "<|endoftext|>", "a<|endoftext|><|endoftext|>\nb", "<|endoftext", "é <|endoftext|> 漢",
    "word " * 200 + "<|endoftext|>" + " word" * 200,
])
def test_added_tokens_are_those_of_the_vocabulary(reference, monkeypatch, text):
    monkeypatch.setattr(packing, "CHARACTERS_AT_ONCE", 50)
    assert [*np.concatenate(list(_encoder().ids(text))), 1] == reference(text)
    assert (50256 in reference(text)) == ("<|endoftext|>" in text)


def test_equal_rows_are_spread_over_groups(spark):
    docs = spark.range(0, 9000, 1, 4).selectExpr("CAST(NULL AS bigint) AS doc_id", "'a b c' AS text")
    rows = packing.pack(docs, *packing.public_vocabulary())
    sizes = [r.n for r in rows.groupBy(F.shiftright("sequence_id", 32)).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 5 and max(sizes) < 2200 and sum(sizes) == 9000


@given(st.text(max_size=80))
@settings(max_examples=200, deadline=None)
def test_both_libraries_give_the_same_ids(reference, text):
    text = text.encode("utf-8", "ignore").decode()
    encoder = _encoder()
    assert [int(i) for part in encoder.ids(text) for i in part] == reference(text)[:-1]


def _encoder(made=[]):
    if not made:
        made.append(packing.Encoder(*packing.public_vocabulary()))
    return made[0]


@given(st.lists(st.integers(1, 64), max_size=80))
@settings(max_examples=200, deadline=None)
def test_tree_finds_the_first_bin_with_room(lengths):
    lengths = np.array(sorted(lengths, reverse=True), dtype=np.int64)
    bins, offsets = packing.first_fit(lengths, 64)
    room = []
    for length, chosen, offset in zip(lengths, bins, offsets):
        first = next((i for i, left in enumerate(room) if left >= length), len(room))
        if first == len(room):
            room.append(64)
        assert (chosen, offset) == (first, 64 - room[first])
        room[first] -= length


def test_pieces_of_one_group_are_packed_together(spark):
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("a b c").alias("text"))
    rows = packing.pack(docs, *packing.public_vocabulary())
    assert rows.select(F.shiftright("sequence_id", 32)).distinct().count() == 3
