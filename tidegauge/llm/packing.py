"""Packing token pieces into sequences of bounded length.

Documents are cut at every full sequence; what is left of each goes, in randomised groups of
documents that are packed independently, to the first sequence with room for it, longest first. A
tournament tree over the room left in the sequences finds that one in logarithmic time.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import in_small_batches, seeded, stored

#: Rows packed together, about. A group is packed by one task.
DOCUMENTS_PER_GROUP = 2048
#: Characters tokenised at once; longer texts are split where no token can span the split.
CHARACTERS_AT_ONCE = 1 << 20

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
_WHERE = "file_part int, row_number long"
_PIECE_SCHEMA = pa.schema([
    (name, pa.int64()) for name in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")
])
_PLACED_SCHEMA = pa.schema([*_PIECE_SCHEMA, ("file_part", pa.int32()), ("row_number", pa.int64())])
_PACKED_SCHEMA = pa.schema([
    *_PIECE_SCHEMA, ("sequence_id", pa.int64()), ("offset", pa.int64())
])


class Encoder:
    """Ids of a byte-level BPE vocabulary, as the first library gives them when it has loaded it.

    Texts of Latin characters go through the faster of two libraries that hold the same vocabulary;
    all others through the one that defines the ids, since the two may class rare characters
    differently. So do texts that hold one of the vocabulary's added tokens, which the second library
    does not know; they are not split.
    """

    def __init__(self, tokenizer: str, ranks: str):
        import base64

        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.full = Tokenizer.from_file(tokenizer)
        self.added = [t.content for t in self.full.get_added_tokens_decoder().values()]
        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines)}
        self.latin = tiktoken.Encoding(
            "latin", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={}
        )

    def parts(self, text: str) -> Iterator[str]:
        """The text in parts that tokenise on their own as they do together."""
        start = 0
        while len(text) - start > CHARACTERS_AT_ONCE:
            cut = start + CHARACTERS_AT_ONCE
            # A blank between two characters that are not white space begins a token.
            while cut < len(text) - 1 and not (
                text[cut] == " " and not text[cut - 1].isspace() and not text[cut + 1].isspace()
            ):
                cut += 1
            if cut >= len(text) - 1:
                break
            yield text[start:cut]
            start = cut
        yield text[start:]

    def ids(self, text: str) -> Iterator[np.ndarray]:
        if any(token in text for token in self.added):
            yield np.array(self.full.encode(text, add_special_tokens=False).ids, dtype="<u4")
            return
        for part in self.parts(text):
            if part.isascii() or max(part) < "ɐ":
                yield np.asarray(self.latin.encode_to_numpy(part), dtype="<u4")
            else:
                yield np.array(
                    self.full.encode(part, add_special_tokens=False).ids, dtype="<u4"
                )


def cut(chunks: Iterator[np.ndarray], capacity: int) -> tuple[list[tuple[int, int, int]], int]:
    """(start, length, crc32) of the pieces of a stream of ids, and the number of ids."""
    pieces, at, rest = [], 0, np.empty(0, dtype="<u4")
    for chunk in chunks:
        rest = np.concatenate([rest, chunk])
        full = len(rest) // capacity * capacity
        for i in range(0, full, capacity):
            pieces.append((at + i, capacity, zlib.crc32(rest[i:i + capacity].tobytes())))
        at, rest = at + full, rest[full:]
    if len(rest):
        pieces.append((at, len(rest), zlib.crc32(rest.tobytes())))
    return pieces, at + len(rest)


def token_pieces(
    docs: DataFrame, tokenizer: str, ranks: str, capacity: int = 2048, end_id: int = 1
) -> DataFrame:
    """The pieces of every document: its ids and then ``end_id``, cut at multiples of ``capacity``.

    ``file_part`` and ``row_number`` tell documents apart that are equal in all else.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, number = Encoder(tokenizer, ranks), TaskContext.get().partitionId(), 0
        end = np.array([end_id], dtype="<u4")

        def chunks(text):
            yield from encoder.ids(text)
            yield end

        for batch in batches:
            found = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                own, total = cut(chunks(text.as_py() or ""), capacity)
                found.extend((doc_id, *piece, total, part, number) for piece in own)
                number += 1
            columns = zip(*found) if found else [[]] * len(_PLACED_SCHEMA)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, field.type) for c, field in zip(columns, _PLACED_SCHEMA)], schema=_PLACED_SCHEMA
            )

    texts = in_small_batches(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return texts.mapInArrow(pieces, f"{PIECES}, {_WHERE}")


class Tournament:
    """First of a row of bins with enough room, by a tree that holds the most room below each node."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1
        while self.leaves < bins:
            self.leaves *= 2
        self.room = [capacity] * (2 * self.leaves)

    def place(self, length: int) -> tuple[int, int]:
        """Put an item into the first bin that holds it; the bin and the room it had."""
        room, node = self.room, 1
        while node < self.leaves:
            node *= 2
            if room[node] < length:
                node += 1
        before, chosen = room[node], node - self.leaves
        room[node] -= length
        node //= 2
        while node:
            left, right = room[2 * node], room[2 * node + 1]
            most = left if left > right else right
            if room[node] == most:
                break
            room[node] = most
            node //= 2
        return chosen, before


def first_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item, for items in the order they are to be placed."""
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    full = int((lengths == capacity).sum())  # these come first and fill a bin each
    bins[:full], offsets[:full] = np.arange(full), 0
    tree = Tournament(max(1, len(lengths) - full), capacity)
    for i, length in enumerate(lengths[full:].tolist(), full):
        chosen, before = tree.place(length)
        bins[i], offsets[i] = full + chosen, capacity - before
    return bins, offsets


def pack(
    docs: DataFrame,
    tokenizer: str,
    ranks: str,
    capacity: int = 2048,
    end_id: int = 1,
    seed: int = 2,
) -> DataFrame:
    """Pack documents (``doc_id``, ``text``) into sequences of at most ``capacity`` ids.

    One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset. A sequence
    is padded to ``capacity`` at its end.

    A null text is empty, and an empty text is its end id alone. A text of any length is cut into
    full sequences and a rest. Rows with the same id, or none, are documents of their own, and equal
    rows are spread over the groups like others; pieces of equal length are placed in the order of id
    and start. Other columns are not looked at. An empty table gives no rows.
    """
    groups = max(1, -(-docs.count() // DOCUMENTS_PER_GROUP))
    # Written first: which group a piece goes to must not change where a task is run again.
    pieces = stored(token_pieces(docs, tokenizer, ranks, capacity, end_id), "pieces").withColumn(
        "pack_group", F.pmod(seeded(seed, *[
            F.col(c) for c in ("doc_id", "start", "ids_crc32", "file_part", "row_number")
        ]), F.lit(groups)),
    )

    def packed(group: pa.Table) -> pa.Table:
        group = group.sort_by(
            [("length", "descending"), ("doc_id", "ascending"), ("start", "ascending")]
        )
        bins, offsets = first_fit(group["length"].to_numpy(), capacity)
        number = group["pack_group"][0].as_py()
        return pa.table(
            [*(group[n] for n in _PIECE_SCHEMA.names), pa.array((number << 32) + bins), pa.array(offsets)],
            schema=_PACKED_SCHEMA,
        )

    return pieces.groupBy("pack_group").applyInArrow(
        packed, f"{PIECES}, sequence_id long, offset long"
    )


def public_vocabulary(name: str = "byte_bpe_50k") -> tuple[str, str]:
    """Paths of a vocabulary in both libraries' formats."""
    import public_tokenizers

    return public_tokenizers.path(f"{name}.json"), public_tokenizers.path(f"{name}.tiktoken")
