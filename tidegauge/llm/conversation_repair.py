"""Repair of conversations by the cheapest edits, found by iterative-deepening A*.

A conversation's rows are read in order, in pieces of bounded length. For each piece and each pair of
grammar states a depth-first search tries the edits in the order of their initials under a cost bound
that rises until a path is accepted; states that failed with as much left to spend are not tried
again. The first path is the cheapest and of those the least. Between pieces one survivor is kept
for each grammar state, so a conversation of any length takes bounded memory but for its own audit.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Rows of a piece that is searched at once.
PIECE = 32
#: Costs of the edits; a truncated row that stays costs so much more.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: Grammar states: nothing yet, after system, after user, after assistant. Accepted are the first and last.
START, SYSTEM, USER, ASSISTANT = range(4)
_NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
_ROLES = {USER: "user", ASSISTANT: "assistant"}
_INITIALS = {USER: "u", ASSISTANT: "a"}
_LEGAL = {"su", "ua", "au"}
BLANK = " \t\n\v\f\r"

SUMMARY = (
    ("gaps", "long"), ("blank", "long"), ("duplicate", "long"), ("truncated", "long"),
    ("illegal", "long"), ("cost", "long"), ("audit", "string"), ("repaired_sha256", "string"),
)
TURNS = (("position", "long"), ("turn", "long"), ("role", "string"), ("text", "string"), ("edit", "string"))
_ARROW = {"long": pa.int64(), "string": pa.string()}


def _kept(code: str, state: int) -> int | None:
    """The state after a row of this code is kept as it is, or none."""
    initial = code.lower()
    if initial == _INITIALS[_NEXT[state]]:
        return _NEXT[state]
    return SYSTEM if initial == "s" and state == START else None


def cheapest(codes: str, start: int, goal: int) -> tuple[int, str] | None:
    """Cost and edits that bring a piece from one grammar state to another; none if nothing does.

    A row's code is ``-`` where it must be deleted, else the initial of its role (``x`` for any
    other than s, u and a), upper case where it is truncated.
    """
    if goal == START and start != START or goal == SYSTEM and start not in (START, SYSTEM):
        return None
    if goal == SYSTEM and start == START and not re.search("[sS]", codes):
        return None
    # What the rows from each place on cost at least: what is wrong with each by itself, and one for
    # each of the disjoint pairs of sound neighbours that may not follow each other.
    n = len(codes)
    alone = [DELETE if c == "-" or c.isupper() else REROLE if c == "x" else 0 for c in codes]
    least = [0] * (n + 2)
    for i in range(n - 1, -1, -1):
        least[i] = alone[i] + least[i + 1]
        if i + 1 < n and not alone[i] and not alone[i + 1] and codes[i:i + 2] not in _LEGAL:
            least[i] = max(least[i], REROLE + least[i + 2])
    failed: dict[tuple[int, int], int] = {}

    def edits(i: int, state: int):
        following = _NEXT[state]
        if i < n:
            yield "D", DELETE, i + 1, state
        if goal != START and not (goal == SYSTEM):
            yield "I", INSERT, i, following
        if i < n and codes[i] != "-":
            stays = TRUNCATED if codes[i].isupper() else 0
            kept = _kept(codes[i], state)
            if kept is not None:
                yield "K", stays, i + 1, kept
            if kept != following:
                yield "R", stays + REROLE, i + 1, following

    def search(i: int, state: int, left: int) -> str | None:
        if i == n and state == goal:
            return ""
        if failed.get((i, state), -1) >= left:
            return None
        for initial, cost, j, then in edits(i, state):
            if cost + least[j] <= left:
                path = search(j, then, left - cost)
                if path is not None:
                    return initial + path
        failed[i, state] = left
        return None

    bound = least[0]
    while (path := search(0, start, bound)) is None:
        bound += 1
    return bound, path


def _applied(rows: list[tuple], edits: str, state: int) -> tuple[list[tuple], int]:
    """The (turn, role, text, edit) rows that edits make of rows, and the grammar state after them."""
    out, i = [], 0
    for edit in edits:
        if edit == "I":
            state = _NEXT[state]
            out.append((None, _ROLES[state], "", "I"))
            continue
        turn, role, text, code = rows[i]
        i += 1
        if edit == "R":
            state = _NEXT[state]
            out.append((turn, _ROLES[state], text, "R"))
        elif edit == "K":
            state = _kept(code, state)
            out.append((turn, role, text, "K"))
    return out, state


class Conversation:
    """A conversation as its rows come in."""

    def __init__(self, with_turns: bool, search: Callable = cheapest):
        self.with_turns, self.search = with_turns, search
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.first = self.last = None
        self.distinct, self.initial, self.written = 0, None, 0
        self.rows: list[tuple] = []
        #: What all survivors agree on, and of each state's survivor cost, other edits, digest, turns.
        self.settled: list[str] = []
        self.survivors = {START: (0, "", hashlib.sha256(), [], False)}

    def add(self, turn, role: str, text: str, fault: str | None) -> Iterator[tuple]:
        if fault:
            self.counts[fault] += 1
        if turn is not None:
            self.distinct += turn != self.last
            self.first, self.last = turn if self.first is None else self.first, turn
        initial = role[:1]
        self.counts["illegal"] += self.initial is not None and self.initial + initial not in _LEGAL
        self.initial = initial
        code = "-" if fault in ("blank", "duplicate") else initial if initial in ("s", "u", "a") else "x"
        self.rows.append((turn, role, text, code.upper() if fault == "truncated" else code))
        if len(self.rows) >= PIECE:
            yield from self.advance((START, SYSTEM, USER, ASSISTANT))

    def advance(self, goals: tuple[int, ...]) -> Iterator[tuple]:
        codes, found = "".join(r[3] for r in self.rows), {}
        for goal in goals:
            ways = []
            for state, (cost, tail, *_) in self.survivors.items():
                way = self.search(codes, state, goal)
                if way is not None:
                    ways.append((cost + way[0], tail + way[1], state, way[1]))
            if ways:
                cost, tail, state, edits = min(ways)
                _, _, digest, turns, begun = self.survivors[state]
                made, _ = _applied(self.rows, edits, state)
                digest = digest.copy()
                for _, role, text, _ in made:
                    digest.update((("\n" if begun else "") + f"{role}:{text}").encode("utf-8", "replace"))
                    begun = True
                found[goal] = cost, tail, digest, turns + made if self.with_turns else turns, begun
        self.rows = []
        agreed = commonprefix([tail for _, tail, *_ in found.values()])
        self.settled.append(agreed)
        out = len(agreed) - agreed.count("D")
        if self.with_turns:
            yield from next(iter(found.values()))[3][:out]
        self.survivors = {
            state: (cost, tail[len(agreed):], digest, turns[out:], begun)
            for state, (cost, tail, digest, turns, begun) in found.items()
        }

    def finish(self) -> Iterator[tuple]:
        """The turns not given yet; the summary is in ``summary`` afterwards."""
        yield from self.advance((START, ASSISTANT))
        cost, tail, digest, turns, _ = min(self.survivors.values(), key=lambda s: s[:2])
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.distinct
        self.summary = (
            gaps, *self.counts.values(), cost, "".join(self.settled) + tail, digest.hexdigest()
        )
        yield from turns


def _ordered(conversations: DataFrame, gone: Column | None, copy: Column | None) -> DataFrame:
    """Rows of a conversation together and in order, each with its first fault.

    One shuffle, by conversation: the window and the order after it keep that placing.
    """
    filled = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select(
        "conv_id", (F.lit(False) if gone is None else gone).alias("gone"), F.col("turn").cast("long"),
        filled("role").alias("role"), filled("text").alias("text"),
        (F.lit(0) if copy is None else copy).alias("copy"),
    ).repartition("conv_id")
    order = ["turn", "role", "text", "copy"]
    seen = Window.partitionBy("conv_id", "gone", "role", "text").orderBy("turn", "copy")
    # Compared as text, not by a pattern over it: of a long text only the end counts.
    body = F.rtrim(F.col("text"), F.lit(BLANK))
    fault = (
        F.when(body == "", "blank")
        .when(F.col("nth") > 1, "duplicate")
        .when(~F.substring(body, -1, 1).isin(".", "!", "?"), "truncated")
    )
    return (
        rows.withColumn("nth", F.row_number().over(seen)).withColumn("fault", fault)
        .sortWithinPartitions("conv_id", "gone", *order)
        .select("conv_id", "gone", "turn", "role", "text", "fault")
    )


def _read(rows: DataFrame, with_turns: bool) -> DataFrame:
    kind = rows.schema["conv_id"].dataType
    fields = TURNS if with_turns else SUMMARY
    schema = f"conv_id {kind.simpleString()}, " + ", ".join(f"{n} {t}" for n, t in fields)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        key_type = None
        # Pieces are alike: few kinds make up most. Made here, since a cache does not travel to executors.
        search = lru_cache(maxsize=1 << 16)(cheapest)

        def batch():
            columns = list(zip(*out)) if out else [[]] * (len(fields) + 1)
            types = [key_type, *(_ARROW[t] for _, t in fields)]
            arrays = [pa.array(c, t) for c, t in zip(columns, types)]
            return pa.RecordBatch.from_arrays(arrays, names=["conv_id", *(n for n, _ in fields)])

        def put(key, made: Iterator[tuple], conversation: Conversation) -> None:
            for row in made:
                if with_turns:
                    out.append((key, conversation.written, *row))
                    conversation.written += 1

        def close(key, conversation: Conversation) -> None:
            put(key, conversation.finish(), conversation)
            if not with_turns:
                out.append((key, *conversation.summary))

        current, key = None, None
        for rows in batches:
            key_type = rows.column(0).type
            for conv_id, gone, turn, role, text, fault in zip(*(c.to_pylist() for c in rows.columns)):
                if current is None or conv_id != key:
                    if current is not None:
                        close(key, current)
                    current, key = Conversation(with_turns, search), conv_id
                if not gone:
                    put(key, current.add(turn, role, text, fault), current)
                if len(out) >= 2000:
                    yield batch()
                    out.clear()
        if current is not None:
            close(key, current)
            yield batch()

    return rows.mapInArrow(work, schema)


def repair(conversations: DataFrame, gone: Column | None = None, copy: Column | None = None) -> DataFrame:
    """A row per conversation of ``conversations`` (conv_id, turn, role, text): faults, cost, edits.

    Returns conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit (the initials of the
    cheapest edits, Delete, Insert, Keep, Rerole) and repaired_sha256 (of the repaired
    ``role:text`` lines). Rows for which ``gone`` holds only say that the conversation exists;
    ``copy`` orders rows that are equal otherwise.

    Rows go by turn, null first; of one turn by role and text. A null role or text is one space, so
    such a row is blank or has a role that no grammar takes. Rows without conv_id are one
    conversation. Equal rows are duplicates. Texts and conversations may be of any length: a
    conversation streams through one task, which its one digest asks for, in pieces of ``PIECE``
    rows. Other columns are not looked at. No rows give no rows.
    """
    return _read(_ordered(conversations, gone, copy), False)


def repaired_turns(
    conversations: DataFrame, gone: Column | None = None, copy: Column | None = None
) -> DataFrame:
    """The repaired rows: conv_id, position from 0, turn (null if inserted), role, text, edit."""
    return _read(_ordered(conversations, gone, copy), True)


def damaged(conversations: DataFrame) -> DataFrame:
    """``conversations`` with reproducible damage, by a hash of conv_id and turn.

    Of twenty rows one is dropped (``gone``), one emptied, one loses its full stops, question and
    exclamation marks, one is repeated (``copy`` 1) and one gets the role user. Nulls are one space.
    """
    filled = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    mark = F.crc32(F.concat(filled("conv_id"), F.lit(":"), filled("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", "role", "text", mark.alias("mark"))
    return rows.select(
        "conv_id", "turn", (F.col("mark") == 0).alias("gone"),
        F.when(F.col("mark") == 4, "user").otherwise(filled("role")).alias("role"),
        F.when(F.col("mark") == 1, "").when(F.col("mark") == 2, F.translate(filled("text"), ".!?", ""))
        .otherwise(filled("text")).alias("text"),
        F.explode(F.when(F.col("mark") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )
