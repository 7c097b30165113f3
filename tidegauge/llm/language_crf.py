"""Language identification by a linear-chain conditional random field over words.

A word's scores for the languages come from its affixes, its letter n-grams and itself as an entry of
a lexicon; learned transitions tie neighbours, so that text which switches between languages is
labelled in runs. Forward-backward gives each word's probabilities; a document's are their mean.

The field is trained on the driver from a bounded sample of labelled rows, whose passages are mixed
into chains that switch language; it then labels every word of every text. A text is one chain: its
blocks are worked side by side, and messages carry what each tells the others.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidegauge.llm.common import in_small_batches, seeded

#: The training sample: documents of each language (by a seeded hash), and characters of each, from
#: a place that the hash picks.
DOCUMENTS_PER_LANGUAGE = 300
CHARACTERS_PER_DOCUMENT = 1200
UNDETERMINED = "und"

#: Feature slots; a model has so many weights for each language.
SLOTS = 1 << 16
#: Words of a block. Blocks of a text are worked at once; messages pass from one to the next.
BLOCK = 256
#: Words up to so many letters are worked together, longer ones each by itself, in runs of letters.
SHORT = 24
_LETTERS_AT_ONCE = 1 << 16
_CHARACTERS_AT_ONCE = 1 << 19
#: Places of the table of runs of three letters that were learned from.
_SEEN = 1 << 20
_WORDS = re.compile(r"[^\W\d_]+")
_MIX = np.uint64(0x9E3779B97F4A7C15)
_RUN = (np.uint64(0x110000), np.uint64(0x110000) ** np.uint64(2))


def _mixed(kind: int, *parts: np.ndarray) -> np.ndarray:
    """Hashes of whole numbers, by multiplication and shift."""
    mixed = np.full(parts[0].shape, kind, np.uint64)
    for part in parts:
        mixed = (mixed ^ part.astype(np.uint64)) * _MIX
        mixed ^= mixed >> np.uint64(29)
    return mixed


def _slots(kind: int, *parts: np.ndarray) -> np.ndarray:
    """Feature slots from whole numbers."""
    return (_mixed(kind, *parts) % np.uint64(SLOTS - 1)).astype(np.int32) + 1


def _places(grams: np.ndarray) -> np.ndarray:
    """Places of runs of three letters in the table of those seen."""
    return (_mixed(50, grams) >> np.uint64(44)).astype(np.int32)


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Feature slots of distinct words of at most ``SHORT`` letters, a row each; slot 0 is none.

    The word itself, prefixes of one to three letters, suffixes of one to four, and n-grams of two
    and three letters with the word's borders. The second table has the places of the runs of three
    letters, -1 where there is none.
    """
    short = np.array([len(w) for w in words], int)
    width = SHORT
    letters = np.array(words, dtype=f"U{width}").view(np.uint32).reshape(len(words), width)
    letters = np.pad(letters, ((0, 0), (1, 1)))  # a zero at either border
    columns = []
    whole = np.full(len(words), 7, np.uint64)
    for k in range(width + 2):
        whole = (whole ^ letters[:, k]) * _MIX
        whole ^= whole >> np.uint64(31)
    columns.append(_slots(1, whole, short))
    rolled = np.zeros(len(words), np.uint64)
    for n in range(1, 4):
        rolled = rolled * np.uint64(0x110000) + letters[:, n]
        columns.append(np.where(short >= n, _slots(10 + n, rolled), 0))
    rolled = np.zeros(len(words), np.uint64)
    every = np.arange(len(words))
    for n in range(1, 5):
        rolled = rolled * np.uint64(0x1003F) + letters[every, np.maximum(short + 1 - n, 0)]
        columns.append(np.where(short >= n, _slots(20 + n, rolled), 0))
    found = [np.stack(columns, axis=1)]
    for n in (2, 3):
        grams = np.zeros((len(words), width + 3 - n), np.uint64)
        for k in range(n):
            grams = grams * np.uint64(0x110000) + letters[:, k:k + width + 3 - n]
        inside = np.arange(width + 3 - n)[None, :] < (short + 3 - n)[:, None]
        found.append(np.where(inside, _slots(30 + n, grams), 0))
    longest = int(short.max()) + 2 if len(words) else 1
    places = np.where(inside, _places(grams), -1)[:, :longest]
    return np.concatenate([found[0], found[1][:, :longest], found[2][:, :longest]], axis=1), places


def long_features(word: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The same of one longer word: slots and places, in runs of bounded length.

    N-grams slide over the whole word; a digest of all its letters stands for the word itself.
    """
    n = len(word)
    ends = np.array([ord(c) for c in word[:3] + word[-4:]], np.uint64)
    digest = int.from_bytes(hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big")
    slots = [_slots(2, np.array([digest], np.uint64), np.array([n]))]
    rolled = np.zeros(1, np.uint64)
    for k in range(1, 4):
        rolled = rolled * np.uint64(0x110000) + ends[k - 1]
        slots.append(_slots(10 + k, rolled))
    rolled = np.zeros(1, np.uint64)
    for k in range(1, 5):
        rolled = rolled * np.uint64(0x1003F) + ends[7 - k]
        slots.append(_slots(20 + k, rolled))
    yield np.concatenate(slots), np.empty(0, np.int32)
    for start in range(0, n, _LETTERS_AT_ONCE):
        # Padded letters 0 to n + 1: pairs begin at 0 to n, runs of three at 0 to n - 1.
        stop = min(start + _LETTERS_AT_ONCE, n)
        inner = word[max(start - 1, 0):min(stop + 1, n)].encode("utf-32-le", "surrogatepass")
        letters = np.frombuffer(inner, "<u4").astype(np.uint64)
        letters = np.pad(letters, (int(start == 0), int(stop == n)))
        triples = letters[:-2] * _RUN[1] + letters[1:-1] * _RUN[0] + letters[2:]
        pairs = letters[:-1] * _RUN[0] + letters[1:]
        if stop < n:
            pairs = pairs[:-1]  # the next run begins with it
        yield np.concatenate([_slots(32, pairs), _slots(33, triples)]), _places(triples)


@dataclass
class Field:
    """A trained field: ``weights`` by slot and language, ``moves`` between languages, ``begins``,
    which runs of three letters it has ``seen``, and how ``familiar`` passages are with one another."""

    languages: list[str]
    weights: np.ndarray
    moves: np.ndarray
    begins: np.ndarray
    seen: np.ndarray
    familiar: float = 0.0

    def plain(self) -> tuple:
        """The field as plain values, which travel without this class."""
        return self.languages, self.weights, self.moves, self.begins, self.seen, self.familiar

    def scores(self, slots: np.ndarray) -> np.ndarray:
        total = np.zeros((len(slots), len(self.languages)), np.float32)
        for column in slots.T:
            total += self.weights[column]
        return total

    def of_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Scores of distinct words, and of each how many runs of three letters it has and are seen."""
        scores = np.zeros((len(words), len(self.languages)), np.float32)
        runs = np.zeros((len(words), 2))
        short = np.flatnonzero([len(w) <= SHORT for w in words])
        for some in (short[i:i + 20000] for i in range(0, len(short), 20000)):
            slots, places = features([words[i] for i in some])
            scores[some] = self.scores(slots)
            runs[some, 0] = (places >= 0).sum(axis=1)
            runs[some, 1] = (self.seen[places] & (places >= 0)).sum(axis=1)
        for i in (i for i, w in enumerate(words) if len(w) > SHORT):
            for slots, places in long_features(words[i]):
                scores[i] += self.weights[slots].sum(axis=0)
                runs[i] += len(places), self.seen[places].sum()
        return scores, runs


def forward_backward(
    scores: np.ndarray, there: np.ndarray, moves: np.ndarray, begins: np.ndarray,
    entry: np.ndarray | None = None, leave: np.ndarray | None = None,
):
    """Word probabilities of chains of equal padded length.

    ``scores``: (chains, words, languages); ``there``: whether a word is one, padding last. Where the
    chains are blocks of longer ones, ``entry`` and ``leave`` are the messages from before and behind
    each. Returns the probabilities, those of moves summed over all words, and the log of each
    chain's total.
    """
    chains, length, n = scores.shape
    potential = np.exp(scores - scores.max(axis=2, keepdims=True))
    step = np.exp(moves)
    ahead, scale = np.empty_like(potential), np.ones((chains, length), potential.dtype)
    ahead[:, 0] = potential[:, 0] * (np.exp(begins) if entry is None else entry)
    for t in range(length):
        if t:
            ahead[:, t] = (ahead[:, t - 1] @ step) * potential[:, t]
        scale[:, t] = ahead[:, t].sum(axis=1)
        ahead[:, t] /= scale[:, t, None]
    last = np.ones((chains, n), potential.dtype) if leave is None else leave
    back = np.ones((chains, length, n), potential.dtype)
    back[:, -1] = last
    pairs = np.zeros((n, n))
    for t in range(length - 2, -1, -1):
        coming = potential[:, t + 1] * back[:, t + 1] / scale[:, t + 1, None]
        on = there[:, t + 1]
        back[:, t] = np.where(on[:, None], coming @ step.T, last)
        pairs += (ahead[:, t] * on[:, None]).T @ coming * step
    logs = (np.log(scale) + scores.max(axis=2)) * there
    likely = ahead * back
    if leave is not None:
        likely /= likely.sum(axis=2, keepdims=True)
    return likely * there[:, :, None], pairs, logs.sum(axis=1)


def transfers(scores: np.ndarray, there: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """What each block makes of a message that enters it: (blocks, languages, languages), scaled."""
    potential = np.exp(scores - scores.max(axis=2, keepdims=True))
    step = np.exp(moves)
    found = potential[:, 0, :, None] * np.eye(scores.shape[2])
    for t in range(1, scores.shape[1]):
        on = there[:, t]
        moved = (found @ step) * potential[:, t, None, :]
        if t % 8 == 0:
            moved /= moved.sum(axis=(1, 2), keepdims=True)
        found = np.where(on[:, None, None], moved, found)
    return found / found.sum(axis=(1, 2), keepdims=True)


def messages(blocks: np.ndarray, moves: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The messages that enter each block of one chain, and those that come from behind it."""
    step = np.exp(moves)
    entry, leave = np.empty(blocks.shape[:2]), np.empty(blocks.shape[:2])
    message = np.exp(begins)
    for i, block in enumerate(blocks):
        entry[i] = message / message.sum()
        message = entry[i] @ block @ step
    message = np.ones(blocks.shape[1])
    for i in range(len(blocks) - 1, -1, -1):
        leave[i] = message / message.sum()
        message = step @ (blocks[i] @ leave[i])
    return entry, leave


def train(passages: list[tuple[str, str]], rounds: int = 40, seed: int = 5) -> Field:
    """Fit a field to (language, text) passages by likelihood with a ridge, full batches, Adam.

    The passages are cut into runs of 4 to 40 words, which are shuffled and strung together, so
    that chains switch language and the field learns how often that is.
    """
    draw = np.random.default_rng(seed)
    languages = sorted({language for language, _ in passages})
    place = {x: i for i, x in enumerate(languages)}
    known: dict[str, int] = {}
    runs = []
    for language, text in passages:
        words = [known.setdefault(w, len(known)) for w in _WORDS.findall(text.lower())]
        at = 0
        while at < len(words):
            size = int(draw.integers(4, 41))
            runs.append((place[language], words[at:at + size]))
            at += size
    n = len(languages)
    field = Field(languages, np.zeros((SLOTS, n), np.float32), np.zeros((n, n)), np.zeros(n), np.zeros(_SEEN, bool))
    if not runs:
        return field
    order = draw.permutation(len(runs))
    labels = np.concatenate([np.full(len(runs[i][1]), runs[i][0]) for i in order])
    words = np.concatenate([runs[i][1] for i in order])
    length = 64
    chains = -(-len(words) // length)
    there = np.arange(chains * length).reshape(chains, length) < len(words)
    words = np.pad(words, (0, chains * length - len(words))).reshape(chains, length)
    labels = np.pad(labels, (0, chains * length - len(labels))).reshape(chains, length)
    names = list(known)
    short = np.array([i for i, w in enumerate(names) if len(w) <= SHORT], int)
    slots, places = features([names[i] for i in short])
    every_run = [(i, p[p >= 0]) for i, p in zip(short, places)]
    long = {}
    for i, name in enumerate(names):
        if len(name) > SHORT:
            parts = list(long_features(name))
            long[i] = np.concatenate([a for a, _ in parts])
            every_run.append((i, np.concatenate([b for _, b in parts])))
    field.familiar = _familiar(passages, known, dict(every_run))
    field.seen[np.concatenate([p for _, p in every_run])] = True
    told = np.zeros((chains, length, n))
    np.put_along_axis(told, labels[:, :, None], 1, axis=2)
    told *= there[:, :, None]
    told_moves = np.zeros((n, n))
    np.add.at(told_moves, (labels[:, :-1][there[:, 1:]], labels[:, 1:][there[:, 1:]]), 1)
    parameters = [field.weights, field.moves, field.begins]
    means = [np.zeros(p.shape) for p in parameters]
    squares = [np.zeros(p.shape) for p in parameters]
    for k in range(1, rounds + 1):
        by_name = np.zeros((len(names), n), np.float32)
        by_name[short] = field.scores(slots)
        for i, own in long.items():
            by_name[i] = field.weights[own].sum(axis=0)
        scores = by_name[words].astype(np.float64)
        likely, pairs, _ = forward_backward(scores, there, field.moves, field.begins)
        miss = likely - told
        by_word = np.stack(
            [np.bincount(words.ravel(), miss[:, :, j].ravel(), len(known)) for j in range(n)], axis=1
        )
        by_slot = np.zeros((SLOTS, n))
        for column in slots.T:
            for j in range(n):
                by_slot[:, j] += np.bincount(column, by_word[short, j], SLOTS)
        for i, own in long.items():
            np.add.at(by_slot, own, by_word[i])
        by_slot[0] = 0
        total = float(there.sum())
        slopes = [
            by_slot / total + 1e-6 * field.weights, (pairs - told_moves) / total + 1e-6 * field.moves,
            miss[:, 0].sum(axis=0) / total + 1e-6 * field.begins,
        ]
        for p, slope, mean, square in zip(parameters, slopes, means, squares):
            mean += 0.1 * (slope - mean)
            square += 0.01 * (slope ** 2 - square)
            p -= (0.1 * (mean / (1 - 0.9 ** k)) / (np.sqrt(square / (1 - 0.99 ** k)) + 1e-8)).astype(p.dtype)
    return field


def _familiar(passages: list[tuple[str, str]], known: dict[str, int], runs: dict[int, np.ndarray]) -> float:
    """The share of a passage's runs of three letters that other passages have too, on average."""
    own = [
        np.concatenate([runs[known[w]] for w in found]) for _, text in passages
        if (found := _WORDS.findall(text.lower()))
    ]
    holders = np.zeros(_SEEN, np.int32)
    for places in own:
        holders[np.unique(places)] += 1
    return float(np.mean([(holders[places] > 1).mean() for places in own]))


def _parts(text: str) -> Iterator[str]:
    """A text in parts of bounded length that end between words."""
    start = 0
    while len(text) - start > _CHARACTERS_AT_ONCE:
        cut = start + _CHARACTERS_AT_ONCE
        while cut < len(text) and text[cut].isalpha():
            cut += 1
        yield text[start:cut]
        start = cut
    yield text[start:]


class _Blocks:
    """The words of some texts, or of a part of one, in blocks, with the scores of the words."""

    def __init__(self, field: Field, texts: list[tuple[int, str]]):
        known: dict[str, int] = {}
        self.rows, owners = [], []
        for owner, part in texts:
            found = [known.setdefault(w, len(known)) for w in _WORDS.findall(part.lower())]
            for at in range(0, len(found), BLOCK):
                self.rows.append(found[at:at + BLOCK])
                owners.append(owner)
        self.owners, names = np.array(owners, int), list(known)
        self.real = np.array([w.isalpha() or any(map(str.isalpha, w)) for w in names], bool)
        self.scores, self.runs = field.of_words(names)
        self.scores[~self.real] = 0
        self.runs[~self.real] = 0

    def groups(self, some) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Numbers of blocks of like length, their words, and where there is one."""
        by_length = sorted(some, key=lambda i: len(self.rows[i]))
        for start in range(0, len(by_length), 1024):
            picked = np.array(by_length[start:start + 1024])
            sizes = np.array([len(self.rows[i]) for i in picked])
            there = np.arange(sizes.max())[None, :] < sizes[:, None]
            words = np.zeros(there.shape, int)
            words[there] = np.concatenate([self.rows[i] for i in picked])
            yield picked, words, there

    def transfers(self, field: Field, some) -> np.ndarray:
        """Transfers of the blocks ``some``, in their order."""
        n = len(field.languages)
        place = {i: k for k, i in enumerate(some)}
        found = np.empty((len(place), n, n))
        for picked, words, there in self.groups(some):
            found[[place[i] for i in picked]] = transfers(self.scores[words], there, field.moves)
        return found


class _Sums:
    """What the blocks say about each text."""

    def __init__(self, field: Field, texts: int, spans: bool):
        n = len(field.languages)
        self.field, self.spans = field, spans
        self.sums, self.counts = np.zeros((texts, max(n, 1))), np.zeros(texts, int)
        self.runs = np.zeros((texts, 2))
        self.labels: list[list] = [[] for _ in range(texts)]

    def add(self, blocks: _Blocks, entry: np.ndarray, leave: np.ndarray, first: int = 0) -> None:
        for picked, words, there in blocks.groups(range(len(blocks.rows))):
            likely, _, _ = forward_backward(
                blocks.scores[words], there, self.field.moves, self.field.begins,
                entry[picked].astype(np.float32), leave[picked].astype(np.float32),
            )
            counted = there & blocks.real[words]
            mine = blocks.owners[picked]
            np.add.at(self.sums, mine, (likely * counted[:, :, None]).sum(axis=1))
            np.add.at(self.counts, mine, counted.sum(axis=1))
            np.add.at(self.runs, mine, (blocks.runs[words] * there[:, :, None]).sum(axis=1))
            if self.spans:
                best = likely.argmax(axis=2)
                for i, row, on in zip(picked, best, there):
                    self.labels[blocks.owners[i]].append((first + i, row[on]))


def _label_together(field: Field, texts: list[tuple[int, str]], sums: _Sums) -> None:
    """Label whole texts that fit in memory together."""
    blocks = _Blocks(field, texts)
    if not blocks.rows:
        return
    n = len(field.languages)
    begins = np.exp(field.begins)
    entry, leave = np.tile(begins / begins.sum(), (len(blocks.rows), 1)), np.ones((len(blocks.rows), n))
    edges = np.flatnonzero(np.diff(blocks.owners)) + 1
    several = [range(a, b) for a, b in zip([0, *edges], [*edges, len(blocks.rows)]) if b - a > 1]
    found = blocks.transfers(field, [i for own in several for i in own])
    at = 0
    for own in several:
        entry[own], leave[own] = messages(found[at:at + len(own)], field.moves, field.begins)
        at += len(own)
    sums.add(blocks, entry, leave)


def _label_in_parts(field: Field, owner: int, text: str, sums: _Sums) -> None:
    """Label one very long text: read once for the messages between its blocks, once for the labels."""
    found = []
    for part in _parts(text):
        blocks = _Blocks(field, [(owner, part)])
        if blocks.rows:
            found.append(blocks.transfers(field, range(len(blocks.rows))))
    if not found:
        return
    entry, leave = messages(np.concatenate(found), field.moves, field.begins)
    at = 0
    for part in _parts(text):
        blocks = _Blocks(field, [(owner, part)])
        if blocks.rows:
            to = at + len(blocks.rows)
            sums.add(blocks, entry[at:to], leave[at:to], at)
            at = to


def label(field: Field, texts: list[str | None], spans: bool = False) -> list[tuple]:
    """For each text: language, score, runs of (language, words) where asked for, and the share of
    its runs of three letters that the field has seen.

    The score is the mean probability of the language over the text's words. All words of a text
    are one chain, however long it is.
    """
    sums = _Sums(field, len(texts), spans)
    if field.languages:
        waiting, held = [], 0
        for owner, text in enumerate(texts):
            text = text or ""
            if len(text) > _CHARACTERS_AT_ONCE:
                _label_in_parts(field, owner, text, sums)
                continue
            if held + len(text) > _CHARACTERS_AT_ONCE:
                _label_together(field, waiting, sums)
                waiting, held = [], 0
            waiting.append((owner, text))
            held += len(text)
        _label_together(field, waiting, sums)
    out = []
    for i in range(len(texts)):
        if not sums.counts[i]:
            out.append((UNDETERMINED, 0.0, [], 0.0))
            continue
        share = sums.sums[i] / sums.counts[i]
        best = int(share.argmax())
        told = []
        if spans:
            labels = np.concatenate([row for _, row in sorted(sums.labels[i], key=lambda x: x[0])])
            edges = np.flatnonzero(np.diff(labels)) + 1
            for a, b in zip([0, *edges], [*edges, len(labels)]):
                told.append((field.languages[labels[a]], int(b - a)))
        known = sums.runs[i, 1] / max(sums.runs[i, 0], 1)
        out.append((field.languages[best], float(min(1.0, max(0.0, share[best]))), told, float(known)))
    return out


def sample(docs: DataFrame, learns: Column, seed: int = 5) -> list[tuple[str, str]]:
    """The bounded training sample: (language, passage) of rows that have both and ``learns``.

    Of each language the rows with the smallest hashes. How many hashes have each length in bits, by
    a sketch and with a margin for its error, tells how small they must be, so that only a few times
    the rows wanted are ranked, however many there are. Equal passages of one hash count once.
    """
    place = F.shiftrightunsigned(seeded(seed, F.col("doc_id"), F.length("text")), 1)
    room = F.greatest(F.length("text") - CHARACTERS_PER_DOCUMENT, F.lit(0)) + 1
    able = docs.where(learns & F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        "lang", "text", place.alias("place"), F.length(F.bin(place)).alias("bits")
    )
    # A row per language and length in bits, then a row per language: the field has more of each.
    enough = Window.partitionBy("lang").orderBy("bits")
    most = (
        able.groupBy("lang", "bits").agg(F.approx_count_distinct("place").alias("n"))
        .withColumn("earlier", F.sum("n").over(enough) - F.col("n"))
        .where(F.col("earlier") < 2 * DOCUMENTS_PER_LANGUAGE)
        .groupBy("lang").agg(F.max("bits").alias("most_bits"))
    )
    first = Window.partitionBy("lang").orderBy("place", "passage")
    rows = (
        able.join(F.broadcast(most), "lang").where("bits <= most_bits")
        .select("lang", "place", F.substring(
            "text", F.pmod("place", room.cast("long")).cast("int") + 1, F.lit(CHARACTERS_PER_DOCUMENT)
        ).alias("passage"))
        .distinct()
        .withColumn("n", F.row_number().over(first))
        .where(F.col("n") <= DOCUMENTS_PER_LANGUAGE)
        .select("lang", "passage").collect()
    )
    return sorted((r.lang, r.passage) for r in rows)


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from: a quarter, by the crc of the id as text. No id: false."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(
    docs: DataFrame, spans: bool = False, field: Field | None = None, column: str = "language"
) -> DataFrame:
    """Add ``column``, a struct of ``lang_pred``, ``score``, ``spans``, ``known``, ``usual``, to every row.

    Without a ``field`` one is trained from the rows that are not held out and have ``text`` and
    ``lang``; predictions come from the text alone. ``spans`` are runs of (lang, words) in the
    order of the text, empty unless asked for. ``known`` is the share of the text's runs of three
    letters that the field was trained on, ``usual`` what that is for a passage of the sample.

    A null text, one without a letter, and any text where nothing could be learned is ``und`` with
    score 0. Rows with equal texts get equal predictions. Texts of any length are labelled whole, as
    one chain, and all letters of a word count, however long it is. A column of the name is replaced.
    An empty table gives an empty result.
    """
    model = field or train(sample(docs, ~held_out(F.col("doc_id"))))
    # Plain values: a broadcast is read by executors that may not have this package.
    shared = docs.sparkSession.sparkContext.broadcast(model.plain())
    usual = model.familiar
    kind = ("struct<lang_pred: string, score: double, spans: array<struct<lang: string, words: int>>, "
            "known: double, usual: double>")
    arrow_kind = pa.struct([
        ("lang_pred", pa.string()), ("score", pa.float64()),
        ("spans", pa.list_(pa.struct([("lang", pa.string()), ("words", pa.int32())]))),
        ("known", pa.float64()), ("usual", pa.float64()),
    ])

    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        trained = Field(*shared.value)
        for batch in batches:
            found = label(trained, batch.to_pylist(), spans)
            yield pa.array(
                [{"lang_pred": a, "score": s, "spans": [{"lang": x, "words": w} for x, w in r],
                  "known": k, "usual": usual} for a, s, r, k in found],
                type=arrow_kind,
            )

    predict.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    udf = F.arrow_udf(predict, kind)
    return in_small_batches(docs).withColumn(column, udf(F.col("text").cast("string")))
