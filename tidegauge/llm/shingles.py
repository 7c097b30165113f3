"""Sets of word shingles as sorted arrays of 64-bit hashes.

All work is on whole buffers of text: words are found and hashed by prefix sums over their bytes,
shingles by mixing the hashes of neighbouring words.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import xxhash

WORDS = 5
#: Bytes hashed together; longer texts are taken in parts that overlap by a shingle.
BUFFER = 1 << 20

_GAPS = bytes([32, *range(9, 14)])
_GAP = re.compile(b"[" + _GAPS + b"]")
_BLANK = np.zeros(256, bool)
_BLANK[list(_GAPS)] = True
_LOWER = np.arange(256)
_LOWER[65:91] += 32
#: A random whole number for each byte, letters A to Z as a to z, and the base of the prefix sums.
_VALUES = np.random.default_rng(20).integers(0, 1 << 64, 256, np.uint64)[_LOWER]
_BASE = 0x9E3779B97F4A7C13
_INVERSE = pow(_BASE, -1, 1 << 64)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _powers(base: int, count: int) -> np.ndarray:
    powers = np.full(count, base, np.uint64)
    powers[0] = 1
    return np.cumprod(powers, dtype=np.uint64)


class _Tables:
    """Powers of the base, made once in each worker, as long as the longest buffer so far."""

    def __init__(self):
        self.up = self.down = np.empty(0, np.uint64)

    def fit(self, size: int) -> None:
        if len(self.up) < size:
            self.up, self.down = _powers(_BASE, size), _powers(_INVERSE, size)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _M1
    h = (h ^ (h >> np.uint64(27))) * _M2
    return h ^ (h >> np.uint64(31))


def _word_hashes(data: np.ndarray, tables: _Tables) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of a buffer begin, and their hashes."""
    tables.fit(len(data) + 1)
    blank = np.concatenate([[True], _BLANK[data], [True]])
    edges = np.flatnonzero(blank[1:] != blank[:-1])
    starts, ends = edges[::2], edges[1::2]
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUES[data] * tables.up[:len(data)], out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * tables.down[starts]
    return starts, _mixed(hashes ^ ((ends - starts).astype(np.uint64) * _M2))


def _combined(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` words."""
    count = max(0, len(words) - width + 1)
    h = words[:count]
    for k in range(1, width):
        h = _mixed(h + np.uint64(k)) * _M1 + words[k:k + count]
    return _mixed(h ^ np.uint64(width))


def _long(data: bytes, width: int, tables: _Tables) -> np.ndarray:
    """The set of a text longer than a buffer.

    Words longer than two buffers are hashed by themselves, so that no text needs more memory for
    its words than a few buffers.
    """
    parts, carried, at = [], np.empty(0, np.uint64), 0
    while at < len(data):
        gap = _GAP.search(data, min(at + BUFFER, len(data)))
        end = gap.start() if gap else len(data)
        if end - at > 2 * BUFFER:
            before = max(data.rfind(bytes([b]), at, at + BUFFER) for b in _GAPS)
            start = at + (before == at)
            if before > at:
                end = before
            elif end - start > 2 * BUFFER:
                word = xxhash.xxh3_64_intdigest(data[start:end].lower())
                carried = np.append(carried, np.uint64(word))
                at = end
                if len(carried) >= width:
                    parts.append(_combined(carried, width))
                    carried = carried[len(carried) - width + 1:]
                continue
        _, words = _word_hashes(np.frombuffer(data, np.uint8, end - at, at), tables)
        words = np.concatenate([carried, words])
        if len(words) >= width:
            parts.append(np.unique(_combined(words, width)))
            carried = words[len(words) - width + 1:]
        else:
            carried = words
        at = end
    if not parts:
        return _combined(carried, len(carried)) if len(carried) else carried
    return np.unique(np.concatenate(parts))


def shingle_sets(texts: Iterable[str | None], width: int = WORDS) -> Iterator[np.ndarray]:
    """The set of each text: hashes of its distinct runs of ``width`` words, sorted; of a text of
    fewer words, that of the whole; empty where there is no word."""
    tables = _Tables()
    waiting: list[bytes] = []
    held = 0

    def work() -> Iterator[np.ndarray]:
        lengths = np.array([len(d) + 1 for d in waiting])
        borders = np.cumsum(lengths)
        starts, words = _word_hashes(np.frombuffer(b"\n".join(waiting) + b"\n", np.uint8), tables)
        last = np.searchsorted(starts, borders)
        runs = _combined(words, width)
        first = 0
        for end in last:
            if end - first >= width:
                yield np.unique(runs[first:end - width + 1])
            elif end > first:
                yield _combined(words[first:end], end - first)
            else:
                yield np.empty(0, np.uint64)
            first = end

    for text in texts:
        data = (text or "").encode()
        if waiting and held + len(data) > BUFFER:
            yield from work()
            waiting, held = [], 0
        if len(data) > BUFFER:
            yield _long(data, width, tables)
        else:
            waiting.append(data)
            held += len(data) + 1
    if waiting:
        yield from work()
