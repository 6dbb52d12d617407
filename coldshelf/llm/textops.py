"""Whole texts as flat arrays: words, word hashes and ragged gathers, without a loop per word.

A batch of texts is one byte array and the bounds of the texts in it. Long batches are
cut between texts, and hashing works through a batch in blocks, so that memory follows
the block, not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MASK = (1 << 64) - 1
CHUNK = 1 << 21
_BLOCK = 1 << 18
_BASE = 0x9E3779B97F4A7C55 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)

#: The word classes of the contracts, as bytes that do not belong to a word.
SPACES = bytes([0x20, *range(0x09, 0x0E)])

_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(length: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse, for positions below ``length``."""
    size = max(_BLOCK, 1 << (max(1, length) - 1).bit_length())
    if size not in _POWERS:
        tables = []
        for base in (_BASE, _INVERSE):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            tables.append(np.cumprod(table))
        if size > _BLOCK:
            return tables[0], tables[1]
        _POWERS[size] = (tables[0], tables[1])
    return _POWERS[size]


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose every output bit depends on every input bit."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def _byte_table(separators: bytes, fold: bool) -> tuple[np.ndarray, np.ndarray]:
    word = np.ones(256, bool)
    word[list(separators)] = False
    value = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
    if fold:
        value[65:91] = value[97:123]
    value[~word] = 0
    return word, value


_TABLES = {fold: _byte_table(SPACES, fold) for fold in (False, True)}


def pieces(column: pa.Array, limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Row ranges of a text column with about ``limit`` bytes each; a longer text stands alone."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(column), 0), dtype=np.int64)
    ends = np.cumsum(sizes)
    low = 0
    while low < len(sizes):
        base = ends[low] - sizes[low]
        high = max(low + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield low, high
        low = high


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the bounds of its texts; a null is an empty text."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


class Words:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a batch of texts.

    ``start`` and ``end`` are byte places, ``first[i]`` the number of the first word of
    text i, and ``hash`` holds 64 bits per word, in which A-Z count as a-z if ``fold``.
    """

    def __init__(self, data: np.ndarray, bounds: np.ndarray, fold: bool = True):
        word, self._value = _TABLES[fold]
        self.data, self.bounds = data, bounds
        inside = word[data]
        begins, ends = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        edge = bounds[1:-1]
        edge = edge[(edge > 0) & (edge < len(data))]
        begins[edge] = inside[edge]
        ends[edge - 1] = inside[edge - 1]
        self.inside = inside
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, bounds)
        self._hash = None

    @property
    def hash(self) -> np.ndarray:
        if self._hash is None:
            self._hash = self._hashes()
        return self._hash

    def _hashes(self) -> np.ndarray:
        return range_hashes(self.data, self.start, self.end, self._value)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def range_hashes(values: np.ndarray, start: np.ndarray, end: np.ndarray, table: np.ndarray | None = None) -> np.ndarray:
    """64 bits of each range of ``values``, which a table may map; ranges ascend and don't overlap.

    A place between two ranges must count as 0 in the table. Without a table every place
    belongs to a range.
    """
    out = np.empty(len(start), np.uint64)
    low = 0
    while low < len(out):
        base = start[low]
        high = max(low + 1, int(np.searchsorted(end, base + _BLOCK, side="right")))
        size = int(end[high - 1] - base)
        up, down = powers(size)
        part = values[base : base + size]
        terms = (part.astype(np.uint64) + np.uint64(1) if table is None else table[part]) * up[:size]
        begin = start[low:high] - base
        out[low:high] = np.add.reduceat(terms, begin) * down[begin]
        low = high
    return mix(out + (end - start).astype(np.uint64) * np.uint64(_INVERSE))


def windows(hashes: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all ``width`` consecutive words, none across texts; the number of each one's
    first word, and of each text's first window."""
    size = max(0, len(hashes) - width + 1)
    out = np.zeros(size, np.uint64)
    for place in range(width):
        out *= np.uint64(_BASE)
        out += hashes[place : place + size]
    lengths = np.maximum(np.diff(first) - width + 1, 0)
    word = spans(first[:-1], lengths)
    return mix(out[word]), word, np.concatenate(([0], np.cumsum(lengths)))


def repeated(keys: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Whether each key occurs twice or more among the keys of its text."""
    text = np.repeat(np.arange(len(first) - 1, dtype=np.uint64), np.diff(first))
    _, which, count = np.unique(keys ^ mix(text + np.uint64(1)), return_inverse=True, return_counts=True)
    return count[which] > 1


def per_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of the values of each text."""
    return np.diff(prefix_sums(values)[bounds])


def repeat_words(words: "Words", width: int) -> np.ndarray:
    """Words of each text that lie in a ``width``-word window found twice or more in it."""
    keys, word, begin = windows(words.hash, words.first, width)
    again = word[repeated(keys, begin)]
    change = np.zeros(len(words.hash) + 1, np.int64)
    change[again] += 1
    change[again + width] -= 1
    return per_text(np.cumsum(change)[:-1] > 0, words.first)


def spans(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The indexes start, start + 1, ... of every range, one range after the other."""
    ends = np.cumsum(length)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(start - (ends - length), length)


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Sums of all values before each place, and of all at the end."""
    out = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=out[1:])
    return out
