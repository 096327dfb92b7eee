"""Text columns as flat numpy arrays inside tasks: bytes, words and rolling hashes of whole Arrow batches.

All functions work on the UTF-8 buffer of a batch at once.  Words are runs of bytes other than space and
0x09-0x0D; those bytes never occur inside a multi-byte character, so words never cut one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True

GROW = 1 << 18  # hash powers a process keeps for each roller; longer texts compute theirs anew

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Roller:
    """Polynomial hashes of every window of a sequence of 64-bit values, from one prefix sum.

    ``seed`` chooses the base; two seeds give two independent hashes.
    """

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.base = int(rng.integers(1 << 61, dtype=np.uint64)) * 8 + 5
        self.inverse = pow(self.base, -1, 1 << 64)
        self.letters = rng.integers(1 << 63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.salt = np.uint64(rng.integers(1 << 63, dtype=np.uint64))
        self._up = self._down = np.ones(1, np.uint64)

    def _powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Powers of the base and of its inverse, ``n`` of them at least."""
        if len(self._up) < n:
            lines = []
            for factor in (self.base, self.inverse):
                line = np.full(max(n, GROW), factor, np.uint64)
                line[0] = 1
                lines.append(np.cumprod(line))
            if n > GROW:
                return lines[0], lines[1]
            self._up, self._down = lines
        return self._up, self._down

    def spans(self, values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of values[start[i]:end[i]] for every i; the length is part of it."""
        up, down = self._powers(len(values) + 1)
        sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[: len(values)], out=sums[1:])
        found = sums[end] - sums[start]
        found *= down[start]
        found += (end - start).astype(np.uint64) * self.salt
        return mix(found)

    def windows(self, values: np.ndarray, width: int) -> np.ndarray:
        """Hash of values[i:i + width] for every i."""
        n = len(values) - width + 1
        if n <= 0:
            return np.empty(0, np.uint64)
        up, down = self._powers(len(values) + 1)
        sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[: len(values)], out=sums[1:])
        found = sums[width:] - sums[:-width]
        found *= down[:n]
        return mix(found)


@lru_cache(maxsize=16)
def roller(seed: int) -> Roller:
    """One per seed and process, so its powers are computed once."""
    return Roller(seed)


@dataclass
class Texts:
    """The texts of a batch: one byte array and where each text begins (one more entry than texts)."""

    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def of(self, i: int) -> bytes:
        return self.data[self.offsets[i]: self.offsets[i + 1]].tobytes()


def texts_of(column: pa.ChunkedArray | pa.Array) -> Texts:
    """The bytes of a string or binary column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays([pc.cast(c, pa.large_binary()) for c in column.chunks]) if column.num_chunks else pa.array([], pa.large_binary())
    column = pc.fill_null(pc.cast(column, pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset: column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = column.buffers()[2] if len(column) else None
    data = np.frombuffer(raw, np.uint8)[offsets[0]: offsets[-1]] if raw is not None and raw.size else np.empty(0, np.uint8)
    return Texts(data, offsets - offsets[0])


@dataclass
class Words:
    """Where the words of a batch begin and end, and which word each text begins with."""

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray  # per text, one more entry than texts

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def words_of(texts: Texts) -> Words:
    inside = ~SEPARATOR[texts.data]
    edge = np.zeros(len(texts.data) + 1, bool)
    edge[texts.offsets] = True
    before = np.zeros(len(inside), bool)
    before[1:] = inside[:-1]
    start = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.zeros(len(inside), bool)
    after[:-1] = inside[1:]
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return Words(start, end, np.searchsorted(start, texts.offsets))


def word_hashes(texts: Texts, words: Words, roller: Roller, fold_case: bool = False) -> np.ndarray:
    data = LOWER[texts.data] if fold_case else texts.data
    return roller.spans(roller.letters[data], words.start, words.end)


def owner_of(bounds: np.ndarray, n: int) -> np.ndarray:
    """For positions 0..n-1, the text whose range [bounds[i], bounds[i+1]) holds them."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[:n]


def whole_windows(first: np.ndarray, width: int) -> np.ndarray:
    """Whether the window of ``width`` items that begins at each item lies inside its text."""
    n = int(first[-1])
    ends = np.repeat(first[1:], np.diff(first))
    return np.arange(n) + width <= ends


PART_BYTES = 2 << 20  # bytes of text handled at once inside a task


def parts_of(batch: pa.RecordBatch, at: int, size: int = PART_BYTES) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """Slices of a batch with about ``size`` bytes of text in column ``at``; a longer text is a slice of its own."""
    texts = texts_of(batch.column(at))
    start = 0
    while start < len(texts):
        end = max(start + 1, int(np.searchsorted(texts.offsets, texts.offsets[start] + size, "right")) - 1)
        yield batch.slice(start, end - start), Texts(
            texts.data[texts.offsets[start]: texts.offsets[end]], texts.offsets[start: end + 1] - texts.offsets[start])
        start = end
