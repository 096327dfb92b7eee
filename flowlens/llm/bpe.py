"""Byte-level BPE by corpus-level merge replay, and decoding.

The texts of a block are cut by the public pattern.  Its distinct pieces form one corpus: a doubly linked list
of tokens over all of them, with an inverted index from a pair of neighbouring tokens (named by the rank it merges
into) to the positions where it stands.  A heap gives the lowest rank present; all its positions are merged at once,
and only the pairs with the two neighbours are looked up anew.  Pieces are independent, so replaying all of them
together gives what merging each alone would give: always the lowest rank of the piece, leftmost first.  Where a merge
makes a pair of a lower rank than the one in hand, the rest of that piece waits until the lower one is done.

No shuffle: a block is what a task reads, up to ``BLOCK_BYTES`` of whole texts, and nothing is kept from one block to
the next.

Edge cases: null and empty texts give no ids; invalid ranks cannot occur because all 256 bytes have one;
repeated rows are encoded each; an empty table gives an empty result; other columns are passed through.
"""

from __future__ import annotations

import base64
import heapq
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from flowlens.llm.arrowtext import parts_of

BLOCK_BYTES = 4 << 20  # of text whose pieces are replayed together; a longer text is a block of its own
SLICE = 1 << 18  # positions looked up at once
NONE = np.int32((1 << 31) - 1)  # rank of a pair that does not merge


def ship_ranks(spark: SparkSession, path: str) -> str:
    """Send the rank file to the executors; gives the name to load it by.  Its size is that of a vocabulary."""
    spark.sparkContext.addFile(path)
    return path.rsplit("/", 1)[-1]


@lru_cache(maxsize=2)
def load_ranks(name: str) -> dict[bytes, int]:
    with open(SparkFiles.get(name), "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@dataclass(frozen=True)
class Merges:
    """The vocabulary as tables: the id of every byte, and the rank that two neighbouring tokens merge into."""

    byte: np.ndarray
    key: np.ndarray  # sorted, left token * size + right token
    rank: np.ndarray
    size: int

    @staticmethod
    def of(ranks: dict[bytes, int]) -> Merges:
        size = max(ranks.values(), default=0) + 2  # the last id is that of "no neighbour"
        byte = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        keys, found = [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left * size + right)
                    found.append(rank)
        key, rank_ = np.array(keys, np.int64), np.array(found, np.int64)
        order = np.argsort(key)
        return Merges(byte, np.append(key[order], size * size), np.append(rank_[order], NONE).astype(np.int32), size)

    def look(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, NONE where the two do not merge."""
        key = left.astype(np.int64) * self.size + right
        at = np.searchsorted(self.key, key)
        return np.where(self.key[at] == key, self.rank[at], NONE)


def replay_merges(pieces: list[bytes], merges: Merges) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all pieces end to end, and where each piece begins in them (one entry more than pieces)."""
    data = np.frombuffer(b"".join(pieces), np.uint8)
    n = len(data)
    bounds = np.zeros(len(pieces) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)), out=bounds[1:])
    piece = np.repeat(np.arange(len(pieces), dtype=np.int32), np.diff(bounds))
    token = merges.byte[data]
    # position n stands for "no neighbour": its token merges with nothing
    token = np.append(token, np.int32(merges.size - 1))
    after, before = np.append(np.arange(1, n + 1, dtype=np.int32), np.int32(n)), np.arange(-1, n, dtype=np.int32)
    ends = bounds[1:][np.diff(bounds) > 0]
    after[ends - 1] = n
    before[ends[:-1]] = n
    if n:
        before[0] = n
    now = np.full(n + 1, NONE)  # rank of the pair that begins at a position
    for start in range(0, n, SLICE):
        at = np.arange(start, min(start + SLICE, n))
        now[at] = _pair(token, at, after, merges, n)
    index: dict[int, list[np.ndarray]] = {}
    heap: list[int] = []

    def note(places: np.ndarray, ranks: np.ndarray) -> None:
        """Add positions to the inverted index."""
        if not len(places):
            return
        order = ranks.argsort(kind="stable")
        places, ranks = places[order], ranks[order]
        cuts = [0, *(np.flatnonzero(ranks[1:] != ranks[:-1]) + 1).tolist(), len(ranks)]
        for s, e, rank in zip(cuts, cuts[1:], ranks[cuts[:-1]].tolist()):
            if rank in index:
                index[rank].append(places[s:e])
            else:
                index[rank] = [places[s:e]]
                heapq.heappush(heap, rank)

    first = np.flatnonzero(now < NONE).astype(np.int32)
    note(first, now[first])
    while heap:
        rank = heapq.heappop(heap)
        parts = index.pop(rank)
        at = parts[0] if len(parts) == 1 else np.concatenate(parts)
        at = at[now[at] == rank]  # a neighbour of the others has changed since they were noted
        if len(at) > 1:
            at = np.unique(at)
            run = np.append(True, after[at[:-1]] != at[1:])
            if not run.all():  # of positions in a row every second one merges, from the left
                place = np.arange(len(at))
                at = at[(place - np.maximum.accumulate(np.where(run, place, 0))) % 2 == 0]
        if not len(at):
            continue
        right = after[at]
        beyond = after[right]
        own = piece[at]
        if len(at) > 1 and (own[1:] == own[:-1]).any():
            both = np.full(len(at), rank, np.int32)
            lower = ((merges.look(token[before[at]], both) < rank) | (merges.look(both, token[beyond]) < rank)
                     | (merges.look(both[:1], both[:1])[0] < rank))
            if lower.any():  # where a merge makes a pair of a lower rank, the rest of its piece waits until that is done
                held = np.isin(own, own[lower]) & np.append(False, own[1:] == own[:-1])
                note(at[held], np.full(int(held.sum()), rank))
                at, right, beyond = at[~held], right[~held], beyond[~held]
        token[at] = rank
        now[right] = NONE
        token[right] = -1
        after[at] = beyond
        before[beyond] = at
        before[n] = n
        back = before[at]
        now[at] = _pair(token, at, after, merges, n)
        now[back] = _pair(token, back, after, merges, n)
        now[n] = NONE
        changed = np.concatenate([at, back])
        changed = changed[now[changed] < NONE]
        note(changed, now[changed])
    kept = np.flatnonzero(token[:n] >= 0)
    return token[kept].astype("<u4"), np.searchsorted(kept, bounds)


def _pair(token: np.ndarray, at: np.ndarray, after: np.ndarray, merges: Merges, none: int) -> np.ndarray:
    """Rank of the pair that begins at each position."""
    return np.where((at != none) & (after[at] != none), merges.look(token[at], token[after[at]]), NONE)


class Encoder:
    """Encodes texts block by block; ids come as little-endian unsigned 32-bit integers."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.merges, self.find = Merges.of(ranks), regex.compile(pattern).findall

    def encode(self, texts: list[str]) -> list[bytes]:
        number: dict[str, int] = defaultdict()  # distinct pieces in order of appearance
        number.default_factory = number.__len__
        look = number.__getitem__
        cut = [np.fromiter(map(look, self.find(t)), np.int32) for t in texts]
        ids, begin = replay_merges([p.encode() for p in number], self.merges)
        size = np.diff(begin)
        found = []
        for pieces in cut:
            length = size[pieces]
            place = np.cumsum(length) - length
            found.append(ids[np.arange(int(length.sum())) + np.repeat(begin[pieces] - place, length)].tobytes())
        return found


class Decoder:
    """Turns ids back into bytes with one gather over a table of all tokens."""

    def __init__(self, ranks: dict[bytes, int]):
        table = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            table[rank] = token
        self.flat = np.frombuffer(b"".join(table), np.uint8)
        self.length = np.fromiter(map(len, table), np.int64, len(table))
        self.begin = np.cumsum(self.length) - self.length

    def decode(self, ids: bytes) -> bytes:
        numbers = np.frombuffer(ids, "<u4")
        length = self.length[numbers]
        place = np.cumsum(length) - length
        return self.flat[np.arange(int(length.sum())) + np.repeat(self.begin[numbers] - place, length)].tobytes()


def encode_texts(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", ids: str = "ids",
                 decoded: str = "decoded") -> DataFrame:
    """``docs`` with the ids of its text (binary, 4 bytes an id) and the bytes these decode to."""
    name = ship_ranks(docs.sparkSession, ranks_path)
    at = docs.columns.index(text)
    kept = [f for f in docs.schema.fields if f.name not in (ids, decoded)]
    schema = T.StructType([*kept, T.StructField(ids, T.BinaryType()), T.StructField(decoded, T.BinaryType())])
    keep = [docs.columns.index(f.name) for f in kept]

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = load_ranks(name)
        encoder, decoder = Encoder(ranks, pattern), Decoder(ranks)
        for batch in batches:
            for part, _ in parts_of(batch, at, BLOCK_BYTES):
                found = encoder.encode([t or "" for t in part.column(at).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(i) for i in keep), pa.array(found, pa.binary()),
                     pa.array([decoder.decode(x) for x in found], pa.binary())],
                    names=[*(f.name for f in kept), ids, decoded])

    return docs.mapInArrow(encode, schema)
