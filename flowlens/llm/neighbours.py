"""Nearest neighbours by a block matrix join: 8-bit product tiles, error bounds, recomputation of the survivors, heaps.

Every vector is also kept as 8-bit integers times a scale of its own, with the length of what the rounding lost.  A
tile multiplies the integers of a query block and a candidate block (exact sums), which gives every distance up to
the sum of the two losses.  Pairs whose least possible distance is within the query's bound are recomputed in
double precision on the original vectors and pushed on the query's heap of ``k``.  The bound of a query is the
distance of its ``k``-th nearest so far: first among the queries themselves, which is a hundredth of the work and makes
the tiles of the full pass give few rows, then among what the task has seen.  No pair is left out that could be in the
answer, so recall is 1.

Vectors that are null, empty, zero, or hold null or non-finite components take no part; nor do rows without an id.
Vectors of different lengths are never compared.  Distances beyond the range of a double are infinite.  Every row
counts by itself, so a repeated row is listed as often as it stands; rows with the query's own id are no candidates,
and of several query rows with one id the least vector is the query.  Ties go to the smaller id.  With fewer than ``k``
candidates all are listed; an empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowlens.llm.vectorblocks import Arrays, array_in, dealt, first_of_equal, pack, rows_in, tiles, usable
from flowlens.runtime import materialise

QUERY_ROWS = 4096
CANDIDATE_ROWS = 8192
CHUNK = 128  # queries of a tile handled at once
EXACT_TERMS = 1024  # 8-bit products whose sum is exact in single precision
PAIRS = 1 << 16  # recomputed at once
OPEN = 4  # query blocks whose heaps a task keeps at once
FOUND = "query_id long, vec_id long, score double"


def quantise(vectors: np.ndarray) -> Arrays:
    """Codes, scale, and the length of what rounding lost, for every vector."""
    v = vectors.astype(np.float64)
    scale = np.abs(v).max(axis=1) / 127
    codes = np.rint(v / np.where(scale > 0, scale, 1)[:, None]).clip(-127, 127)
    with np.errstate(over="ignore"):
        lost = np.sqrt(np.square(v - codes * scale[:, None]).sum(axis=1))
    return {"codes": codes.astype(np.int8), "scale": scale, "lost": lost}


def exact(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Distances of the rows of two matrices, summed from the first component to the last."""
    with np.errstate(over="ignore"):
        gap = x.astype(np.float64) - y.astype(np.float64)
        return np.sqrt(np.cumsum(gap * gap, axis=1)[:, -1])


def products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner products of all rows of two matrices of 8-bit integers, exact."""
    total = np.zeros((len(x), len(y)))
    for at in range(0, x.shape[1], EXACT_TERMS):
        total += x[:, at: at + EXACT_TERMS].astype(np.float32) @ y[:, at: at + EXACT_TERMS].astype(np.float32).T
    return total


class Side:
    """A block of a tile: ids, original vectors, codes and bounds."""

    def __init__(self, row: dict, kind, prefix: str = ""):
        dim = row["dim"]
        self.ids = array_in(row, f"{prefix}id", np.int64)
        self.vectors = array_in(row, f"{prefix}vector", kind, dim)
        self.codes = array_in(row, f"{prefix}codes", np.int8, dim)
        self.scale = array_in(row, f"{prefix}scale", np.float64)
        self.lost = array_in(row, f"{prefix}lost", np.float64)
        with np.errstate(over="ignore"):
            self.square = np.square(self.scale) * np.square(self.codes.astype(np.float64)).sum(axis=1)


class Heaps:
    """The nearest so far of every query of a block, as heaps with the worst on top."""

    def __init__(self, ids: np.ndarray, bound: np.ndarray, k: int):
        self.ids, self.bound, self.k = ids, bound.copy(), k
        self.heaps: list[list[tuple[float, int]]] = [[] for _ in ids]

    def push(self, query: int, score: float, candidate: int) -> None:
        heap, item = self.heaps[query], (-score, -candidate)
        if len(heap) < self.k:
            heapq.heappush(heap, item)
        elif item > heap[0]:
            heapq.heapreplace(heap, item)
        if len(heap) == self.k:
            self.bound[query] = min(self.bound[query], -heap[0][0])

    def rows(self) -> pa.RecordBatch:
        size = [len(h) for h in self.heaps]
        flat = [item for heap in self.heaps for item in heap]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(self.ids, size), pa.int64()), pa.array([-i for _, i in flat], pa.int64()),
             pa.array([-s for s, _ in flat], pa.float64())], names=["query_id", "vec_id", "score"])


def search(queries: Side, candidates: Side, heaps: Heaps) -> None:
    """Push what a tile holds."""
    k = heaps.k
    for start in range(0, len(queries.ids), CHUNK):
        at = slice(start, start + CHUNK)
        with np.errstate(over="ignore", invalid="ignore"):
            both = queries.square[at, None] + candidates.square
            square = both - 2 * queries.scale[at, None] * candidates.scale * products(queries.codes[at], candidates.codes)
            # rounding of the sums above, of the lengths of the losses, and of the distance itself
            slack = 1e-12 * both + 1e-300
            lost = (queries.lost[at, None] + candidates.lost) * (1 + 1e-9) + 1e-12 * np.sqrt(both)
            least = np.sqrt(np.maximum(square - slack, 0)) * (1 - 1e-12) - lost
            own = queries.ids[at, None] == candidates.ids
            bound = heaps.bound[at].copy()
            many = np.flatnonzero((~(least > bound[:, None])).sum(axis=1) > 4 * k)
            if len(many) and len(candidates.ids) > k:
                most = np.sqrt(square[many] + slack[many]) * (1 + 1e-12) + lost[many]
                most[own[many] | np.isnan(most)] = np.inf
                bound[many] = np.minimum(bound[many], np.partition(most, k - 1, axis=1)[:, k - 1])
            q, c = np.nonzero(~(least > bound[:, None]) & ~own)
        for part in range(0, len(q), PAIRS):
            x, y = q[part: part + PAIRS] + start, c[part: part + PAIRS]
            score = exact(queries.vectors[x], candidates.vectors[y])
            near = score <= heaps.bound[x]
            for i, s, j in zip(x[near].tolist(), score[near].tolist(), candidates.ids[y[near]].tolist()):
                heaps.push(i, s, j)


def _candidate_block(k: int):
    def prepare(a: Arrays) -> Arrays:
        # 0.0 and -0.0 differ as bytes, which only keeps more
        kept = first_of_equal(a["id"], a["vector"], k)
        return {"id": a["id"][kept], "vector": a["vector"][kept]} | quantise(a["vector"][kept])
    return prepare


def _query_block(a: Arrays) -> Arrays:
    return {"id": a["id"], "vector": a["vector"], "bound": a["bound"]} | quantise(a["vector"])


def _join(queries: DataFrame, candidates: DataFrame, k: int, kind) -> DataFrame:
    """(query_id, vec_id, score): for every query and task at least the rows that are among its k nearest."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, Heaps] = {}
        asked: dict[int, Side] = {}
        for row in rows_in(batches):
            number = row["q_block"]
            if number not in kept:
                if len(kept) == OPEN:
                    oldest = next(iter(kept))
                    yield kept.pop(oldest).rows()
                    del asked[oldest]
                asked[number] = Side(row, kind, "q_")
                kept[number] = Heaps(asked[number].ids, array_in(row, "q_bound", np.float64), k)
            search(asked[number], Side(row, kind), kept[number])
        for heaps in kept.values():
            yield heaps.rows()

    return tiles(queries, candidates).mapInArrow(work, FOUND)


def _nearest(found: DataFrame, k: int) -> DataFrame:
    """The k first of every query; Spark cuts to k before the shuffle already."""
    w = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, id_column: str = "vec_id",
            vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k rows of ``vectors`` nearest to every row of ``queries``."""
    wide = dict(vectors.dtypes)[vector] != "array<float>" or dict(queries.dtypes)[vector] != "array<float>"
    numbers, kind = ("array<double>", np.float64) if wide else ("array<float>", np.float32)

    def rows(df: DataFrame) -> DataFrame:
        taken = usable(vector) & F.exists(vector, lambda x: x != 0) & F.col(id_column).isNotNull()
        return df.filter(taken).select(F.col(id_column).cast("long").alias("id"), F.col(vector).cast(numbers).alias("vector"))

    asked = materialise(rows(queries).groupBy("id").agg(F.min("vector").alias("vector")), "queries")
    kept = ["id", "vector", "codes", "scale", "lost"]
    block = lambda df, name: pack(dealt(df, QUERY_ROWS), name, [*kept, "bound"], _query_block, QUERY_ROWS)
    unbounded = block(asked.withColumn("bound", F.lit(float("inf"))), "query-blocks")
    among = pack(dealt(asked, CANDIDATE_ROWS), "query-candidates", kept, _candidate_block(k), CANDIDATE_ROWS)
    first = _nearest(_join(unbounded, among, k, kind), k).filter(F.col("rank") == k)
    bounds = materialise(first.select(F.col("query_id").alias("id"), F.col("score").alias("bound")), "query-bounds")
    bounded = block(asked.join(bounds, "id", "left").fillna(float("inf"), "bound"), "bounded-query-blocks")
    blocks = pack(rows(vectors), "vector-blocks", kept, _candidate_block(k), CANDIDATE_ROWS)
    return _nearest(_join(bounded, blocks, k, kind), k).select("query_id", "rank", "vec_id", "score")
