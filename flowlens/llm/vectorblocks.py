"""Vectors in blocks: bounded matrices as rows of a written table, and tiles of a query block against a candidate block.

A search of stated queries against all rows compares every query with every candidate.  Both sides are packed into
blocks of bounded size, written once, so that a lost executor costs no more than its tiles.  A tile is one query block
beside one candidate block.  Tiles are dealt out by block numbers, never by content, so a frequent vector or label
gives no task more than the others.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.runtime import materialise

BLOCK_BYTES = 4 << 20
Arrays = dict[str, np.ndarray]


def usable(vector: str = "embedding") -> Column:
    """Whether a vector is neither null nor empty and holds only finite numbers."""
    v = F.col(vector)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(v) > 0) & ~bad, F.lit(False))


def lists_of(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The values of a list column without nulls, where each list begins in them, and its length."""
    size = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    return column.flatten().to_numpy(zero_copy_only=False), np.cumsum(size) - size, size


def pack(rows: DataFrame, name: str, columns: list[str], prepare: Callable[[Arrays], Arrays], block_rows: int,
         block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The written blocks of ``rows``: columns block, dim, n and a binary for each of ``columns``.

    ``rows`` has a column ``vector`` (array of numbers) and further columns without nulls, numbers or arrays of one
    fixed length.  A block holds at most ``block_rows`` vectors of one length and about ``block_bytes`` of them.
    ``prepare`` turns the arrays of a block into those to keep.  Rows are packed in the task that reads them: no shuffle.
    """
    names = rows.columns

    def write(parts: list[Arrays], number: int) -> pa.RecordBatch:
        held = {c: np.concatenate([p[c] for p in parts]) for c in names}
        n, dim = held["vector"].shape
        kept = prepare(held)
        return pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), pa.array([dim], pa.int32()), pa.array([n], pa.int32()),
             *(pa.array([np.ascontiguousarray(kept[c]).tobytes()], pa.binary()) for c in columns)],
            names=["block", "dim", "n", *columns])

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        waiting: dict[int, list[Arrays]] = {}  # by length of the vectors
        for batch in batches:
            if not batch.num_rows:
                continue
            flat, start, size = lists_of(batch.column(names.index("vector")))
            others: Arrays = {}
            for c in names:
                column = batch.column(names.index(c))
                if c == "vector":
                    continue
                others[c] = (column.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                             if pa.types.is_list(column.type) else column.to_numpy(zero_copy_only=False))
            for dim in np.unique(size).tolist():
                chosen = np.flatnonzero(size == dim)
                most = max(1, min(block_rows, block_bytes // (dim * flat.itemsize)))
                mine = waiting.setdefault(dim, [])
                while len(chosen):
                    room = most - sum(len(p["vector"]) for p in mine)
                    now, chosen = chosen[:room], chosen[room:]
                    mine.append({c: x[now] for c, x in others.items()} | {"vector": flat[start[now, None] + np.arange(dim)]})
                    if len(now) == room:
                        yield write(mine, number)
                        number += 1
                        mine.clear()
        for mine in waiting.values():
            if mine:
                yield write(mine, number)
                number += 1

    schema = "block long, dim int, n int, " + ", ".join(f"{c} binary" for c in columns)
    return materialise(rows.mapInArrow(work, schema), name)


def dealt(queries: DataFrame, block_rows: int) -> DataFrame:
    """Queries in so many partitions that each fills about one block, whatever files they came from."""
    return queries.repartition(max(1, -(-queries.count() // block_rows)))


def tiles(queries: DataFrame, candidates: DataFrame) -> DataFrame:
    """Every query block (its columns begin with ``q_``) beside every candidate block of vectors of the same length.

    A candidate block is sent once to each bucket of query blocks, a query block once to each bucket of candidate blocks:
    what comparing all with all moves at least.  The merge hint keeps the copies from being broadcast.
    """
    here, there = (max(1, side.count()) for side in (queries, candidates))
    bucket = lambda n: F.pmod(F.xxhash64("block"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    asked = queries.withColumns({"_q": bucket(here), "_c": every(there)}).withColumnsRenamed(
        {c: f"q_{c}" for c in queries.columns if c != "dim"})
    return (candidates.withColumns({"_c": bucket(there), "_q": every(here)})
            .join(asked.hint("merge"), ["_q", "_c", "dim"]).drop("_c", "_q"))


def first_of_equal(ids: np.ndarray, rows: np.ndarray, most: int) -> np.ndarray:
    """Positions, by rising id, of the rows that stand among the first ``most`` equal ones, not counting repeats of one id.

    Rows behind them can never be among the ``most`` best of a query: equal rows score alike, and smaller ids go first.
    """
    order = np.argsort(ids, kind="stable")
    rows = np.ascontiguousarray(rows[order])
    repeats = int(np.unique(ids, return_counts=True)[1].max())
    same = np.unique(rows.view(np.dtype((np.void, rows.itemsize * rows.shape[1]))).ravel(), return_inverse=True)[1].ravel()
    group = np.argsort(same, kind="stable")
    first = np.flatnonzero(np.diff(same[group], prepend=-1))
    place = np.arange(len(group)) - np.repeat(first, np.diff(np.append(first, len(group))))
    return order[np.sort(group[place < most + repeats])]


def rows_in(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    """Rows one at a time, so that one tile is unpacked at a time."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def array_in(row: dict, column: str, kind, width: int | None = None) -> np.ndarray:
    """A packed column of a block; with ``width`` a matrix."""
    found = np.frombuffer(row[column], kind)
    return found if width is None else found.reshape(-1, width)
