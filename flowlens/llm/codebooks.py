"""Vector code compression: product codebooks by Lloyd rounds over partition-local cover trees.

Vectors become integers, ``floor(scale * x)``, cut into ``parts`` equal consecutive parts.  Every block of rows keeps one
cover tree for each part, built once: a node covers its points within its radius, its children are points of it more than
radius / ``BASE`` apart, found farthest first, and its points stand side by side, so that their number and sum follow
from cumulative sums.  A round sends the codebooks (their size depends on the vectors' length alone) to the tasks and walks
the trees from the root.  Where, by the triangle inequality, one entry is nearest to all points of a node, the whole subtree
goes to it with its count and sum; only the other nodes descend, and at the bottom points are compared exactly in
whole numbers.  Blocks give sums per entry, Spark adds them up, and the driver divides a few thousand numbers.

Every entry starts as its part of one of the ``entries`` kept rows with the least (id, vector); rounds, ties (to the lower
entry), rounding (down) and unused entries (they stay) are as the docstring of ``fit_codebooks`` says.

Rows without an id, and vectors that are null, empty or hold null or non-finite components, take no part; nor do vectors whose
length is not a multiple of ``parts`` or differs from that of the first kept row, or with a component of 2**26 or more after
scaling, whose errors may not fit 64 bits.  Every row counts by itself, so repeated rows weigh as often as they stand.
Labels may be null; nulls are one label.  With fewer rows than entries the codebooks are shorter; an empty table gives
no rows.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.llm.vectorblocks import Arrays, array_in, pack, rows_in, usable
from flowlens.runtime import materialise

BLOCK_ROWS = 4096
BASE = 1.3  # a child's radius is at most its parent's divided by this
LEAF = 8  # points that are not divided further
LARGEST = 1 << 26
EXACT = 1 << 21  # components whose squared distances are exact in double precision


@dataclass(frozen=True)
class Coding:
    parts: int = 4
    entries: int = 256
    rounds: int = 4
    scale: int = 1024


def squares(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of two integer matrices."""
    most = max(int(np.abs(points).max(initial=0)), int(np.abs(entries).max(initial=0)))
    if most < EXACT and points.shape[1] < 512:
        p, e = points.astype(np.float64), entries.astype(np.float64)
        found = -2 * (p @ e.T)
        found += (p * p).sum(axis=1)[:, None]
        found += (e * e).sum(axis=1)
        return found
    return np.stack([np.square(points - e).sum(axis=1) for e in entries], axis=1)


class CoverTree:
    """Nodes as arrays: where their points begin and end in ``order``, their centre, radius, and children."""

    FIELDS = {"order": np.int32, "start": np.int32, "end": np.int32, "centre": np.int32, "radius": np.float64,
              "child": np.int32, "children": np.int32}

    def __init__(self, arrays: Arrays):
        self.__dict__.update(arrays)


def build_tree(points: np.ndarray) -> Arrays:
    """The cover tree of the rows of an integer matrix, breadth first; the root is node 0."""
    n = len(points)
    p = points.astype(np.float64)
    order = np.arange(n)
    gap = lambda rows, c: np.sqrt(np.square(p[rows] - p[c]).sum(axis=1))
    start, end, centre, radius, child, children = [0], [n], [0], [float(gap(order, 0).max())], [0], [0]
    at = 0
    while at < len(start):
        s, e = start[at], end[at]
        if radius[at] > 0 and e - s > LEAF:
            mine = order[s:e]
            nearest = gap(mine, centre[at])
            owner = np.zeros(e - s, np.int64)
            centres = [centre[at]]
            while nearest.max() > radius[at] / BASE:  # the farthest point is more than that from all centres
                c = int(mine[nearest.argmax()])
                d = gap(mine, c)
                closer = d < nearest
                nearest[closer], owner[closer] = d[closer], len(centres)
                centres.append(c)
            by = np.argsort(owner, kind="stable")
            order[s:e] = mine[by]
            cuts = s + np.searchsorted(owner[by], np.arange(len(centres) + 1))
            reach = np.zeros(len(centres))
            np.maximum.at(reach, owner, nearest)
            child[at], children[at] = len(start), len(centres)
            start += cuts[:-1].tolist()
            end += cuts[1:].tolist()
            centre += centres
            radius += reach.tolist()
            child += [0] * len(centres)
            children += [0] * len(centres)
        at += 1
    found = dict(order=order, start=start, end=end, centre=centre, radius=radius, child=child, children=children)
    return {k: np.asarray(v, CoverTree.FIELDS[k]) for k, v in found.items()}


def assign(points: np.ndarray, tree: CoverTree, entries: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(entry, start, end): ranges of ``tree.order`` whose points are all nearest to an entry; ties go to the lower one."""
    nodes = np.zeros(1, np.int64)
    while len(nodes):
        distance = np.sqrt(squares(points[tree.centre[nodes]], entries))
        entry = distance.argmin(axis=1)
        least = distance[np.arange(len(nodes)), entry].copy()
        radius = tree.radius[nodes]
        # an entry farther than this from the centre is farther than the nearest one from every point of the node
        reach = (least + 2 * radius) * (1 + 1e-9) + 1e-9
        alone = (distance <= reach[:, None]).sum(axis=1) == 1
        yield entry[alone], tree.start[nodes[alone]], tree.end[nodes[alone]]
        nodes = nodes[~alone]
        bottom = tree.children[nodes] == 0
        last = nodes[bottom]
        if len(last):
            size = tree.end[last] - tree.start[last]
            at = np.repeat(tree.start[last] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            yield squares(points[tree.order[at]], entries).argmin(axis=1), at, at + 1
        nodes = nodes[~bottom]
        size = tree.children[nodes]
        nodes = np.repeat(tree.child[nodes] - (np.cumsum(size) - size), size) + np.arange(size.sum())


def sums_by_entry(points: np.ndarray, tree: CoverTree, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum and number of the points assigned to every entry, from cumulative sums along the tree."""
    total = np.zeros((len(points) + 1, points.shape[1]), np.int64)
    np.cumsum(points[tree.order], axis=0, out=total[1:])
    sums, counts = np.zeros(entries.shape, np.int64), np.zeros(len(entries), np.int64)
    for entry, start, end in assign(points, tree, entries):
        np.add.at(sums, entry, total[end] - total[start])
        np.add.at(counts, entry, end - start)
    return sums, counts


def entry_of_each(points: np.ndarray, tree: CoverTree, entries: np.ndarray) -> np.ndarray:
    found = np.empty(len(points), np.int64)
    for entry, start, end in assign(points, tree, entries):
        size = end - start
        at = np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())
        found[tree.order[at]] = np.repeat(entry, size)
    return found


def _columns(parts: int) -> list[str]:
    return ["id", "label", "labelled", "vector", *(f"{f}_{p}" for p in range(parts) for f in CoverTree.FIELDS)]


def _prepare(coding: Coding):
    def prepare(a: Arrays) -> Arrays:
        v = np.floor(coding.scale * a["vector"].astype(np.float64)).astype(np.int32)
        trees = {}
        for p, points in enumerate(np.split(v.astype(np.int64), coding.parts, axis=1)):
            trees |= {f"{k}_{p}": x for k, x in build_tree(points).items()}
        return {"id": a["id"], "label": a["label"], "labelled": a["labelled"], "vector": v} | trees
    return prepare


def _parts_in(row: dict, parts: int) -> Iterator[tuple[np.ndarray, CoverTree]]:
    v = array_in(row, "vector", np.int32, row["dim"]).astype(np.int64)
    for p, points in enumerate(np.split(v, parts, axis=1)):
        yield points, CoverTree({f: array_in(row, f"{f}_{p}", kind) for f, kind in CoverTree.FIELDS.items()})


def vector_blocks(vectors: DataFrame, coding: Coding, id_column: str, label: str | None, vector: str
                  ) -> tuple[DataFrame, list[np.ndarray]]:
    """The written blocks with their trees, and the first codebooks."""
    small = ~F.exists(vector, lambda x: F.abs(x.cast("double")) >= LARGEST / coding.scale)
    named = F.col(label).cast("long") if label else F.lit(None).cast("long")
    rows = vectors.filter(
        F.col(id_column).isNotNull() & usable(vector) & (F.size(vector) % coding.parts == 0) & small
    ).select(F.col(id_column).cast("long").alias("id"), F.coalesce(named, F.lit(0).cast("long")).alias("label"),
             named.isNotNull().cast("long").alias("labelled"), F.col(vector).cast("array<double>").alias("vector"))
    first = rows.orderBy("id", "vector").select("vector").first()
    if first is None:
        return materialise(rows, "no-vectors"), []
    rows = rows.filter(F.size("vector") == len(first[0]))
    # as many rows as a codebook has entries
    seeds = np.array([r[0] for r in rows.orderBy("id", "vector").select("vector").limit(coding.entries).collect()])
    seeds = np.floor(coding.scale * seeds).astype(np.int64)
    blocks = pack(rows, "vector-trees", _columns(coding.parts), _prepare(coding), BLOCK_ROWS)
    return blocks, np.split(seeds, coding.parts, axis=1)


def fit_codebooks(blocks: DataFrame, books: list[np.ndarray], coding: Coding) -> list[np.ndarray]:
    """The codebooks after all rounds.

    A round assigns every part of every vector to the nearest entry of its codebook (squared Euclidean distance, ties to
    the lower entry) and replaces each entry by floor(sum / count) of what it got; an entry that got nothing stays.
    """
    width = books[0].shape[1]
    schema = "part int, entry int, n long, sums array<long>"
    for _ in range(coding.rounds):
        now = books

        def work(batches: Iterable[pa.RecordBatch], now: list[np.ndarray] = now) -> Iterator[pa.RecordBatch]:
            sums = [np.zeros(b.shape, np.int64) for b in now]
            counts = [np.zeros(len(b), np.int64) for b in now]
            for row in rows_in(batches):
                for p, (points, tree) in enumerate(_parts_in(row, len(now))):
                    s, n = sums_by_entry(points, tree, now[p])
                    sums[p] += s
                    counts[p] += n
            for p, (s, n) in enumerate(zip(sums, counts)):
                used = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(used), p), pa.int32()), pa.array(used, pa.int32()), pa.array(n[used], pa.int64()),
                     pa.array(list(s[used]), pa.list_(pa.int64()))], names=["part", "entry", "n", "sums"])

        total = blocks.mapInArrow(work, schema).groupBy("part", "entry").agg(
            F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[i]) for i in range(width)]).alias("sums"))
        books = [b.copy() for b in books]
        for r in total.collect():  # a row per entry
            books[r.part][r.entry] = np.array(r.sums, np.int64) // r.n
    return books


def digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all components in decimal, by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(str(x) for b in books for x in b.reshape(-1).tolist()).encode()).hexdigest()


def encode(blocks: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """vec_id, label, code (the entries of the parts, two hex digits each) and error (squared distances over all parts)."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_in(batches):
            codes, error = [], 0
            for book, (points, tree) in zip(books, _parts_in(row, len(books))):
                entry = entry_of_each(points, tree, book)
                error = error + np.square(points - book[entry]).sum(axis=1)
                codes.append(entry)
            text = np.stack(codes, axis=1).astype(np.uint8).tobytes().hex()
            size = 2 * len(books)
            label, held = array_in(row, "label", np.int64), array_in(row, "labelled", np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(array_in(row, "id", np.int64)), pa.array(label, pa.int64(), mask=held == 0),
                 pa.array([text[i: i + size] for i in range(0, len(text), size)], pa.string()), pa.array(error, pa.int64())],
                names=["vec_id", "label", "code", "error"])

    return blocks.mapInArrow(work, "vec_id long, label long, code string, error long")


def compress(vectors: DataFrame, coding: Coding = Coding(), id_column: str = "vec_id", label: str | None = "label",
             vector: str = "embedding") -> DataFrame:
    """vec_id, label, code, error, label_error (error summed over equal labels) and codebooks_sha256 of every kept row."""
    if coding.entries > 256:
        raise ValueError("a code has two hex digits a part, so a codebook has 256 entries at most")
    blocks, books = vector_blocks(vectors, coding, id_column, label, vector)
    if not books:
        return blocks.select(F.col("id").alias("vec_id"), "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"),
                             F.lit(0).cast("long").alias("label_error"), F.lit("").alias("codebooks_sha256"))
    books = fit_codebooks(blocks, books, coding)
    coded = materialise(encode(blocks, books), "codes")
    errors = materialise(coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error")), "label-errors")
    return coded.join(errors, F.col("label").eqNullSafe(F.col("_label"))).select(
        "vec_id", "label", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
