"""Hard negatives by angular triangle filtering.

Vectors become integers, ``floor(scale * x)``, and a score is an exact integer inner product.  A block of candidates is
sorted by label and by the angle to the nearest of a few reference directions chosen in the block, and cut into
pages.  A page keeps the least and greatest angle to every reference and the least and greatest length.  For an anchor
with angles of its own to the references, the triangle inequality on the sphere gives an interval for the angle to
any row of the page, so for the cosine, and times the lengths for the score, widened beyond every rounding.  Only pages whose
interval meets a window that the anchor asks for are scored.

An anchor asks first for its best rows of the same label (one open window), then, for every positive with score p, for
the best rows of other labels with a score from ``low`` to ``high`` percent of p.  Each search runs among the anchors
first, a small part of the work, which narrows the windows for the search in all rows.  A window's lower end follows
the worst of its best rows so far.  Nothing is left out that could be in the answer.

Rows without id or label, and vectors that are null, empty or hold null or non-finite components, take no part; nor do
vectors with a component of 2**26 or more after scaling, whose scores may not fit 64 bits.  Zero vectors score 0.
Vectors of different lengths are never compared.  Every row counts by itself, but rows with the anchor's id are
never its positives or negatives; of several anchor rows with one id the least (vector, label) is the anchor.  Ties go
to the smaller id.  An anchor without positives, or a positive without negatives, gives no rows; nor does an
empty table.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowlens.llm.vectorblocks import Arrays, array_in, dealt, first_of_equal, pack, rows_in, tiles, usable
from flowlens.runtime import materialise

ANCHOR_ROWS = 2048
CANDIDATE_ROWS = 8192
PAGE = 128  # rows of a page at most
REFERENCES = 16
CHUNK = 256  # anchors of a tile handled at once
OPEN = 4  # anchor blocks whose best rows a task keeps at once
LARGEST = 1 << 26
FAR = 1 << 62  # beyond every score
ANGLE_SLACK = 1e-6  # radians; arc cosines near 1 are off by 2e-8 at most
FOUND = "anchor_id long, slot int, vec_id long, score long"
CANDIDATE = ["id", "vector", "references", "page_start", "page_label", "least_angle", "most_angle", "least_length", "most_length"]
ANCHOR = ["id", "label", "vector", "low", "high"]


@dataclass(frozen=True)
class Mining:
    """Positives an anchor has, negatives a positive has, and the percentages of its score between which they lie."""

    positives: int = 5
    negatives: int = 5
    low: int = 80
    high: int = 100
    scale: int = 256


def integers(vectors: np.ndarray, scale: int) -> np.ndarray:
    return np.floor(scale * vectors.astype(np.float64)).astype(np.int64)


def lengths(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt(np.square(vectors.astype(np.float64)).sum(axis=1))


def directions(vectors: np.ndarray) -> np.ndarray:
    """The vectors at length 1; zero vectors stay zero and stand at a right angle to everything."""
    size = lengths(vectors)
    return vectors / np.where(size > 0, size, 1)[:, None]


def angles(units: np.ndarray, references: np.ndarray) -> np.ndarray:
    return np.arccos((units @ references.T).clip(-1, 1))


def choose_references(units: np.ndarray, n: int = REFERENCES) -> np.ndarray:
    """Farthest-first directions: each is the one whose greatest cosine to those before is least."""
    chosen = [0]
    closest = units @ units[0]
    while len(chosen) < min(n, len(units)):
        chosen.append(int(closest.argmin()))
        closest = np.maximum(closest, units @ units[chosen[-1]])
    return units[chosen]


def scores(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of two integer matrices, by the fastest kind of number that holds them."""
    most = x.shape[1] * int(np.abs(x).max(initial=0)) * int(np.abs(y).max(initial=0))
    kind = np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64
    return (x.astype(kind) @ y.astype(kind).T).astype(np.int64)


def _candidate_block(most: int, scale: int):
    def prepare(a: Arrays) -> Arrays:
        v = integers(a["vector"], scale)
        kept = first_of_equal(a["id"], np.column_stack([a["label"], v]), most)
        ids, labels, v = a["id"][kept], a["label"][kept], v[kept]
        units, size = directions(v), lengths(v)
        references = choose_references(units)
        angle = angles(units, references)
        cell = angle.argmin(axis=1)
        order = np.lexsort((angle[np.arange(len(cell)), cell], cell, labels))
        ids, labels, v, angle, size = ids[order], labels[order], v[order], angle[order], size[order]
        label_at = np.flatnonzero(np.diff(labels, prepend=labels[0] - 1))
        ends = np.append(label_at[1:], len(labels))
        start = np.concatenate([np.arange(s, e, PAGE) for s, e in zip(label_at.tolist(), ends.tolist())])
        return {
            "id": ids, "vector": v.astype(np.int32), "references": references, "page_start": start, "page_label": labels[start],
            "least_angle": np.minimum.reduceat(angle, start), "most_angle": np.maximum.reduceat(angle, start),
            "least_length": np.minimum.reduceat(size, start), "most_length": np.maximum.reduceat(size, start)}
    return prepare


def _anchor_block(scale: int):
    def prepare(a: Arrays) -> Arrays:
        return a | {"vector": integers(a["vector"], scale).astype(np.int32)}
    return prepare


class Best:
    """The best rows so far of every window of a block of anchors, and the ends of the windows."""

    def __init__(self, ids: np.ndarray, low: np.ndarray, high: np.ndarray, most: int):
        self.ids, self.low, self.high, self.most = ids, low.copy(), high, most
        self.slots = low.shape[1]
        self.score = np.zeros((low.size, most), np.int64)
        self.row = np.zeros((low.size, most), np.int64)
        self.n = np.zeros(low.size, np.int64)

    def add(self, key: np.ndarray, score: np.ndarray, row: np.ndarray) -> None:
        """Merge hits; ``key`` is anchor * slots + slot."""
        touched = np.unique(key)
        old = np.arange(self.most) < self.n[touched, None]
        key = np.concatenate([key, np.repeat(touched, self.n[touched])])
        score = np.concatenate([score, self.score[touched][old]])
        row = np.concatenate([row, self.row[touched][old]])
        order = np.lexsort((row, -score, key))
        key, score, row = key[order], score[order], row[order]
        first = np.searchsorted(key, touched)
        size = np.diff(np.append(first, len(key)))
        place = np.arange(len(key)) - np.repeat(first, size)
        kept = place < self.most
        self.score[key[kept], place[kept]] = score[kept]
        self.row[key[kept], place[kept]] = row[kept]
        self.n[touched] = np.minimum(size, self.most)
        full = touched[self.n[touched] == self.most]
        flat = self.low.reshape(-1)
        flat[full] = np.maximum(flat[full], self.score[full, -1])

    def rows(self) -> pa.RecordBatch:
        held = np.arange(self.most) < self.n[:, None]
        key = np.repeat(np.arange(len(self.n)), self.n)
        return pa.RecordBatch.from_arrays(
            [pa.array(self.ids[key // self.slots]), pa.array((key % self.slots).astype(np.int32)), pa.array(self.row[held]),
             pa.array(self.score[held])], names=["anchor_id", "slot", "vec_id", "score"])


class Anchors:
    def __init__(self, row: dict):
        self.ids, self.labels = (array_in(row, f"q_{c}", np.int64) for c in ("id", "label"))
        self.vectors = array_in(row, "q_vector", np.int32, row["dim"]).astype(np.int64)
        self.units, self.lengths = directions(self.vectors), lengths(self.vectors)
        self.low, self.high = (array_in(row, f"q_{c}", np.int64).reshape(len(self.ids), -1) for c in ("low", "high"))


def score_bounds(units: np.ndarray, size: np.ndarray, references: np.ndarray, least_angle: np.ndarray, most_angle: np.ndarray,
                 least_length: np.ndarray, most_length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score possible between each anchor and the rows of each page."""
    own = angles(units, references)[:, None, :]
    near = np.maximum(np.maximum(least_angle - own, own - most_angle), 0).max(axis=2) - ANGLE_SLACK
    far = np.minimum(own + most_angle, 2 * np.pi - own - least_angle).min(axis=2) + ANGLE_SLACK
    best, worst = np.cos(near.clip(0, np.pi)), np.cos(far.clip(0, np.pi))
    # a zero vector has no angle: its score is 0, which both bounds below admit because its page's least length is 0
    long_, short = size[:, None] * most_length, size[:, None] * least_length
    slack = 1 + 1e-9 * long_
    return (np.where(worst < 0, long_, short) * worst - slack, np.where(best > 0, long_, short) * best + slack)


def search(anchors: Anchors, row: dict, best: Best, same: bool) -> None:
    """Add what a candidate block holds."""
    ids, dim = array_in(row, "id", np.int64), row["dim"]
    vectors = array_in(row, "vector", np.int32, dim).astype(np.int64)
    references = array_in(row, "references", np.float64, dim)
    start, label = array_in(row, "page_start", np.int64), array_in(row, "page_label", np.int64)
    bounds = [array_in(row, c, np.float64).reshape(len(start), -1) for c in ("least_angle", "most_angle")]
    sizes = [array_in(row, c, np.float64) for c in ("least_length", "most_length")]
    end = np.append(start[1:], len(ids))
    for chunk in range(0, len(anchors.ids), CHUNK):
        at = np.arange(chunk, min(chunk + CHUNK, len(anchors.ids)))
        least, most = score_bounds(anchors.units[at], anchors.lengths[at], references, *bounds, *sizes)
        fits = (anchors.labels[at, None] == label) == same
        for page in range(len(start)):
            low, high = best.low[at], best.high[at]
            meets = ((most[:, page, None] >= low) & (least[:, page, None] <= high) & (low <= high)).any(axis=1) & fits[:, page]
            asked = at[meets]
            if not len(asked):
                continue
            own = slice(start[page], end[page])
            found = scores(anchors.vectors[asked], vectors[own])
            allowed = anchors.ids[asked, None] != ids[own]
            hits = (found[:, None, :] >= best.low[asked][:, :, None]) & (found[:, None, :] <= best.high[asked][:, :, None])
            a, s, c = np.nonzero(hits & allowed[:, None, :])
            if len(a):
                best.add(asked[a] * best.slots + s, found[a, c], ids[own][c])


def _join(anchors: DataFrame, candidates: DataFrame, same: bool, most: int) -> DataFrame:
    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, tuple[Anchors, Best]] = {}
        for row in rows_in(batches):
            number = row["q_block"]
            if number not in kept:
                if len(kept) == OPEN:
                    yield kept.pop(next(iter(kept)))[1].rows()
                asked = Anchors(row)
                kept[number] = asked, Best(asked.ids, asked.low, asked.high, most)
            search(kept[number][0], row, kept[number][1], same)
        for _, best in kept.values():
            yield best.rows()

    w = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "vec_id")
    found = tiles(anchors, candidates).mapInArrow(work, FOUND)
    return found.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= most)


def _rows(df: DataFrame, scale: int, id_column: str, label: str, vector: str) -> DataFrame:
    small = ~F.exists(vector, lambda x: F.abs(x.cast("double")) >= LARGEST / scale)
    taken = F.col(id_column).isNotNull() & F.col(label).isNotNull() & usable(vector) & small
    return df.filter(taken).select(F.col(id_column).cast("long").alias("id"), F.col(label).cast("long").alias("label"),
                                   F.col(vector).cast("array<double>").alias("vector"))


def hard_negatives(vectors: DataFrame, anchors: DataFrame, mining: Mining = Mining(), id_column: str = "vec_id",
                   label: str = "label", vector: str = "embedding") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score; ``anchors`` are rows like ``vectors``."""
    m = mining
    named = m.scale, id_column, label, vector
    asked = materialise(_rows(anchors, *named).groupBy("id").agg(F.min(F.struct("vector", "label")).alias("r")).select(
        "id", "r.label", "r.vector"), "anchors")
    most = max(m.positives, m.negatives)
    among = pack(dealt(asked, CANDIDATE_ROWS), "anchor-candidates", CANDIDATE, _candidate_block(most, m.scale), CANDIDATE_ROWS)
    everything = pack(_rows(vectors, *named), "candidates", CANDIDATE, _candidate_block(most, m.scale), CANDIDATE_ROWS)
    block = lambda df, name: pack(dealt(df, ANCHOR_ROWS), name, ANCHOR, _anchor_block(m.scale), ANCHOR_ROWS)

    def narrowed(requests: DataFrame, same: bool, keep: int) -> DataFrame:
        """Requests whose windows begin where the anchors alone already fill them."""
        found = _join(block(requests, "requests"), among, same, keep).filter(F.col("place") == keep)
        ends = materialise(found.groupBy(F.col("anchor_id").alias("id")).agg(
            F.map_from_entries(F.collect_list(F.struct("slot", "score"))).alias("ends")), "window-ends")
        raised = F.transform("low", lambda x, i: F.greatest(x, F.coalesce(F.try_element_at("ends", i), x)))
        return requests.join(ends, "id", "left").withColumn("low", raised).drop("ends")

    open_ = asked.withColumns({"low": F.array(F.lit(-FAR)), "high": F.array(F.lit(FAR))})
    positives = materialise(
        _join(block(narrowed(open_, True, m.positives), "anchors-open"), everything, True, m.positives).select(
            "anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"),
            (F.col("place") - 1).cast("int").alias("slot")), "positives")
    # low * p <= 100 * score <= high * p, in whole numbers
    ends = positives.select(
        F.col("anchor_id").alias("id"), "slot", F.expr(f"-((-{m.low} * positive_score - pmod(-{m.low} * positive_score, 100)) div 100)")
        .alias("low"), F.expr(f"({m.high} * positive_score - pmod({m.high} * positive_score, 100)) div 100").alias("high"))
    per_anchor = ends.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("slot", "low", "high"))).alias("w"))
    slots = F.sequence(F.lit(0), F.lit(m.positives - 1))
    padded = lambda c, none: F.transform(slots, lambda i: F.coalesce(F.get(F.col(f"w.{c}"), i), F.lit(none)))
    windows = asked.join(per_anchor, "id").select(
        "id", "label", "vector", padded("low", 1).cast("array<long>").alias("low"), padded("high", 0).cast("array<long>").alias("high"))
    windows = materialise(windows, "windows")
    negatives = _join(block(narrowed(windows, False, m.negatives), "anchors-windows"), everything, False, m.negatives)
    return positives.join(negatives, ["anchor_id", "slot"]).select(
        "anchor_id", "positive_id", F.col("place").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))
