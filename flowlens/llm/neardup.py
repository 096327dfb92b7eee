"""Near-duplicates by fast similarity sketching, banding and exact verification.

1. Sketch.  A text's set of word shingles is hashed to 64 bits.  In round i < t every element is thrown into one
   of t bins with a value of that round; a bin keeps the value of its first round and the least in it.  Rounds go
   on until every bin is full; rounds t..2t-1 send all elements to bin i - t, so each coordinate fills.  Two
   sketches agree in a coordinate with probability equal to the Jaccard similarity, concentrated as with
   sampling with replacement, in O(t log t + n) instead of O(t n).
2. Classes.  Texts with the same set are one class, held by its least doc_id; only holders go on.
3. Bands.  42 bands of 6 coordinates (t = 256).  At similarity 0.85 a pair misses every band with probability
   (1 - 0.85**6)**42 = 2.3e-9.  Members of a band bucket are tied to its least member (a star, never all pairs), and
   the components of these ties are the candidate clusters; a link can only lie inside one.
4. Verification.  Every holder's text is sent once to its cluster and full sets are compared exactly, all pairs
   of the cluster inside the task by counting shared shingles.  A cluster above ``BLOCK_ROWS`` rows or
   ``BLOCK_BYTES`` bytes is split into blocks, each pair of blocks is a unit of work of its own, and only a
   spanning forest of the links of a unit leaves it.  Nothing is capped.
5. Components of the confirmed links; the least doc_id names the group.

Edge cases: null and empty texts have no words, an empty set, no links, and are their own component; fewer words than a shingle
make one shingle of all words; rows with the same doc_id are one document and share a component; rows without
doc_id are returned unlinked and kept, with a null component; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.llm.arrowtext import Texts, mix, parts_of, roller, texts_of, whole_windows, word_hashes, words_of
from flowlens.llm.components import connected_components
from flowlens.runtime import materialise

FULL = np.uint64((1 << 64) - 1)
BLOCK_ROWS = 1000
BLOCK_BYTES = 8 << 20


@dataclass(frozen=True)
class Near:
    width: int = 5
    percent: int = 85  # similarity in per cent
    bins: int = 256
    bands: int = 42
    rows: int = 6


@dataclass
class Sets:
    """Sorted distinct shingle hashes of every text, end to end."""

    values: np.ndarray
    first: np.ndarray

    def sizes(self) -> np.ndarray:
        return np.diff(self.first)


def shingle_sets(texts: Texts, width: int) -> Sets:
    words = words_of(texts)
    hashes = word_hashes(texts, words, roller(11), fold_case=True)
    found = roller(12).windows(hashes, width)
    inside = np.flatnonzero(whole_windows(words.first, width)[: len(found)])
    counts = words.counts()
    text_of_word = np.repeat(np.arange(len(texts)), counts)
    short = np.flatnonzero((counts > 0) & (counts < width))
    value = np.concatenate([found[inside], roller(13).spans(hashes, words.first[:-1][short], words.first[1:][short])])
    owner = np.concatenate([text_of_word[inside], short])
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    value, owner = value[new], owner[new]
    return Sets(value, np.searchsorted(owner, np.arange(len(texts) + 1)))


def fast_sketch(sets: Sets, bins: int) -> np.ndarray:
    """A row of ``bins`` coordinates per set; an empty set has FULL everywhere."""
    n = len(sets.first) - 1
    sketch = np.full((n, bins), FULL, np.uint64)
    flat = sketch.reshape(-1)
    seeds = np.random.default_rng(14).integers(1 << 63, size=2 * bins, dtype=np.uint64)
    owner = np.repeat(np.arange(n), sets.sizes())
    value = sets.values
    for i in range(bins):
        if not len(value):
            return sketch
        v = mix(value ^ seeds[i])
        place = owner * bins + (v % np.uint64(bins)).astype(np.int64)
        np.minimum.at(flat, place, (np.uint64(i) << np.uint64(55)) | (v >> np.uint64(9)))
        open_ = (sketch == FULL).any(axis=1)[owner]
        owner, value = owner[open_], value[open_]
    if len(value):
        for b in range(bins):
            gap = sketch[owner, b] == FULL
            late = (np.uint64(bins + b) << np.uint64(55)) | (mix(value[gap] ^ seeds[bins + b]) >> np.uint64(9))
            np.minimum.at(flat, owner[gap] * bins + b, late)
    return sketch


def band_keys(sketch: np.ndarray, near: Near) -> np.ndarray:
    used = mix(sketch[:, : near.bands * near.rows].reshape(len(sketch), near.bands, near.rows))
    factors = np.random.default_rng(15).integers(1 << 63, size=near.rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return mix((used * factors).sum(axis=2, dtype=np.uint64) + np.arange(1, near.bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def sketch_documents(docs: DataFrame, near: Near) -> DataFrame:
    """doc_id, n_shingles, two 64-bit hashes of the set, and the band keys (8 bytes each)."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in parts_of(batch, 1):
                sets = shingle_sets(texts, near.width)
                keys = band_keys(fast_sketch(sets, near.bins), near)
                names = [roller(seed).spans(sets.values, sets.first[:-1], sets.first[1:]).view(np.int64) for seed in (16, 17)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(sets.sizes(), pa.int64()), *map(pa.array, names),
                     pa.FixedSizeListArray.from_arrays(pa.array(keys.view(np.int64).reshape(-1)), near.bands).cast(pa.list_(pa.int64()))],
                    names=["doc_id", "n_shingles", "set_a", "set_b", "bands"])

    return docs.select("doc_id", "text").mapInArrow(
        work, "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>")


def shared_counts(sets: Sets) -> np.ndarray:
    """Sizes of all pairwise intersections, exactly."""
    m = len(sets.first) - 1
    owner = np.repeat(np.arange(m), sets.sizes())
    order = np.argsort(sets.values, kind="stable")  # owners stay sorted within a value
    value, owner = sets.values[order], owner[order]
    begin = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]])) if len(value) else np.empty(0, np.int64)
    often = np.diff(np.append(begin, len(value)))
    total = np.zeros((m, m), np.float32)  # whole numbers far below 2**24
    for d in range(2, min(16, m) + 1):
        rows = owner[begin[often == d][:, None] + np.arange(d)]
        if len(rows):
            for i in range(d):
                for j in range(i + 1, d):
                    np.add.at(total, (rows[:, i], rows[:, j]), 1)
    total += total.T
    dense = np.flatnonzero(often > 16)
    for chunk in np.array_split(dense, max(1, -(-len(dense) // 2048))):
        if len(chunk):
            length = often[chunk]
            entry = np.repeat(begin[chunk] - np.cumsum(length) + length, length) + np.arange(length.sum())
            has = np.zeros((m, len(chunk)), np.float32)
            has[owner[entry], np.repeat(np.arange(len(chunk)), length)] = 1
            total += has @ has.T
    np.fill_diagonal(total, 0)
    return total


def spanning_links(sets: Sets, percent: int) -> list[tuple[int, int]]:
    """Links that join what the pairs of sufficient similarity join: each set and the first of its component."""
    if len(sets.first) <= 2:
        return []
    size = sets.sizes()
    shared = shared_counts(sets).astype(np.int64)
    linked = (100 * shared >= percent * (size[:, None] + size[None, :] - shared)) & (shared > 0)
    links, seen = [], np.zeros(len(size), bool)
    for i in np.flatnonzero(linked.any(axis=1)):
        if not seen[i]:
            seen[i], edge = True, np.array([i])
            while len(edge):
                edge = np.flatnonzero(linked[edge].any(axis=0) & ~seen)
                seen[edge] = True
                links += [(int(i), int(j)) for j in edge]
    return links


def _clusters(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows of one unit (first column), which arrive next to each other."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        unit = batch.column(0).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(unit[1:] != unit[:-1]) + 1).tolist(), len(unit)]
        for start, end in zip(cuts, cuts[1:]):
            if end > start:
                if held and held[-1].column(0)[0].as_py() != unit[start]:
                    yield pa.Table.from_batches(held)
                    held = []
                held.append(batch.slice(start, end - start))
    if held:
        yield pa.Table.from_batches(held)


def confirmed_links(units: DataFrame, near: Near) -> DataFrame:
    """src, dst: links among the rows (unit, doc_id, text) of each unit, after full comparison."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _clusters(batches):
            ids = rows.column(1).to_numpy()
            links = spanning_links(shingle_sets(texts_of(rows.column(2)), near.width), near.percent)
            if links:
                pairs = ids[np.array(links)]
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["src", "dst"])

    return units.repartition("unit").sortWithinPartitions("unit").mapInArrow(work, "src long, dst long")


def candidate_units(sketched: DataFrame, docs: DataFrame) -> DataFrame:
    """(unit, doc_id, text) of the holders in candidate clusters; large clusters as pairs of blocks."""
    ties = sketched.select("doc_id", F.explode("bands").alias("key"))
    least = ties.groupBy("key").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")).filter("n > 1")
    stars = ties.join(least, "key").filter("doc_id <> least").select(F.col("least").alias("src"), F.col("doc_id").alias("dst"))
    members = connected_components(stars)
    texts = docs.filter("doc_id IS NOT NULL").select("doc_id", "text").join(
        members.withColumnRenamed("vertex", "doc_id"), "doc_id")
    sized = materialise(texts, "clusters")
    blocks = materialise(sized.groupBy("component").agg(
        F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).select("component", F.ceil(F.greatest(
            F.col("n") / BLOCK_ROWS, F.col("bytes") / BLOCK_BYTES)).cast("int").alias("blocks")), "blocks")
    placed = sized.join(blocks, "component").withColumn("block", F.pmod(F.xxhash64("doc_id"), "blocks").cast("int"))
    return placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        F.xxhash64("component", F.least("block", "other"), F.greatest("block", "other")).alias("unit"), "doc_id", "text")


def near_duplicates(docs: DataFrame, near: Near = Near()) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per row of ``docs``."""
    sketched = materialise(sketch_documents(docs, near), "sketches")
    named = sketched.filter("doc_id IS NOT NULL AND n_shingles > 0")
    holders = materialise(named.groupBy("set_a", "set_b", "n_shingles").agg(
        F.min("doc_id").alias("holder")), "holders")
    held = named.join(holders, ["set_a", "set_b", "n_shingles"])
    copies = held.filter("doc_id <> holder").select(F.col("holder").alias("src"), F.col("doc_id").alias("dst"))
    units = candidate_units(held.filter("doc_id = holder").select("doc_id", "bands"), docs)
    groups = connected_components(confirmed_links(units, near).unionByName(copies))
    return sketched.select("doc_id", "n_shingles").join(
        groups.withColumnRenamed("vertex", "doc_id"), "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
