"""The graph of addresses: vertices, edges, degrees, components, shortest paths.

A hub may touch a third of all edges, so joins on a vertex go through
``join_on_hubs``, which spreads the rows of a hub over several tasks.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from flowlens.operators.clean import with_endpoints
from flowlens.runtime import materialise

ROWS_PER_SPLIT = 1_000_000
MOST_HUBS = 10_000
ROWS_PER_TASK = 250_000


def graph_edges(flows: DataFrame) -> DataFrame:
    """One edge per flow, duplicates and label kept."""
    return with_endpoints(flows).select(
        F.col("srcip").alias("src"), F.col("dstip").alias("dst"), "label")


def graph_vertices(flows: DataFrame) -> DataFrame:
    """Every address that occurs as a source or a destination."""
    ends = with_endpoints(flows).select(F.explode(F.array("srcip", "dstip")).alias("id"))
    return ends.distinct()


def graph_size(flows: DataFrame) -> DataFrame:
    """Number of vertices and of edges."""
    vertices = graph_vertices(flows).agg(F.count("*").alias("n_vertices"))
    return vertices.select(
        "n_vertices", with_endpoints(flows).agg(F.count("*")).scalar().alias("n_edges"))


def degrees(edges: DataFrame) -> DataFrame:
    """Out-, in- and total degree per vertex, from one shuffle."""
    ends = edges.select(F.explode(F.array(
        F.struct(F.col("src").alias("id"), F.lit(1).alias("o"), F.lit(0).alias("i")),
        F.struct(F.col("dst").alias("id"), F.lit(0).alias("o"), F.lit(1).alias("i")),
    )).alias("e")).select("e.*")
    return ends.groupBy("id").agg(
        F.sum("o").alias("out_degree"), F.sum("i").alias("in_degree"),
        F.sum(F.col("o") + F.col("i")).alias("degree"))


def join_on_hubs(rows: DataFrame, table: DataFrame, key: str, weight: str,
                 rows_per_split: int = ROWS_PER_SPLIT) -> DataFrame:
    """Inner join of ``rows`` with a table that has one row per ``key``.

    ``table[weight]`` tells how many rows share the key.  Keys above
    ``rows_per_split`` are spread: their rows get one of several salts and
    their table row is repeated per salt, so no task meets more than about
    ``rows_per_split`` rows of a key.  The bound grows with the total weight, so
    that there are never more than ``MOST_HUBS`` such keys to broadcast.
    """
    total = table.agg(F.sum(weight)).first()[0] or 0
    rows_per_split = max(rows_per_split, -(-int(total) // MOST_HUBS))
    splits = F.greatest(F.lit(1), F.ceil(F.col(weight) / rows_per_split)).cast("int")
    hubs = table.filter(F.col(weight) > rows_per_split).select(key, splits.alias("_splits"))
    salted = (
        rows.join(F.broadcast(hubs), key, "left")
        .withColumn("_salt", F.pmod(F.xxhash64(*rows.columns), F.coalesce("_splits", F.lit(1))).cast("int"))
        .drop("_splits")
    )
    repeated = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), splits - 1)))
    return salted.join(repeated, [key, "_salt"]).drop("_salt")


def _neighbourhoods(links: DataFrame) -> DataFrame:
    """Per vertex: its least neighbour and how many neighbours lie below and above it."""
    ends = links.select(F.explode(F.array(
        F.struct(F.col("hi").alias("v"), F.col("lo").alias("other"), F.lit(1).alias("below")),
        F.struct(F.col("lo").alias("v"), F.col("hi").alias("other"), F.lit(0).alias("below")),
    )).alias("e")).select("e.*")
    return ends.groupBy("v").agg(
        F.min("other").alias("least"), F.sum("below").alias("n_below"),
        F.sum(1 - F.col("below")).alias("n_above"))


def _least_labels(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Per vertex 0 .. n - 1 the least vertex that the edges (a, b) connect it with."""
    label = np.arange(n)
    while len(a):
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up
        a, b = label[a], label[b]
        a, b = a[a != b], b[a != b]
    return label


def _stars(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    """Every end of the pairs in ``batches`` with the least vertex they connect it with."""
    n = sum(len(batch) for batch in batches)
    ends = pa.concat_arrays([batch.column(c) for c in ("hi", "lo") for batch in batches]).dictionary_encode()
    order = pc.array_sort_indices(ends.dictionary)  # by bytes, as Spark compares text
    place = np.empty(len(order), np.int64)
    place[order.to_numpy()] = np.arange(len(order))
    code = place[ends.indices.to_numpy()]
    names = ends.dictionary.take(order)
    return pa.RecordBatch.from_arrays([names, names.take(pa.array(_least_labels(code[:n], code[n:], len(names))))], names=["id", "root"])


def _stars_of_ranges(pairs: DataFrame, rows_per_task: int) -> DataFrame:
    """(id, root): per range of pairs, each vertex and the least one that the pairs of the range connect it with.

    A task holds at most about ``rows_per_task`` pairs at once, whatever the ranges hold.
    """
    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if held and sum(len(h) for h in held) + len(batch) > 2 * rows_per_task:
                yield _stars(held)
                held = []
            held.append(batch)
        if held:
            yield _stars(held)

    tasks = max(1, -(-pairs.count() // rows_per_task))
    kind = pairs.schema["hi"].dataType
    made = StructType([StructField("id", kind), StructField("root", kind)])
    return materialise(pairs.repartitionByRange(tasks, "lo", "hi").mapInArrow(work, made), "stars", compression="zstd")


def connected_components(edges: DataFrame, max_rounds: int = 100, rows_per_split: int = ROWS_PER_SPLIT,
                         rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """(id, component) with the least address of the component as its name.

    Pairs are cut into ranges of their names and each task reduces its range to stars.  Addresses with
    a common beginning (a net, a day) lie in one range, so where they talk to each other mostly only few
    vertices stand in several stars.  The least addresses of those stars are linked and the links, far fewer
    than the pairs then, joined by alternating steps; without such a beginning they are no more than the pairs.
    """
    pairs = materialise(
        edges.filter("src is not null and dst is not null")
        .select(F.greatest("src", "dst").alias("hi"), F.least("src", "dst").alias("lo")).distinct(), "pairs", compression="zstd")
    stars = _stars_of_ranges(pairs, rows_per_task)
    named = materialise(stars.groupBy("id").agg(F.min("root").alias("root"), F.max("root").alias("last")), "named", compression="zstd")
    shared = named.filter("root <> last").select("id", F.col("root").alias("lo"))
    if shared.isEmpty():
        return named.select("id", F.col("root").alias("component"))
    links = materialise(
        stars.withColumnRenamed("root", "hi").join(shared, "id").filter("hi <> lo").select("hi", "lo").distinct(), "links")
    # few where ranges hold whole components, so joined by their stored size
    moved = materialise(_joined_links(links, max_rounds, rows_per_split).filter("id <> component")
                        .withColumnRenamed("id", "root"), "moved")
    return named.join(moved, "root", "left").select("id", F.coalesce("component", "root").alias("component"))


def _joined_links(links: DataFrame, max_rounds: int, rows_per_split: int) -> DataFrame:
    """(id, component) of the ends of ``links`` (hi, lo).

    Alternating large-star and small-star steps (Kiveris et al., SoCC 2014):
    each round hooks neighbours to the least address around them until every
    component is a star.  The number of rounds grows with the logarithm of the
    graph, not with its diameter.  Links are written each round, so the plan
    does not grow.
    """
    for _ in range(max_rounds):
        around = materialise(_neighbourhoods(links), "around")
        if around.filter("n_below > 1 or (n_below = 1 and n_above > 0)").isEmpty():
            break
        # large-star: neighbours above a vertex move to the least address around it
        lowest = around.select(F.col("v").alias("lo"), F.least("v", "least").alias("root"), "n_above")
        large = materialise(
            join_on_hubs(links, lowest, "lo", "n_above", rows_per_split)
            .select("hi", F.col("root").alias("lo")).distinct(), "large-star")
        # small-star: a vertex and its lower neighbours move to the least of them
        roots = materialise(large.groupBy("hi").agg(F.min("lo").alias("root"), F.count("*").alias("n")), "roots")
        links = materialise(
            join_on_hubs(large, roots, "hi", "n", rows_per_split)
            .select(F.explode(F.array("hi", "lo")).alias("hi"), F.col("root").alias("lo"))
            .filter("hi <> lo").distinct(), "small-star")
    else:
        raise RuntimeError(f"components not stable after {max_rounds} rounds")
    return around.select(
        F.col("v").alias("id"), F.when(F.col("n_below") == 1, F.col("least")).otherwise(F.col("v")).alias("component"))


def shortest_paths(edges: DataFrame, source: str, directed: bool = True, max_depth: int | None = None,
                   rows_per_split: int = ROWS_PER_SPLIT) -> DataFrame:
    """(id, distance, via): hops from ``source`` and the least predecessor on a shortest path.

    Breadth-first: each round joins the newly reached vertices with the edges
    and keeps the ends not seen before, until a round finds none.  ``max_depth``
    asks for the vertices within so many hops only.  Edges that do not start in
    the frontier are dropped before the shuffle of a hop.
    """
    spark = edges.sparkSession
    steps = edges.select("src", "dst")
    if not directed:
        steps = steps.select(F.explode(F.array(
            F.struct("src", "dst"), F.struct(F.col("dst").alias("src"), F.col("src").alias("dst"))
        )).alias("e")).select("e.*")
    steps = materialise(steps.filter("src is not null and dst is not null and src <> dst").distinct(), "steps")
    fan_out = materialise(steps.groupBy("src").agg(F.count("*").alias("n")), "fan-out")
    schema = "id string, distance int, via string"
    reached = spark.createDataFrame([(source, 0, None)], schema)
    level = reached
    for hop in count(1) if max_depth is None else range(1, max_depth + 1):
        frontier = materialise(fan_out.join(level.select(F.col("id").alias("src")), "src"), "frontier")
        found = (
            join_on_hubs(steps.join(frontier.select("src"), "src", "left_semi"), frontier, "src", "n", rows_per_split)
            .groupBy(F.col("dst").alias("id")).agg(F.min("src").alias("via"))
            .join(reached.select("id"), "id", "left_anti")
            .select("id", F.lit(hop).alias("distance"), "via")
        )
        level = materialise(found, "level")
        if level.isEmpty():
            break
        reached = reached.unionByName(level)
        if hop % 16 == 0:  # keep the plan of a long walk short
            reached = materialise(reached, "reached")
    return reached
