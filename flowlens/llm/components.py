"""Connected components by contraction: every round, vertices join their least neighbour and edges shrink."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.runtime import materialise

MAX_ROUNDS = 200


def connected_components(edges: DataFrame) -> DataFrame:
    """vertex, component (the least vertex reachable) of every vertex of ``edges`` (src, dst).

    A round gives each vertex the least of itself and its neighbours as parent, follows parents twice, and
    replaces the ends of every edge by their parents; edges inside a parent vanish.  A vertex that is not the
    least of its neighbourhood disappears, so rounds are few (logarithmic in the longest path).  All state is in
    written tables.  Ends are grouped with a map-side minimum; the joins are split by adaptive execution.
    """
    ends = edges.select("src", "dst").filter("src <> dst")
    ends = materialise(ends.unionByName(ends.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct(), "edges")
    found: DataFrame | None = None
    for _ in range(MAX_ROUNDS):
        if ends.isEmpty():
            break
        parents = materialise(ends.groupBy("src").agg(F.min("dst").alias("least")).select(
            F.col("src").alias("vertex"), F.least("src", "least").alias("component")), "parents")
        up = parents.select(F.col("vertex").alias("component"), F.col("component").alias("_up"))
        for _ in range(2):
            parents = parents.join(up, "component", "left").select("vertex", F.coalesce("_up", "component").alias("component"))
        parents = materialise(parents, "parents")
        at = lambda end: parents.select(F.col("vertex").alias(end), F.col("component").alias(f"_{end}"))
        ends = materialise(
            ends.join(at("src"), "src").join(at("dst"), "dst").filter("_src <> _dst")
            .select(F.col("_src").alias("src"), F.col("_dst").alias("dst")).distinct(), "edges")
        if found is None:
            found = parents
        else:
            step = parents.select(F.col("vertex").alias("component"), F.col("component").alias("_up"))
            found = materialise(found.join(step, "component", "left").select(
                "vertex", F.coalesce("_up", "component").alias("component")), "components")
    else:
        raise RuntimeError(f"components not settled after {MAX_ROUNDS} rounds")
    if found is None:
        return ends.select(F.col("src").alias("vertex"), F.col("dst").alias("component"))
    return found
