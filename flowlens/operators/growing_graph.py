"""Connected components of a graph whose edges arrive in batches.

Stored are ``vertices`` (id, component at the time it came; one folder per batch, never rewritten) and ``links``
(component, the component it is part of now; one row per component that was swallowed, a folder per version).  A batch looks
up the ends of its edges, replaces them by their present components, and runs the ordinary algorithm on what is left: a
graph no larger than the batch.  What it joins becomes links; only the link table, which has a row per union and not per
vertex, is written anew.  Reading follows one link per vertex.

A component is named by its least vertex.  A batch counts once its link table is complete (written last), so a batch that
failed half-way is simply run again, and edges given twice change nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.operators.graph import connected_components
from flowlens.runtime import materialise, scratch_scope

VERTICES, LINKS = "id string, component string", "old string, component string"


def _version(spark: SparkSession, path: str) -> int:
    """How many batches are complete."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(f"{path}/links")
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(at):
        return 0
    done = [int(s.getPath().getName().split("=")[1]) for s in fs.listStatus(at)
            if fs.exists(jvm.org.apache.hadoop.fs.Path(f"{path}/links/{s.getPath().getName()}/_SUCCESS"))]
    return max(done, default=0)


def _stored(spark: SparkSession, path: str, version: int) -> tuple[DataFrame, DataFrame]:
    if version == 0:
        return spark.createDataFrame([], VERTICES), spark.createDataFrame([], LINKS)
    batches = [f"{path}/vertices/batch={i}" for i in range(1, version + 1)]
    return spark.read.schema(VERTICES).parquet(*batches), spark.read.schema(LINKS).parquet(f"{path}/links/version={version}")


def _follow(named: DataFrame, links: DataFrame, column: str = "component") -> DataFrame:
    """``named`` with ``column`` replaced by what it is part of now; the links are joined by their stored size."""
    return named.join(links.select(F.col("old").alias(column), F.col("component").alias("_now")), column, "left").withColumn(
        column, F.coalesce("_now", column)).drop("_now")


def components(spark: SparkSession, path: str) -> DataFrame:
    """(id, component) of every vertex seen so far."""
    vertices, links = _stored(spark, path, _version(spark, path))
    return _follow(vertices, links).select("id", "component")


def add_edges(edges: DataFrame, path: str) -> int:
    """Add a batch of edges (src, dst); returns the number of batches stored.

    Its intermediate tables are deleted at the end, so the disk holds those of one batch at a time.
    """
    spark = edges.sparkSession
    version = _version(spark, path)
    vertices, links = _stored(spark, path, version)
    with scratch_scope(spark):
        given = edges.filter("src IS NOT NULL AND dst IS NOT NULL").select("src", "dst")
        if version == 0:  # nothing to look up, so every vertex is new and none is swallowed
            new, all_links = connected_components(given), links
        else:
            pairs = materialise(given.distinct(), "pairs", compression="zstd")
            ends = pairs.select(F.explode(F.array("src", "dst")).alias("id"))
            known = materialise(_follow(vertices.join(ends, "id", "left_semi"), links).select("id", "component"), "known", compression="zstd")
            at = lambda end: known.select(F.col("id").alias(end), F.col("component").alias(f"_{end}"))
            contracted = pairs.join(at("src"), "src", "left").join(at("dst"), "dst", "left").select(
                F.coalesce("_src", "src").alias("src"), F.coalesce("_dst", "dst").alias("dst")).distinct()
            joined = materialise(connected_components(contracted), "joined", compression="zstd")
            # what is left of known vertices are the names of their components
            old = materialise(known.select(F.col("component").alias("id")).distinct(), "old", compression="zstd")
            new = joined.join(old, "id", "left_anti")
            swallowed = materialise(joined.filter("id <> component").join(old, "id", "left_semi").select(
                F.col("id").alias("old"), "component"), "swallowed")
            # links that led to a swallowed component lead on to what swallowed it
            all_links = _follow(links, swallowed).select("old", "component").unionByName(swallowed)
        new.select("id", "component").write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/vertices/batch={version + 1}")
        all_links.write.mode("overwrite").parquet(f"{path}/links/version={version + 1}")
    return version + 1
