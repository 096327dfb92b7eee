"""From raw documents to token ids: the stages of a training-data pipeline, each written and read again.

Every stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept.  All but the last return
the columns of ``documents``.  SQL can express neither the robust estimate nor the sketches, the network or the merges,
so there is no SQL twin; ``tests/llm/test_pipeline.py`` composes brute-force versions instead.

Null texts count as empty and fall to the base rules; null languages and sources are values of their own; repeated rows and
rows that share a doc_id are judged row by row; a text of any length is read whole; columns beyond those of ``documents``
are left behind; an empty table gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.llm import bpe, neardup, outliers, secrets, templates
from flowlens.runtime import materialise

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
MARK = "<secret>"


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are no outliers of their language and source."""
    return outliers.quality_rules(docs.select(*COLUMNS)).filter("kept").select(*COLUMNS)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every group of near-duplicates (five words, similarity 0.8): the one with the least doc_id.

    Rows are numbered first and compared as rows, whatever their doc_id: of equal rows one stays, and texts that share
    a doc_id but are not alike stay both.  Rows without doc_id come after the others; ties go to the row read first.
    """
    rows = materialise(docs.select(*COLUMNS).withColumn("_row", F.monotonically_increasing_id()), "numbered")
    named = rows.select(F.col("_row").alias("doc_id"), "text")
    groups = materialise(neardup.near_duplicates(named, neardup.Near(percent=80)).select(
        F.col("doc_id").alias("_row"), F.col("component_id").alias("_group")), "groups")
    several = groups.filter("_row <> _group").select("_group").distinct()
    members = materialise(groups.join(several, "_group", "left_semi").join(rows.select("_row", "doc_id"), "_row"), "members")
    stays = members.groupBy("_group").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_row")).getField("_row").alias("_row"))
    dropped = materialise(members.select("_row").join(stays, "_row", "left_anti"), "dropped")
    return rows.join(dropped, "_row", "left_anti").select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return templates.find_contamination(docs.select(*COLUMNS), items).filter(F.size("hits") == 0).select(*COLUMNS)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with its secrets replaced by ``MARK``; n_chars follows where a text has changed."""
    found = secrets.scan_secrets(docs.select(*COLUMNS), mark=MARK)
    return found.withColumn("n_chars", F.when(F.col("spans") == "", F.col("n_chars")).otherwise(
        F.length("text").cast("long"))).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (4 bytes each, little-endian) with their count, and digests of ids and decoded text."""
    encoded = bpe.encode_texts(docs.select("doc_id", "lang", "source", "text"),
                               public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return encoded.select(
        "doc_id", "lang", "source", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids",
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality rules", keep_quality), ("near-duplicates", keep_one_of_each), ("decontamination", drop_contaminated),
    ("secrets", redact_secrets), ("token ids", encode),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
