"""Batch readers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.schema import flow_schema


def read_flows(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Headerless flow CSVs with the fixed layout; an unreadable cell is NULL."""
    return spark.read.schema(flow_schema()).option("mode", "PERMISSIVE").csv(paths, header=False)


def read_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """CSV with a header and inferred types, for exploration."""
    return spark.read.csv(path, header=True, inferSchema=True)


def read_named_csv(spark: SparkSession, path: str | list[str], names: DataFrame,
                   name_column: str = "Name", position: str = "No.") -> DataFrame:
    """Headerless CSV whose column names are the rows of a description table, in the order of ``position``."""
    columns = [r[0].strip() for r in names.orderBy(F.col(f"`{position}`").cast("long")).select(name_column).toLocalIterator()]
    rows = spark.read.csv(path, header=False, inferSchema=True)
    if len(columns) != len(rows.columns):
        raise ValueError(f"{len(columns)} column names for {len(rows.columns)} columns of {path}")
    return rows.toDF(*columns)


def read_table(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Parquet table."""
    return spark.read.parquet(*([path] if isinstance(path, str) else path))


def read_partition(spark: SparkSession, path: str, column: str = "label", value=1) -> DataFrame:
    """The rows of one partition value; other partitions are never opened."""
    return spark.read.parquet(path).filter(F.col(column) == F.lit(value))


def read_alerts_since(spark: SparkSession, path: str, since: Column) -> DataFrame:
    """Stored alerts from ``since`` on; folders of earlier days are not opened."""
    return spark.read.parquet(path).filter(
        (F.col("day") >= F.to_date(since)) & (F.col("timestamp") >= since)).drop("day", "batch_id")


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Model-metrics document, nested or old flat layout, as one nested row.

    In the flat layout the figures belong to stage 1.  Absent figures are 0.
    """
    stage1 = ["accuracy", "precision", "recall", "f1", "auc_roc"]
    overall = ["accuracy", "macro_f1", "weighted_f1"]
    fields = ", ".join(f"{m}: double" for m in dict.fromkeys([*stage1, *overall]))
    nested = ", ".join(f"{s} struct<{fields}>" for s in ("stage1", "stage2", "overall"))
    flat = fields.replace(":", "")
    doc = spark.read.schema(f"{nested}, {flat}").json(path, multiLine=True)

    def figure(section: str, name: str):
        held = [F.col(f"{section}.{name}")] + ([F.col(name)] if section == "stage1" else [])
        return F.coalesce(*held, F.lit(0.0)).alias(name)

    return doc.select(
        F.struct(*[figure("stage1", m) for m in stage1]).alias("stage1"),
        F.struct(*[figure("stage2", m) for m in overall]).alias("stage2"),
        F.struct(*[figure("overall", m) for m in overall]).alias("overall"),
    )
