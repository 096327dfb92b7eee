"""Batch writers and message encoding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.operators.sequence import with_tie_break


def write_table(df: DataFrame, path: str, overwrite: bool = True, files: int | None = None,
                partition_by: list[str] | None = None, range_by: list[str] | None = None) -> None:
    """Write Parquet; failures raise.

    ``files`` spreads the rows over that many files.  With ``range_by`` each
    file holds one range of those columns, so later filters skip whole files;
    a value that very many rows share is spread over several files.
    """
    out = df
    if range_by:
        keys = [*range_by, "_tie"]
        out = with_tie_break(df)
        out = out.repartitionByRange(files, *keys) if files else out.repartitionByRange(*keys)
        out = out.sortWithinPartitions(*keys).drop("_tie")
    elif files:
        out = out.repartition(files)
    writer = out.write.mode("overwrite" if overwrite else "errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def as_messages(df: DataFrame, order: list[Column | str] | None = ("stime",)) -> DataFrame:
    """Rows as JSON text in ``value``, in numeric time order, ready for a topic or text sink.

    Rows of one time may be sorted by several tasks.
    """
    ordered = with_tie_break(df).orderBy(*order, "_tie") if order else df
    return ordered.select(F.to_json(F.struct(*df.columns)).alias("value"))


def write_json_document(df: DataFrame, path: str, overwrite: bool = True) -> None:
    """Write a one-row document (metrics, class map) as JSON."""
    df.write.mode("overwrite" if overwrite else "errorifexists").json(path)


def write_alerts(alerts: DataFrame, path: str, batch: str) -> None:
    """Write the alerts of one batch to the store: a folder per day, and in it one per batch.

    Writing a batch again replaces it, so streams and ingest jobs can be replayed.
    Days come first, so recent alerts are found without a full scan.
    """
    (alerts.withColumns({"day": F.to_date("timestamp"), "batch_id": F.lit(batch)})
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day", "batch_id").parquet(path))


def send_messages(messages: DataFrame, servers: str, topic: str, key: str | None = None) -> None:
    """Write ``as_messages`` rows to a Kafka topic; needs the Kafka connector of the running Spark version."""
    value = F.col("value").cast("string").alias("value")
    rows = messages.select(F.col(key).cast("string").alias("key"), value) if key else messages.select(value)
    rows.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()
