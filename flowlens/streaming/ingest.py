"""Stream sources and message decoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlens.functions.columns import event_time
from flowlens.operators.clean import drop_labels

CORRUPT = "_corrupt_record"


def topic_stream(spark: SparkSession, servers: str, topic: str, starting: str = "latest",
                 max_per_trigger: int | None = None) -> DataFrame:
    """A Kafka topic; needs the Kafka connector of the running Spark version."""
    reader = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
              .option("subscribe", topic).option("startingOffsets", starting))
    if max_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    return reader.load()


def text_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A folder of message files, one message per line, in the same ``value`` column."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def table_stream(spark: SparkSession, path: str, schema: T.StructType,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """A growing Parquet table."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def decode_json(messages: DataFrame, schema: T.StructType, column: str = "value",
                keep_corrupt: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """Typed columns of JSON messages; a malformed message has only NULLs.

    With ``keep_corrupt`` its text is kept beside them, for a reject table.
    ``keep`` names columns of the message to carry along, such as its offset.
    """
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())]) if keep_corrupt else schema
    options = {"columnNameOfCorruptRecord": CORRUPT} if keep_corrupt else {}
    data = F.from_json(F.col(column).cast("string"), full, options).alias("data")
    return messages.select(*keep, data).select(*keep, "data.*")


def decode_flows(messages: DataFrame, schema: T.StructType, keep: tuple[str, ...] = ()) -> DataFrame:
    """Flow messages as rows: no answer columns, with their event time."""
    return drop_labels(decode_json(messages, schema, keep=keep)).withColumn("event_time", event_time("stime"))
