"""The three jobs of the system: prepare flows, train a detector, watch a stream.

    python -m flowlens.jobs prepare --flows 'hdfs:///raw/flows_*.csv' --out hdfs:///flows
    python -m flowlens.jobs train --data hdfs:///flows --model hdfs:///model
    python -m flowlens.jobs watch --data hdfs:///flows --model hdfs:///model \\
        --servers broker:9092 --topic network_traffic --alerts hdfs:///alerts --checkpoint hdfs:///checkpoint
"""

from __future__ import annotations

import argparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from flowlens.detection.detector import Detector, boosted_stages, fit_two_stage, forest_stages, load_detector
from flowlens.detection.report import evaluate_detector
from flowlens.functions.columns import is_attack
from flowlens.operators.alerts import alerts_from_predictions, detection_counts
from flowlens.operators.clean import clean_flows
from flowlens.operators.encode import category_codes
from flowlens.operators.evaluate import metrics_document
from flowlens.operators.profile import PROFILE_KEYS, TrafficProfile, enrich, fit_profile
from flowlens.operators.split import chronological_split, split_counts
from flowlens.runtime import get_spark, materialise, scratch_scope
from flowlens.schema import CATEGORICAL_FEATURES, flow_schema
from flowlens.sources.alert_store import AlertStore
from flowlens.sources.readers import read_flows, read_table
from flowlens.sources.writers import write_alerts, write_json_document, write_table
from flowlens.streaming import jobs as streams
from flowlens.streaming.ingest import CORRUPT, decode_flows, topic_stream


def prepare_flows(spark: SparkSession, paths: str | list[str], out: str, fraction: float = 0.8,
                  method: str = "approx", files: int | None = None) -> DataFrame:
    """Raw CSVs to enriched train and test tables and the learned averages; returns the row counts.

    The CSVs are parsed once, into columns; the time quantile and the averages
    then read only what they need.  Averages come from the train side alone.
    """
    raw = materialise(read_flows(spark, paths), "raw-flows")
    parts = chronological_split(raw, "stime", fraction, method)
    train, test = clean_flows(parts.train), clean_flows(parts.test)
    profile = fit_profile(train)
    for key, averages in profile.tables.items():
        write_table(averages, f"{out}/profile_{key}")
    write_table(enrich(train, profile), f"{out}/train", files=files)
    write_table(enrich(test, profile), f"{out}/test", files=files)
    return split_counts(raw, parts.threshold)


def read_profile(spark: SparkSession, data: str) -> TrafficProfile:
    """The averages ``prepare_flows`` learned."""
    return TrafficProfile({k: read_table(spark, f"{data}/profile_{k}") for k in PROFILE_KEYS})


def train_detector(spark: SparkSession, data: str, model: str, kind: str = "forest",
                   cap_per_class: int | None = None, **sizes: int) -> DataFrame:
    """Fit a two-stage detector on prepared tables, save it with its report; returns the verdict."""
    stages = {"forest": forest_stages, "boosted": boosted_stages}[kind](**sizes)
    train, test = (read_table(spark, f"{data}/{side}") for side in ("train", "test"))
    detector = fit_two_stage(train, stages, cap_per_class=cap_per_class)
    detector.save(f"{model}/pipeline")
    report = evaluate_detector(detector, train, test)
    scored = detector.score(test).withColumn("is_attack", is_attack("attack_cat"))
    write_json_document(metrics_document(
        scored, detector.classes, "attack_cat", "predicted_class", stage1="predicted_attack", stage2="stage2_class",
        score="attack_probability"), f"{model}/metrics")
    for name, part in (("test_figures", report.test), ("train_figures", report.train), ("verdict", report.verdict),
                       ("confusion", report.confusion), ("confused_pairs", report.confused_pairs), ("importances", report.importances),
                       ("category_codes", category_codes(train, CATEGORICAL_FEATURES))):
        if part is not None:
            write_json_document(part, f"{model}/{name}")
    write_json_document(report.per_class, f"{model}/class_report")
    write_json_document(detector.class_table(spark), f"{model}/classes")
    write_json_document(detector.feature_table(spark), f"{model}/features")
    return report.verdict


MESSAGE = "_message"
PLACE = ("topic", "partition", "offset")


def score_messages(messages: DataFrame, detector: Detector, profile: TrafficProfile, keep: tuple[str, ...] = ()) -> DataFrame:
    """Flow messages to scored rows: decoded, cleaned, enriched like the training data."""
    rows = decode_flows(messages, flow_schema(), keep=keep)
    return detector.score(enrich(clean_flows(rows, drop=[]), profile))


def split_rejects(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Messages that can be decoded, and those that can not (nothing but NULLs, or broken JSON)."""
    parsed = F.from_json(F.col("value").cast("string"), StructType([StructField(CORRUPT, StringType())]),
                         {"columnNameOfCorruptRecord": CORRUPT})
    broken = parsed.isNull() | parsed[CORRUPT].isNotNull()
    return messages.filter(~broken), messages.filter(broken)


def alerts_by_message(messages: DataFrame, detector: Detector, profile: TrafficProfile, now: Column) -> tuple[DataFrame, DataFrame]:
    """Scored rows and alerts of readable messages; the id of an alert is the place or the text of its message."""
    scored = materialise(score_messages(messages, detector, profile, (MESSAGE,)), "scored")
    seen = F.coalesce(F.col("event_time"), now)
    return scored, alerts_from_predictions(scored, category="predicted_class", source="streaming", now=seen, identity=[MESSAGE])


def watch(messages: DataFrame, detector: Detector, profile: TrafficProfile, alerts: str, checkpoint: str,
          drain: bool = False, known_days: int | None = None) -> StreamingQuery:
    """Write an alert for every attack in a message stream, every five seconds or until drained.

    A message delivered again within the watermark is dropped.  Per micro-batch the
    store gets its alerts, ``<alerts>_rejects`` the messages that can not be read, and
    ``<alerts>_counts`` the numbers of records and attacks; a replayed batch replaces all
    three.  With ``known_days`` the alerts go to an ``AlertStore``, where they can be updated and followed, and an alert
    that is stored already in one of the newest so many days is not added again, however late its message comes back;
    the counts still tell of every message taken in.  The intermediate tables of a batch are deleted after it.
    """
    store = None if known_days is None else AlertStore(messages.sparkSession, alerts)
    place = [F.col(c).cast("string") for c in PLACE if c in messages.columns]
    told = messages.select(
        F.col("value").cast("string").alias("value"), F.current_timestamp().alias("arrived"),
        F.sha2(F.concat_ws("\n", *place) if place else F.coalesce(F.col("value").cast("string"), F.lit("")), 256).alias(MESSAGE))

    def write(batch: DataFrame, batch_id: int) -> None:
        with scratch_scope(batch.sparkSession):
            stored = materialise(batch, "messages")
            good, bad = split_rejects(stored)
            scored, found = alerts_by_message(good, detector, profile, stored.agg(F.max("arrived")).scalar())
            name = f"stream-{batch_id}"
            if store:
                store.append(found, name, known_days)
            else:
                write_alerts(found, alerts, name)
            write_alerts(bad.select("value", F.col("arrived").alias("timestamp")), f"{alerts}_rejects", name)
            counts = detection_counts(scored.withColumn("batch_id", F.lit(batch_id)), flag="predicted_attack")
            counts.write.mode("overwrite").parquet(f"{alerts}_counts/batch={batch_id}")

    fresh = streams.without_redelivery(told, "arrived", [MESSAGE])
    writer = fresh.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    return (writer.trigger(availableNow=True) if drain else writer.trigger(processingTime=streams.TRIGGER)).start()


def main() -> None:
    parser = argparse.ArgumentParser(description="flow preparation, training and watching")
    commands = parser.add_subparsers(dest="command", required=True)
    prepare = commands.add_parser("prepare")
    prepare.add_argument("--flows", nargs="+", required=True)
    prepare.add_argument("--out", required=True)
    prepare.add_argument("--fraction", type=float, default=0.8)
    prepare.add_argument("--method", choices=["approx", "exact"], default="approx")
    prepare.add_argument("--files", type=int)
    train = commands.add_parser("train")
    train.add_argument("--data", required=True)
    train.add_argument("--model", required=True)
    train.add_argument("--kind", choices=["forest", "boosted"], default="forest")
    train.add_argument("--cap-per-class", type=int)
    look = commands.add_parser("watch")
    for name in ("data", "model", "servers", "topic", "alerts", "checkpoint"):
        look.add_argument(f"--{name}", required=True)
    look.add_argument("--starting", choices=["latest", "earliest"], default="latest")
    look.add_argument("--known-days", type=int, help="keep alerts in a store, without those it has had in so many days")
    args = parser.parse_args()

    spark = get_spark(f"flowlens-{args.command}")
    if args.command == "prepare":
        prepare_flows(spark, args.flows, args.out, args.fraction, args.method, args.files).show()
    elif args.command == "train":
        train_detector(spark, args.data, args.model, args.kind, args.cap_per_class).show()
    else:
        watch(topic_stream(spark, args.servers, args.topic, args.starting), load_detector(f"{args.model}/pipeline"),
              read_profile(spark, args.data), args.alerts, args.checkpoint, known_days=args.known_days).awaitTermination()


if __name__ == "__main__":
    main()
