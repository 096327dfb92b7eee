"""Streaming jobs: restart, late rows, redelivery, snapshots, inspection."""

import datetime as dt
import json

from pyspark.sql import functions as F

from flowlens.schema import event_schema, flow_schema
from flowlens.streaming import ingest, jobs

NOON = dt.datetime(2024, 1, 1, 12)


def put(path, name, *messages):
    path.mkdir(exist_ok=True)
    (path / name).write_text("".join(m if isinstance(m, str) else json.dumps(m) + "\n" for m in messages))


def events(spark, path, **kw):
    decoded = ingest.decode_json(ingest.text_stream(spark, str(path), **kw), event_schema())
    return decoded.withColumn("at", F.timestamp_seconds("timestamp"))


def event(i, minute, kind="scan"):
    return {"id": i, "event": kind, "severity": "low", "source_ip": "10.0.0.1",
            "timestamp": NOON.replace(tzinfo=dt.timezone.utc).timestamp() + 60 * minute}


def test_restart_neither_loses_nor_repeats(spark, tmp_path):
    topic, out, cp = tmp_path / "topic", f"{tmp_path}/out", f"{tmp_path}/cp"
    put(topic, "a.txt", event(1, 0), event(2, 1))
    assert jobs.drain(events(spark, topic), out, cp).count() == 2
    put(topic, "b.txt", event(3, 2))
    got = jobs.drain(events(spark, topic), out, cp)
    assert sorted(r.id for r in got.collect()) == [1, 2, 3]
    assert sorted(r.id for r in jobs.drain(events(spark, topic), out, cp).collect()) == [1, 2, 3]


def test_failed_batch_is_replayed(spark, tmp_path):
    topic, out, cp = tmp_path / "topic", f"{tmp_path}/out", f"{tmp_path}/cp"
    put(topic, "a.txt", event(1, 0))

    def broken(batch):
        batch.write.mode("overwrite").parquet(f"{out}/batch_id=0")
        raise RuntimeError("lost")

    query = jobs.start(events(spark, topic), out, cp, transform=broken, drain=True)
    try:
        query.awaitTermination()
        raise AssertionError("the batch should have failed")
    except Exception as error:
        assert "lost" in str(error)
    assert [r.id for r in jobs.drain(events(spark, topic), out, cp).collect()] == [1]


def test_late_rows_do_not_reopen_windows(spark, tmp_path):
    topic, out, cp = tmp_path / "topic", f"{tmp_path}/out", f"{tmp_path}/cp"

    def run():
        counts = jobs.windowed_stream_counts(events(spark, topic), "at", by=["event"])
        return {(r.window_start, r.event): r.n for r in jobs.drain(counts, out, cp).collect()}

    put(topic, "a.txt", event(1, 1), event(2, 2), event(3, 40))
    first = run()
    assert first == {(NOON, "scan"): 2}
    put(topic, "b.txt", event(4, 3), event(5, 60))
    assert run() == {**first, (NOON + dt.timedelta(minutes=40), "scan"): 1}


def test_redelivery_within_and_across_batches(spark, tmp_path):
    topic, out, cp = tmp_path / "topic", f"{tmp_path}/out", f"{tmp_path}/cp"
    put(topic, "a.txt", event(1, 1), event(1, 1), event(2, 2))
    jobs.drain(jobs.without_redelivery(events(spark, topic), "at", ["id"]), out, cp)
    put(topic, "b.txt", event(2, 2), event(3, 3))
    got = jobs.drain(jobs.without_redelivery(events(spark, topic), "at", ["id"]), out, cp)
    assert sorted(r.id for r in got.collect()) == [1, 2, 3]


def test_running_counts_grow(spark, tmp_path):
    topic, out, cp = tmp_path / "topic", f"{tmp_path}/out", f"{tmp_path}/cp"

    def run():
        alerts = events(spark, topic).select(F.col("event").alias("attack_cat"),
                                             F.when(F.col("id") > 1, "pending").otherwise("handled").alias("status"))
        jobs.drain(jobs.running_category_counts(alerts), out, cp, mode="complete")
        return {r.attack_cat: (r.n, r.pending) for r in jobs.last_snapshot(spark, out).collect()}

    put(topic, "a.txt", event(1, 0), event(2, 1, "dos"))
    assert run() == {"scan": (1, 0), "dos": (1, 1)}
    put(topic, "b.txt", event(3, 2))
    assert run() == {"scan": (2, 1), "dos": (1, 1)}


def test_malformed_message_and_answer_columns(spark, tmp_path):
    topic = tmp_path / "topic"
    put(topic, "a.txt", {"srcip": "a", "stime": 1421927414, "label": 1, "attack_cat": "DoS"}, "broken\n")
    decoded = ingest.decode_flows(ingest.text_stream(spark, str(topic)), flow_schema())
    assert "label" not in decoded.columns and "attack_cat" not in decoded.columns
    got = jobs.drain(decoded, f"{tmp_path}/out", f"{tmp_path}/cp").orderBy("stime").collect()
    assert got[0].srcip is None and got[0].event_time is None
    assert got[1].event_time == dt.datetime(2015, 1, 22, 11, 50, 14)


def test_peek_and_console(spark, tmp_path):
    topic = tmp_path / "topic"
    put(topic, "a.txt", *[event(i, i) for i in range(9)])
    got = jobs.peek(events(spark, topic), f"{tmp_path}/out", f"{tmp_path}/cp", rows=5, order=["id"])
    assert sorted(r.id for r in got.collect()) == [0, 1, 2, 3, 4]
    query = jobs.show(events(spark, topic))
    query.awaitTermination()
    assert query.exception() is None


def test_trigger_every_few_seconds(spark, tmp_path):
    topic, out = tmp_path / "topic", f"{tmp_path}/out"
    put(topic, "a.txt", event(1, 0))
    query = jobs.start(events(spark, topic), out, f"{tmp_path}/cp", trigger="1 second")
    query.processAllAvailable()
    put(topic, "b.txt", event(2, 0))
    query.processAllAvailable()
    query.stop()
    assert spark.read.parquet(out).count() == 2


def test_kafka_options_are_passed(spark):
    """Without the connector the source is named in the error; with it the stream has a binary value."""
    try:
        stream = ingest.topic_stream(spark, "broker:9092", "network_traffic", "earliest", 5)
        assert dict(stream.dtypes)["value"] == "binary"
    except Exception as error:
        assert "kafka" in str(error).lower()
