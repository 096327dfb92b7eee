"""The watch job with an alert store: late re-delivery, updates in between, no tables left behind."""

import json

import pytest
from pyspark.sql import functions as F

from flowlens import jobs
from flowlens.runtime import path_names, scratch_home
from flowlens.sources.alert_store import AlertStore
from flowlens.streaming.ingest import text_stream

DAY = 86_400


@pytest.fixture
def rule(monkeypatch):
    """Flows of more than 100 bytes are attacks; the model itself is tested elsewhere."""

    def score(messages, detector, profile, keep=()):
        value = F.from_json("value", "sbytes int, stime long")
        return messages.select(*keep, value.sbytes.alias("sbytes"), F.timestamp_seconds(value.stime).alias("event_time")).withColumns({
            "attack_probability": F.when(F.col("sbytes") > 100, 0.9).otherwise(0.1),
            "predicted_attack": (F.col("sbytes") > 100).cast("int"), "predicted_class": F.lit("DoS")})
    monkeypatch.setattr(jobs, "score_messages", score)


def test_alerts_are_stored_once(spark, tmp_path, rule):
    topic, alerts = tmp_path / "topic", f"{tmp_path}/alerts"
    topic.mkdir()

    def send(name, *flows):
        (topic / name).write_text("".join(json.dumps({"sbytes": b, "stime": 1_700_000_000 + t}) + "\n" for b, t in flows))

    def watch(checkpoint):
        jobs.watch(text_stream(spark, str(topic)), None, None, alerts, f"{tmp_path}/{checkpoint}", drain=True, known_days=30).awaitTermination()

    send("a.txt", (500, 0), (600, DAY), (50, 0))
    watch("cp")
    store = AlertStore(spark, alerts)
    first = {r.id for r in store.read().collect()}
    assert len(first) == 2
    store.update(spark.createDataFrame([(min(first), "handled", "me", None)], "id string, status string, resolved_by string, resolved_at timestamp"), 0)
    send("b.txt", (500, 0), (700, 2 * DAY))
    watch("cp")
    # a batch number the store has had is a replay
    before = store.version()
    store.append(store.read().limit(0), "stream-1")
    assert store.version() == before
    found = {r.id: r.status for r in store.read().collect()}
    assert len(found) == store.read().count() == 3 and found[min(first)] == "handled"
    assert [r.id for r in store.since(1).filter("arrival > 1").collect()] == [i for i in found if i not in first]
    counts = spark.read.parquet(f"{alerts}_counts").agg(F.sum("total_records"), F.sum("attacks_detected")).first()
    assert counts[0] in (4, 5)  # the copy is one of the records unless the watermark knows it still
    assert not [n for n in path_names(spark, scratch_home(spark)) if n.startswith("scope-")]


def test_redelivery_that_no_state_remembers(spark, tmp_path, rule):
    topic, alerts = tmp_path / "topic", f"{tmp_path}/alerts"
    topic.mkdir()
    line = json.dumps({"sbytes": 500, "stime": 1_700_000_000}) + "\n"
    (topic / "a.txt").write_text(line)
    store = AlertStore(spark, alerts)
    scored = spark.createDataFrame([(line.strip(),)], "value string").withColumn(jobs.MESSAGE, F.sha2("value", 256))
    _, found = jobs.alerts_by_message(scored, None, None, F.lit("2023-11-15").cast("timestamp"))
    store.append(found, "earlier")
    jobs.watch(text_stream(spark, str(topic)), None, None, alerts, f"{tmp_path}/cp", drain=True, known_days=30).awaitTermination()
    assert store.read().count() == 1
    assert spark.read.parquet(f"{alerts}_counts").agg(F.sum("attacks_detected")).first()[0] == 1
