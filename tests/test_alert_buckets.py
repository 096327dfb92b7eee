"""Alerts that share a call and a state."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from flowlens.streaming import ingest, jobs

SCHEMA = "id string, attack_cat string, status string, at long, is_update boolean"
DAY = 86_400


def put(path, name, rows):
    path.mkdir(exist_ok=True)
    (path / name).write_text("".join(json.dumps(dict(zip(["id", "attack_cat", "status", "at", "is_update"], r))) + "\n" for r in rows))


@pytest.mark.parametrize("buckets", [1, 3])
def test_alerts_of_one_bucket(spark, tmp_path, buckets):
    topic, out, cp = tmp_path / "topic", f"{tmp_path}/out", f"{tmp_path}/cp"

    def run():
        events = ingest.decode_json(ingest.text_stream(spark, str(topic)), StructType.fromDDL(SCHEMA)).withColumn(
            "at", F.timestamp_seconds(F.col("at") + 1_700_000_000))
        changes = jobs.drain(jobs.alert_changes(events, buckets=buckets), out, cp, transform=jobs.sum_of_batch)
        return {r.attack_cat: (r.n, r.pending) for r in jobs.sum_changes(changes).collect()}

    many = [(str(i), "DoS" if i % 2 else "Worms", "pending", i, False) for i in range(60)]
    put(topic, "a.txt", [*many, *many, (None, None, "pending", 5, False)])
    assert run() == {"DoS": (30, 30), "Worms": (30, 30), None: (1, 1)}
    # every third is handled, some twice; one update comes before its alert
    put(topic, "b.txt", [(str(i), None, "handled", 100 + i, True) for i in range(0, 60, 3)] * 2 + [("late", None, "handled", 7, True)])
    assert run() == {"DoS": (30, 20), "Worms": (30, 20), None: (1, 1)}
    # days later: handled ones may be dropped, pending ones and waiting updates stay in the same bucket
    put(topic, "c.txt", [("new", "DoS", "pending", 4 * DAY, False)])
    assert run()["DoS"] == (31, 21)
    put(topic, "d.txt", [("1", None, "handled", 4 * DAY, True), ("late", "DoS", "pending", 4 * DAY, False)])
    assert run() == {"DoS": (32, 20), "Worms": (30, 20), None: (1, 1)}


def test_one_call_for_many_alerts(spark, tmp_path):
    put(tmp_path / "topic", "a.txt", [(str(i), "DoS", "pending", i, False) for i in range(5)])
    events = ingest.decode_json(ingest.text_stream(spark, str(tmp_path / "topic")), StructType.fromDDL(SCHEMA)).withColumn("at", F.timestamp_seconds("at"))
    grouped = jobs.alert_changes(events)._jdf.queryExecution().analyzed().toString()
    assert "[_bucket#" in grouped
