"""Running counts that fall when alerts are handled."""

import json

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from flowlens.streaming import ingest, jobs

SCHEMA = "id string, attack_cat string, status string, at long, is_update boolean"


def put(path, name, *rows):
    path.mkdir(exist_ok=True)
    (path / name).write_text("".join(json.dumps(dict(zip(["id", "attack_cat", "status", "at", "is_update"], r))) + "\n" for r in rows))


def test_counts_follow_the_updates(spark, tmp_path):
    topic, out, cp = tmp_path / "topic", f"{tmp_path}/out", f"{tmp_path}/cp"

    def run():
        events = ingest.decode_json(ingest.text_stream(spark, str(topic)), StructType.fromDDL(SCHEMA)).withColumn("at", F.timestamp_seconds(F.col("at") + 1_700_000_000))
        changes = jobs.drain(jobs.alert_changes(events), out, cp, transform=jobs.sum_of_batch)
        return {r.attack_cat: (r.n, r.pending) for r in jobs.sum_changes(changes).collect()}

    put(topic, "a.txt", ("1", "DoS", "pending", 0, False), ("2", "DoS", "pending", 0, False), ("3", "Worms", "handled", 0, False),
        ("9", None, "handled", 50, True), ("4", None, "pending", 0, False))
    assert run() == {"DoS": (2, 2), "Worms": (1, 0), None: (1, 1)}
    # handled; delivered again; an older update that comes late; an alert behind its update
    put(topic, "b.txt", ("1", None, "handled", 20, True), ("1", "DoS", "pending", 0, False), ("1", None, "pending", 10, True),
        ("9", "DoS", "pending", 0, False), ("x", None, "handled", 5, True))
    assert run() == {"DoS": (3, 1), "Worms": (1, 0), None: (1, 1)}
    put(topic, "c.txt", ("3", None, "pending", 30, True), ("1", None, "pending", 40, True))
    assert run() == {"DoS": (3, 2), "Worms": (1, 1), None: (1, 1)}


def test_sums_do_not_fall_below_zero(spark):
    changes = spark.createDataFrame([("DoS", 1, 1), ("DoS", 0, -1), ("DoS", 0, -1)], jobs.CHANGES)
    assert tuple(jobs.sum_changes(changes).first()) == ("DoS", 1, 0)
