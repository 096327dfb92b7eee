"""Alert operators on hand-made rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from flowlens.functions import columns as fx
from flowlens.operators import alerts as ops
from flowlens.schema import alert_schema

DDL = ("id string, attack_cat string, confidence double, threat_score int, status string, resolved_by string,"
       " resolved_at timestamp, source string, timestamp timestamp")
NOON = dt.datetime(2024, 1, 1, 12)


def make(spark, *rows):
    full = [(i, cat, 0.5, score, status, None, None, source, t) for i, cat, score, status, source, t in rows]
    return spark.createDataFrame(full, DDL)


@pytest.fixture
def alerts(spark):
    return make(
        spark,
        ("1", "DoS", 95, "pending", "external", NOON), ("2", "Normal", 5, "pending", None, NOON),
        ("3", None, 40, "handled", "feed", NOON - dt.timedelta(minutes=10)),
        ("4", "DoS", 70, None, "streaming", NOON - dt.timedelta(minutes=11)),
    )


def ids(df):
    return [r.id for r in df.collect()]


def test_buckets(spark):
    scores = [0, 39, 40, 69, 70, 89, 90, 100, 101, -1, None]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(scores)], "i int, threat_score int")
    got = [r.b for r in df.select("i", fx.threat_bucket().alias("b")).orderBy("i").collect()]
    assert got == ["[0,40) Low"] * 2 + ["[40,70) Medium"] * 2 + ["[70,90) High"] * 2 + ["[90,101) Critical"] * 2 \
        + ["Unknown"] * 3
    ten = [r.b for r in df.select("i", fx.upper_bound_bucket("threat_score", fx.DECILE_UPPER).alias("b"))
           .orderBy("i").collect()]
    assert ten == ["0-10", "31-40", "31-40", "61-70", "61-70", "81-90", "81-90", "91-100"] + ["Unknown"] * 3


def test_prediction_fields(spark):
    df = spark.createDataFrame([(0.5,), (0.49996,), (1.0,), (0.123456,)], "p double")
    got = [(r.c, r.t) for r in df.select(fx.alert_confidence("p").alias("c"), fx.alert_threat_score("p").alias("t")).collect()]
    assert got == [(0.5, 50), (0.5, 0), (1.0, 100), (0.8765, 0)]


def test_normalise_defaults(spark):
    df = spark.createDataFrame([(None, "x", "0.7", "junk", "handled")],
                               "srcip string, dstip string, confidence string, threat_score string, status string")
    row = ops.normalise_alerts(df, F.lit(NOON)).first()
    assert (row.srcip, row.dstip, row.proto, row.service, row.attack_cat) == ("unknown", "x", "unknown", "-", "Unknown")
    assert (row.confidence, row.threat_score, row.status, row.resolved_by, row.source) == (0.7, 0, "pending", None, "external")
    assert row.timestamp == NOON and len(row.id) == 64


def test_pages(alerts):
    assert ids(ops.alerts_page(alerts, 1, 2)) == ["2", "1"]
    assert ids(ops.alerts_page(alerts, 2, 2)) == ["3", "4"]
    assert ids(ops.alerts_page(alerts, 9, 2)) == []
    assert ids(ops.alerts_after(alerts, NOON, "2", 2)) == ["1", "3"]
    with pytest.raises(ValueError):
        ops.alerts_page(alerts, 1, 0)
    joined = [i for p in range(1, 5) for i in ids(ops.alerts_page(alerts, p, 1))]
    assert joined == ids(ops.newest_first(alerts))


def test_pages_join_to_the_whole_list(spark):
    rng = random.Random(3)
    rows = [(f"{i:04}", None if i % 17 == 0 else dt.datetime(2024, 1, 1) + dt.timedelta(days=rng.randint(0, 3), seconds=rng.randint(0, 4)))
            for i in range(300)]
    alerts = spark.createDataFrame(rows, "id string, timestamp timestamp").repartition(5).cache()
    want = ids(ops.newest_first(alerts))
    for limit in (7, 100, 299, 1000):
        assert [i for p in range(1, 300 // limit + 3) for i in ids(ops.alerts_page(alerts, p, limit))] == want
    last, seen = ops.alerts_page(alerts, 1, 50).collect(), []
    while last:
        seen += [r.id for r in last]
        last = ops.alerts_after(alerts, last[-1].timestamp, last[-1].id, 50).collect() if last[-1].timestamp else []
    assert seen == want[:len(seen)] and len(seen) >= 280


def test_text_times(spark):
    rows = [("1", "2024-05-01T10:00:00Z"), ("2", " "), ("3", "junk"), ("4", None)]
    out = ops.normalise_alerts(spark.createDataFrame(rows, "id string, timestamp string"), F.lit(NOON))
    assert out.schema.simpleString() == alert_schema().simpleString()
    assert [r.timestamp for r in out.orderBy("id").collect()] == [dt.datetime(2024, 5, 1, 10), NOON, NOON, NOON]


def test_equal_records_are_one_alert_and_identity_tells_them_apart(spark):
    scored = spark.createDataFrame([("a", 0.9, 1), ("a", 0.9, 2), ("b", 0.2, 3)], "srcip string, attack_probability double, place int")
    both = scored.withColumn("attack_cat", F.lit("DoS"))
    assert ops.alerts_from_predictions(both.drop("place"), now=F.lit(NOON)).count() == 1
    found = ops.alerts_from_predictions(both, now=F.lit(NOON), identity=["place"])
    later = ops.alerts_from_predictions(both, now=F.lit(NOON + dt.timedelta(1)), identity=["place"])
    assert found.count() == 2 and set(ids(found)) == set(ids(later))


def test_page_meta(alerts):
    assert tuple(ops.page_meta(alerts, 1, 3).first()) == (4, 2, 1, 3)
    assert tuple(ops.page_meta(alerts.limit(0), 1, 3).first()) == (0, 1, 1, 3)


def test_filters_keep_missing_values(alerts):
    assert sorted(ids(ops.unannounced(alerts))) == ["2", "3"]
    assert sorted(ids(ops.visible(alerts.withColumn("status", F.when(F.col("id") == "1", "resolved"))))) == ["2", "3", "4"]
    assert sorted(ids(ops.recent_attacks(alerts, F.lit(NOON)))) == ["1", "3"]


def test_updates(spark, alerts):
    later = NOON + dt.timedelta(minutes=1)
    updates = spark.createDataFrame([
        ("1", "handled", " ann ", NOON), ("1", "pending", "bob", later), ("2", "closed", "ann", NOON),
        ("3", "handled", "  ", NOON), ("9", "handled", "ann", NOON),
    ], "id string, status string, resolved_by string, resolved_at timestamp")
    got = {r.id: (r.status, r.resolved_by) for r in ops.apply_updates(alerts, updates).collect()}
    assert got == {"1": ("pending", "bob"), "2": ("pending", None), "3": ("handled", None), "4": (None, None)}
    assert ids(ops.unmatched_updates(alerts, updates)) == ["9"]
    assert {(r.id, r.reason) for r in ops.check_updates(updates).rejected.collect()} == {
        ("2", "unknown-status"), ("3", "no-resolver")}


def test_summary(alerts):
    got = {(r.metric, r.name): r.n for r in ops.alert_summary(alerts, F.lit(NOON)).collect()}
    assert got == {("category", "DoS"): 2, ("category", "Normal"): 1, ("category", None): 1,
                   ("recent_attacks", None): 2, ("pending_alerts", None): 2}


def test_rollup_fills_zeros(alerts):
    got = [(r.attack_cat, r.n) for r in ops.dashboard_categories(alerts).collect()]
    assert got[:2] == [("DoS", 2), ("Normal", 1)] and len(got) == 10 and all(n == 0 for _, n in got[2:])
    assert tuple(ops.dashboard_totals(alerts).first()) == (4, 2, 2)


def test_batch_stats_document(alerts):
    doc = ops.batch_stats_document(alerts, F.lit(NOON)).first()
    assert doc.total_records_processed == 4
    assert [tuple(h) for h in doc.peak_hours] == [("11", 2), ("12", 2)]
    assert sum(b["count"] for b in doc.threat_score_distribution) == 4
    empty = ops.batch_stats_document(alerts.limit(0), F.lit(NOON)).first()
    assert empty.total_records_processed == 0 and len(empty.peak_hours) == 1 and empty.peak_hours[0].attack_count == 0
    assert [tuple(b) for b in empty.threat_score_distribution] == [("[0,40) Low", 0)]
