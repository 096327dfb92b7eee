"""Streaming jobs over the test tables, drained and read back.

The input counts as one micro-batch, so no row is late and the result must
equal its batch twin.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from flowlens.functions.columns import instant_clock, utc_instant
from flowlens.operators.alerts import check_updates
from flowlens.operators.profile import enrich, fit_profile
from flowlens.operators.sequence import CONNECTION_COUNTS
from flowlens.plans import flow_queries
from flowlens.plans.adapters import ALERTS_SQL, FLOW_ORDER, UPDATES_SQL, alerts_of, flows, packets, packets_of, table, updates_of
from flowlens.plans.registry import Registry, r6
from flowlens.runtime import scratch_path
from flowlens.schema import flow_schema
from flowlens.sources.writers import as_messages
from flowlens.streaming import jobs
from flowlens.streaming.connections import StreamedConnections
from flowlens.streaming.ingest import decode_flows, table_stream, text_stream

REG = Registry()
ALERTS = "WITH" + ALERTS_SQL


def _stream(spark, sf, name):
    # a pattern, because a stream reads folders or patterns but no single file
    return table_stream(spark, f"{sf}/{name}.parquet*", table(spark, sf, name).schema)


def _alert_stream(spark, sf):
    return alerts_of(_stream(spark, sf, "events")).withColumn("timestamp", utc_instant("timestamp"))


def _drain(spark, stream, mode="append"):
    return jobs.drain(stream, scratch_path(spark, "stream"), scratch_path(spark, "stream-checkpoint"), mode=mode)


@REG.add("stream_category_5m", ALERTS + """,
 windows AS (SELECT time_bucket(INTERVAL 5 MINUTE, timestamp) AS window_start,
                    time_bucket(INTERVAL 5 MINUTE, timestamp) + INTERVAL 5 MINUTE AS window_end,
                    attack_cat, count(*) AS n FROM alerts GROUP BY ALL)
 SELECT * FROM windows WHERE window_end <= (SELECT max(timestamp) FROM alerts) - INTERVAL 10 MINUTES""")
def _(spark, sf):
    counts = jobs.windowed_stream_counts(_alert_stream(spark, sf), "timestamp", by=["attack_cat"])
    return _drain(spark, counts).select(
        instant_clock("window_start").alias("window_start"), instant_clock("window_end").alias("window_end"),
        "attack_cat", "n")


@REG.add("stream_new_alerts", ALERTS + """
 SELECT id, source, timestamp FROM alerts
 WHERE source IS NULL OR source NOT IN ('streaming', 'batch_predict', 'external', 'seed_mock')""")
def _(spark, sf):
    feed = jobs.new_alerts(_alert_stream(spark, sf))
    return _drain(spark, feed).select("id", "source", instant_clock("timestamp").alias("timestamp"))


@REG.add("stream_dedup", ALERTS + " SELECT id, attack_cat, timestamp FROM alerts")
def _(spark, sf):
    """Every message delivered twice, kept once."""
    once = _alert_stream(spark, sf).select("id", "attack_cat", "timestamp")
    twice = once.unionByName(_alert_stream(spark, sf).select("id", "attack_cat", "timestamp"))
    kept = jobs.without_redelivery(twice, "timestamp", ["id"])
    return _drain(spark, kept).select("id", "attack_cat", instant_clock("timestamp").alias("timestamp"))


@REG.add("stream_running_counts", ALERTS + """
 SELECT attack_cat, count(*) AS n, count(*) FILTER (status = 'pending') AS pending FROM alerts GROUP BY 1""")
def _(spark, sf):
    path = scratch_path(spark, "running-counts")
    counts = jobs.running_category_counts(_alert_stream(spark, sf))
    jobs.drain(counts, path, scratch_path(spark, "stream-checkpoint"), mode="complete")
    return jobs.last_snapshot(spark, path)


@REG.add("stream_pending_counts", "WITH" + UPDATES_SQL + """
 SELECT attack_cat, count(*) AS n, count(*) FILTER (coalesce(u.status, a.status) = 'pending') AS pending
 FROM alerts a LEFT JOIN last_update u USING (id) GROUP BY 1""")
def _(spark, sf):
    """Counts that fall when an alert is handled: alerts and updates arrive on one stream, in small batches."""
    events = _stream(spark, sf, "events")
    arrived = alerts_of(events).select("id", "attack_cat", "status", utc_instant("timestamp").alias("at"), F.lit(False).alias("is_update"))
    said = check_updates(updates_of(events)).accepted.select(
        "id", F.lit(None).cast("string").alias("attack_cat"), "status",
        utc_instant("resolved_at").alias("at"), F.lit(True).alias("is_update"))
    path = scratch_path(spark, "pending-changes")
    changes = jobs.drain(jobs.alert_changes(arrived.unionByName(said)), path, scratch_path(spark, "stream-checkpoint"),
                         transform=jobs.sum_of_batch)
    return jobs.sum_changes(changes)


@REG.add("stream_flow_decode", flow_queries.PACKETS + """
 SELECT srcip, dstip, proto, dur, sload, stcpb, CAST(stime AS INT) AS stime, start_clock AS event_time FROM packets""")
def _(spark, sf):
    """Flows sent as JSON messages and decoded on the other side."""
    topic = scratch_path(spark, "topic")
    names = [f.name for f in flow_schema().fields]
    rows = packets(spark, sf)
    as_messages(rows.select(*[c for c in rows.columns if c in names]), order=None).write.text(topic)
    decoded = decode_flows(text_stream(spark, topic), flow_schema())
    return _drain(spark, decoded).select(
        "srcip", "dstip", "proto", "dur", "sload", "stcpb", "stime", instant_clock("event_time").alias("event_time"))


@REG.add("stream_threat_score", flow_queries.REG.sql["threat_score"])
def _(spark, sf):
    """A flow stream enriched with averages learned from the stored table."""
    learned = fit_profile(packets(spark, sf), ["proto"])
    scored = enrich(packets_of(_stream(spark, sf, "lineitem")), learned)
    return (_drain(spark, scored.select("srcip", "dstip", "proto", "sbytes", "sload", "threat_score"))
            .select("srcip", "dstip", "proto", "sbytes", "sload", r6("threat_score")))


@REG.add("stream_connection_counts", flow_queries.REG.sql["connection_counts"])
def _(spark, sf):
    """Flows that arrive up to four days late, in three deliveries, each taken up by a restarted stream."""
    keys = sorted({k for columns in CONNECTION_COUNTS.values() for k in columns})
    rows = flows(spark, sf).select(*dict.fromkeys([*FLOW_ORDER, *keys]))
    arrival = F.timestamp_seconds(F.col("stime") + F.pmod("stcpb", F.lit(5)) * 86_400)
    delivery = F.when(F.year(arrival) < 1994, 0).when(F.year(arrival) < 1997, 1).otherwise(2)
    feed, checkpoint = scratch_path(spark, "feed"), scratch_path(spark, "stream-checkpoint")
    counts = StreamedConnections(spark, scratch_path(spark, "connections"), F.timestamp_seconds("stime"), FLOW_ORDER, "5 days")
    for i in range(3):
        rows.filter(delivery == i).write.mode("append").parquet(feed)
        counts.start(table_stream(spark, feed, rows.schema), checkpoint, drain=True).awaitTermination()
    return counts.final().unionByName(counts.waiting()).select("stime", "stcpb", *keys, *CONNECTION_COUNTS)
