"""The alert store: written, updated, followed and compacted, then read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowlens.plans.adapters import ALERTS_SQL, UPDATES_SQL, alerts, updates
from flowlens.plans.registry import Registry
from flowlens.runtime import scratch_path
from flowlens.sources.alert_store import AlertStore, pending_by_day

REG = Registry()
ALERTS, UPDATES = "WITH" + ALERTS_SQL, "WITH" + UPDATES_SQL
PARTS = 3


def filled_store(spark, sf) -> AlertStore:
    """All alerts in three appends, the last of them delivered twice."""
    store = AlertStore(spark, scratch_path(spark, "alert-store"), zone_free=True)
    rows = alerts(spark, sf)
    part = F.pmod(F.col("id").cast("long"), F.lit(PARTS))
    for i in (*range(PARTS), PARTS - 1):
        store.append(rows.filter(part == i), f"part-{i}")
    return store


STATUS = ("SELECT a.id, strftime(a.timestamp, '%Y-%m-%d') AS day, coalesce(u.status, a.status) AS status,"
          " coalesce(u.resolved_by, a.resolved_by) AS resolved_by, coalesce(u.resolved_at, a.resolved_at) AS resolved_at"
          " FROM alerts a LEFT JOIN last_update u USING (id)")


@REG.add("store_after_updates", UPDATES + " " + STATUS)
def _(spark, sf):
    store = filled_store(spark, sf)
    for _ in range(2):  # the second time is a replay
        store.update(updates(spark, sf), 0)
    return store.read().select("id", "day", "status", "resolved_by", "resolved_at")


@REG.add("store_new_since", ALERTS + """
 SELECT id, CAST(id AS BIGINT) % 3 + 1 AS arrival, status FROM alerts
 WHERE CAST(id AS BIGINT) % 3 = 2 OR (CAST(id AS BIGINT) % 3 = 1 AND id > '5')""")
def _(spark, sf):
    """What comes after the alert '5' of the second append, although days have been rewritten since."""
    store = filled_store(spark, sf)
    store.update(updates(spark, sf).filter("false"), 0)
    return store.since(2, "5").select("id", "arrival", "status")


@REG.add("store_compacted_pending", UPDATES + f"""
 SELECT day, count(*) AS n, count(*) FILTER (status = 'pending') AS pending FROM ({STATUS}) GROUP BY day""")
def _(spark, sf):
    store = filled_store(spark, sf)
    store.update(updates(spark, sf), 0)
    store.compact("9999-12-31")
    return pending_by_day(store.read())


@REG.add("store_late_redelivery", ALERTS + " SELECT id, attack_cat FROM alerts")
def _(spark, sf):
    """Every alert delivered again in a later batch, long after any watermark."""
    store = filled_store(spark, sf)
    store.append(alerts(spark, sf).withColumn("source", F.lit("again")), "late", known_days=100_000)
    return store.read().select("id", "attack_cat")
