"""Alert store queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from flowlens.functions.columns import (
    DECILE_UPPER, TWENTY_UPPER, alert_confidence, alert_threat_score, confidence_band, severity_band, threat_bucket, upper_bound_bucket,
)
from flowlens.operators import alerts as ops
from flowlens.operators.explore import category_counts, window_counts
from flowlens.plans.adapters import (
    ALERTS_SQL, PREDICTIONS_SQL, UPDATES_SQL, alerts, latest, predictions, table, updates,
)
from flowlens.plans.registry import Registry, r6
from flowlens.streaming.ingest import decode_json

REG = Registry()
ALERTS, UPDATES, PREDICTIONS = "WITH" + ALERTS_SQL, "WITH" + UPDATES_SQL, "WITH" + PREDICTIONS_SQL
LIST = "id, srcip, attack_cat, round(confidence, 6) AS confidence, threat_score, status, timestamp"


def _list(df):
    return df.select("id", "srcip", "attack_cat", r6("confidence"), "threat_score", "status", "timestamp")


# ---- messages and ingest ------------------------------------------------

@REG.add("json_props_extract", """
 SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events""")
def _(spark, sf):
    return decode_json(table(spark, sf, "events"), StructType.fromDDL("k int"), "props", keep=("event_id",))


@REG.add("alerts_normalise", """
 SELECT CAST(event_id AS VARCHAR) AS id, CASE WHEN user_id % 4 = 0 THEN 'unknown' ELSE 'u' || user_id END AS srcip,
        'unknown' AS dstip, 'unknown' AS proto, '-' AS service, 'unknown' AS state,
        CASE WHEN event_type = 'view' THEN 'Unknown' ELSE event_type END AS attack_cat,
        CAST(0 AS DOUBLE) AS confidence, CAST(json_extract_string(props, '$.k') AS INT) AS threat_score,
        'pending' AS status, CAST(NULL AS VARCHAR) AS resolved_by, 'external' AS source,
        CASE WHEN event_id % 9 = 0 THEN (SELECT max(ts) FROM events) ELSE ts END AS timestamp
 FROM events""")
def _(spark, sf):
    events = table(spark, sf, "events")
    incoming = events.select(
        F.col("event_id").alias("id"),
        F.when(F.col("user_id") % 4 != 0, F.concat(F.lit("u"), "user_id")).alias("srcip"),
        F.nullif("event_type", F.lit("view")).alias("attack_cat"),
        F.get_json_object("props", "$.k").alias("threat_score"),
        F.lit("handled").alias("status"),
        F.when(F.col("event_id") % 9 != 0, F.col("ts")).alias("timestamp"),
    )
    return ops.normalise_alerts(incoming, events.agg(F.max("ts")).scalar()).drop("resolved_at")


@REG.add("alerts_from_predictions", PREDICTIONS + """
 SELECT srcip, dstip, proto, coalesce(service, '-') AS service, state, pred_stage2 AS attack_cat,
        round(attack_probability, 4) AS confidence,
        CAST(floor(least(attack_probability * 100, 100.0)) AS INT) AS threat_score,
        'pending' AS status, 'batch_predict' AS source, start_clock AS timestamp
 FROM predictions WHERE attack_probability >= 0.5""")
def _(spark, sf):
    scored = predictions(spark, sf).withColumn("timestamp", F.col("start_clock"))
    found = ops.alerts_from_predictions(scored, category="pred_stage2", now=F.col("start_clock"))
    return found.drop("id", "resolved_by", "resolved_at")


@REG.add("score_to_alert", PREDICTIONS + """
 SELECT srcip, dstip, attack_probability >= 0.5 AS is_attack,
        round(CASE WHEN attack_probability >= 0.5 THEN attack_probability ELSE 1.0 - attack_probability END, 4)
        AS confidence,
        CASE WHEN attack_probability >= 0.5 THEN CAST(floor(least(attack_probability * 100, 100.0)) AS INT)
             ELSE 0 END AS alert_threat_score
 FROM predictions""")
def _(spark, sf):
    p = "attack_probability"
    return predictions(spark, sf).select(
        "srcip", "dstip", (F.col(p) >= 0.5).alias("is_attack"), alert_confidence(p).alias("confidence"),
        alert_threat_score(p).alias("alert_threat_score"))


# ---- bands --------------------------------------------------------------

@REG.add("confidence_band", ALERTS + """
 SELECT CASE WHEN confidence >= 0.8 THEN 'High' WHEN confidence >= 0.5 THEN 'Medium' ELSE 'Low' END AS band,
        count(*) AS n FROM alerts GROUP BY 1""")
def _(spark, sf):
    return alerts(spark, sf).groupBy(confidence_band().alias("band")).agg(F.count("*").alias("n"))


@REG.add("severity_band", ALERTS + """
 SELECT CASE WHEN threat_score >= 80 THEN 'critical' WHEN threat_score >= 50 THEN 'warning' ELSE 'low' END AS band,
        count(*) AS n FROM alerts GROUP BY 1""")
def _(spark, sf):
    return alerts(spark, sf).groupBy(severity_band().alias("band")).agg(F.count("*").alias("n"))


@REG.add("threat_buckets", ALERTS + """
 SELECT CASE WHEN threat_score BETWEEN 0 AND 39 THEN '[0,40) Low' WHEN threat_score BETWEEN 40 AND 69 THEN '[40,70) Medium'
             WHEN threat_score BETWEEN 70 AND 89 THEN '[70,90) High'
             WHEN threat_score BETWEEN 90 AND 100 THEN '[90,101) Critical' ELSE 'Unknown' END AS range,
        count(*) AS n FROM alerts GROUP BY 1""")
def _(spark, sf):
    return ops.threat_distribution(alerts(spark, sf), threat_bucket())


@REG.add("threat_deciles", ALERTS + """
 SELECT CASE WHEN threat_score BETWEEN 0 AND 10 THEN '0-10'
             WHEN threat_score BETWEEN 11 AND 100
             THEN ((threat_score - 1) // 10 * 10 + 1) || '-' || ((threat_score - 1) // 10 * 10 + 10)
             ELSE 'Unknown' END AS range, count(*) AS n FROM alerts GROUP BY 1""")
def _(spark, sf):
    return ops.threat_distribution(alerts(spark, sf), upper_bound_bucket("threat_score", DECILE_UPPER))


@REG.add("threat_fifths", ALERTS + """
 SELECT CASE WHEN threat_score BETWEEN 0 AND 20 THEN '0-20'
             WHEN threat_score BETWEEN 21 AND 100
             THEN ((threat_score - 1) // 20 * 20 + 1) || '-' || ((threat_score - 1) // 20 * 20 + 20)
             ELSE 'Unknown' END AS range, count(*) AS n FROM alerts GROUP BY 1""")
def _(spark, sf):
    return ops.threat_distribution(alerts(spark, sf), upper_bound_bucket("threat_score", TWENTY_UPPER))


# ---- lists --------------------------------------------------------------

_NEWEST = "ORDER BY timestamp DESC, id DESC"


@REG.add("alerts_page", ALERTS + f" SELECT {LIST} FROM alerts WHERE status = 'pending' {_NEWEST} LIMIT 20 OFFSET 40")
def _(spark, sf):
    return _list(ops.alerts_page(alerts(spark, sf), page=3, limit=20, status="pending"))


@REG.add("alerts_page_after", ALERTS + f""",
 known AS (SELECT timestamp AS t, id AS i FROM alerts {_NEWEST} LIMIT 1 OFFSET 39)
 SELECT {LIST} FROM alerts, known WHERE timestamp < t OR (timestamp = t AND id < i) {_NEWEST} LIMIT 20""")
def _(spark, sf):
    rows = alerts(spark, sf)
    last = ops.alerts_page(rows, page=40, limit=1).first()
    return _list(ops.alerts_after(rows, last["timestamp"], last["id"], 20))


@REG.add("alerts_page_meta", ALERTS + """
 SELECT count(*) AS total_records, CAST(greatest(1, ceil(count(*) / 20)) AS BIGINT) AS total_pages,
        3 AS current_page, 20 AS "limit" FROM alerts WHERE status = 'pending'""")
def _(spark, sf):
    return ops.page_meta(alerts(spark, sf), page=3, limit=20, status="pending")


@REG.add("alerts_by_category", ALERTS + f" SELECT {LIST} FROM alerts WHERE attack_cat = 'DoS' {_NEWEST}")
def _(spark, sf):
    return _list(ops.alerts_of_category(alerts(spark, sf), "DoS"))


@REG.add("alerts_newest_first", ALERTS + f" SELECT {LIST} FROM alerts {_NEWEST}")
def _(spark, sf):
    return _list(ops.newest_first(alerts(spark, sf)))


@REG.add("newest_100", ALERTS + f" SELECT {LIST} FROM alerts {_NEWEST} LIMIT 100")
def _(spark, sf):
    return _list(ops.newest(alerts(spark, sf)))


@REG.add("visible_alerts", ALERTS + """
 SELECT id, lifecycle AS status FROM alerts WHERE lifecycle IS NULL OR lifecycle NOT IN ('resolved', 'false_positive')""")
def _(spark, sf):
    return ops.visible(alerts(spark, sf).select("id", F.col("lifecycle").alias("status")))


@REG.add("new_alerts", ALERTS + """
 SELECT id, source FROM alerts
 WHERE source IS NULL OR source NOT IN ('streaming', 'batch_predict', 'external', 'seed_mock')""")
def _(spark, sf):
    return ops.unannounced(alerts(spark, sf)).select("id", "source")


def _recent_sql(span: str) -> str:
    return ALERTS + f""" SELECT {LIST} FROM alerts WHERE attack_cat IS DISTINCT FROM 'Normal'
 AND timestamp >= (SELECT max(timestamp) FROM alerts) - INTERVAL {span}"""


@REG.add("recent_attacks", _recent_sql("10 MINUTES"))
def _(spark, sf):
    rows = alerts(spark, sf)
    return _list(ops.recent_attacks(rows, latest(rows)))


@REG.add("recent_attacks_1d", _recent_sql("1 DAY"))
def _(spark, sf):
    rows = alerts(spark, sf)
    return _list(ops.recent_attacks(rows, latest(rows), "1 day"))


# ---- updates ------------------------------------------------------------

@REG.add("alert_updates", UPDATES + """
 SELECT a.id, coalesce(u.status, a.status) AS status, coalesce(u.resolved_by, a.resolved_by) AS resolved_by,
        coalesce(u.resolved_at, a.resolved_at) AS resolved_at
 FROM alerts a LEFT JOIN last_update u USING (id)""")
def _(spark, sf):
    return (ops.apply_updates(alerts(spark, sf), updates(spark, sf))
            .select("id", "status", "resolved_by", "resolved_at"))


@REG.add("alert_updates_missing", UPDATES + """
 SELECT id, status, resolved_by, resolved_at FROM accepted WHERE id NOT IN (SELECT id FROM alerts)""")
def _(spark, sf):
    return ops.unmatched_updates(alerts(spark, sf), updates(spark, sf))


@REG.add("alert_updates_rejected", UPDATES + """
 SELECT id, status, resolved_by, resolved_at,
        CASE WHEN status NOT IN ('pending', 'handled') THEN 'unknown-status' ELSE 'no-resolver' END AS reason
 FROM updates WHERE status NOT IN ('pending', 'handled') OR trim(coalesce(resolved_by, '')) = ''""")
def _(spark, sf):
    return ops.check_updates(updates(spark, sf)).rejected


# ---- summaries ----------------------------------------------------------

@REG.add("attack_distribution", ALERTS + " SELECT attack_cat, count(*) AS n FROM alerts GROUP BY 1")
def _(spark, sf):
    return category_counts(alerts(spark, sf))


@REG.add("alert_summary", ALERTS + """
 SELECT 'category' AS metric, attack_cat AS name, count(*) AS n FROM alerts GROUP BY ALL
 UNION ALL
 SELECT 'recent_attacks', NULL, count(*) FROM alerts WHERE attack_cat IS DISTINCT FROM 'Normal'
    AND timestamp >= (SELECT max(timestamp) FROM alerts) - INTERVAL 10 MINUTES
 UNION ALL
 SELECT 'pending_alerts', NULL, count(*) FROM alerts WHERE status = 'pending'""")
def _(spark, sf):
    rows = alerts(spark, sf)
    return ops.alert_summary(rows, latest(rows))


@REG.add("status_totals", ALERTS + """
 SELECT count(*) AS total, count(*) FILTER (lifecycle = 'unverified') AS unverified,
        count(*) FILTER (lifecycle = 'confirmed') AS confirmed, count(*) FILTER (lifecycle = 'resolved') AS resolved
 FROM alerts""")
def _(spark, sf):
    return ops.status_totals(alerts(spark, sf).select(F.col("lifecycle").alias("status")))


@REG.add("dashboard_totals", ALERTS + """
 SELECT count(*) AS total, count(*) FILTER (status = 'pending') AS pending,
        count(*) - count(*) FILTER (status = 'pending') AS handled FROM alerts""")
def _(spark, sf):
    return ops.dashboard_totals(alerts(spark, sf))


@REG.add("dashboard_rollup", ALERTS + """,
 classes AS (SELECT unnest(['Normal', 'Analysis', 'Backdoor', 'DoS', 'Exploits', 'Fuzzers', 'Generic',
                            'Reconnaissance', 'Shellcode', 'Worms']) AS attack_cat)
 SELECT c.attack_cat, count(a.id) AS n FROM classes c LEFT JOIN alerts a USING (attack_cat) GROUP BY 1""")
def _(spark, sf):
    return ops.dashboard_categories(alerts(spark, sf))


@REG.add("peak_hours", ALERTS + """
 SELECT strftime(timestamp, '%H') AS hour, count(*) AS attack_count FROM alerts GROUP BY 1""")
def _(spark, sf):
    return ops.peak_hours(alerts(spark, sf))


_BAND = """CASE WHEN threat_score BETWEEN 0 AND 39 THEN '[0,40) Low' WHEN threat_score BETWEEN 40 AND 69 THEN '[40,70) Medium'
             WHEN threat_score BETWEEN 70 AND 89 THEN '[70,90) High'
             WHEN threat_score BETWEEN 90 AND 100 THEN '[90,101) Critical' ELSE 'Unknown' END"""


@REG.add("batch_stats", ALERTS + f"""
 SELECT 'peak_hours' AS section, strftime(timestamp, '%H') AS key, count(*) AS n FROM alerts GROUP BY ALL
 UNION ALL SELECT 'threat_score_distribution', {_BAND}, count(*) FROM alerts GROUP BY ALL
 UNION ALL SELECT 'category_summary', attack_cat, count(*) FROM alerts GROUP BY ALL
 UNION ALL SELECT 'total_records_processed', NULL, count(*) FROM alerts""")
def _(spark, sf):
    return ops.batch_stats(alerts(spark, sf))


@REG.add("batch_stats_document", ALERTS + f""",
 h AS (SELECT strftime(timestamp, '%H') AS k, count(*) AS n FROM alerts GROUP BY 1),
 b AS (SELECT {_BAND} AS k, count(*) AS n FROM alerts GROUP BY 1),
 c AS (SELECT attack_cat AS k, count(*) AS n FROM alerts GROUP BY 1)
 SELECT (SELECT '[' || string_agg('{{"hour":"' || k || '","attack_count":' || n || '}}', ',' ORDER BY k) || ']' FROM h) AS peak_hours,
        (SELECT '[' || string_agg('{{"range":"' || k || '","count":' || n || '}}', ',' ORDER BY k) || ']' FROM b)
          AS threat_score_distribution,
        (SELECT '[' || string_agg('{{"attack_cat":"' || k || '","count":' || n || '}}', ',' ORDER BY k) || ']' FROM c) AS category_summary,
        (SELECT count(*) FROM alerts) AS total_records_processed""")
def _(spark, sf):
    doc = ops.batch_stats_document(alerts(spark, sf), F.lit("2024-01-01").cast("timestamp"))
    return doc.select(*[F.to_json(c).alias(c) for c in
                        ("peak_hours", "threat_score_distribution", "category_summary")], "total_records_processed")


@REG.add("batch_detection_counts", PREDICTIONS + """
 SELECT spkts AS batch_id, count(*) AS total_records, count(*) FILTER (pred_stage1 = 1) AS attacks_detected
 FROM predictions GROUP BY 1""")
def _(spark, sf):
    return ops.detection_counts(predictions(spark, sf), batch="spkts", flag="pred_stage1").withColumnRenamed(
        "spkts", "batch_id")


@REG.add("alerts_category_5m", ALERTS + """
 SELECT time_bucket(INTERVAL 5 MINUTE, timestamp) AS window_start,
        time_bucket(INTERVAL 5 MINUTE, timestamp) + INTERVAL 5 MINUTE AS window_end, attack_cat, count(*) AS n
 FROM alerts GROUP BY ALL""")
def _(spark, sf):
    return window_counts(alerts(spark, sf), "timestamp", by=["attack_cat"])
