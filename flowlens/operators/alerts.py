"""Alert table operators: ingest, list, update, summarise.

The alert table is an ordinary DataFrame with the layout of
``flowlens.schema.alert_schema``; ``now`` is always a parameter.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlens.functions.columns import (
    THREAT_EDGES, THREAT_NAMES, alert_confidence, alert_threat_score, threat_bucket,
)
from flowlens.runtime import materialise
from flowlens.schema import (
    ALERT_DEFAULTS, ALL_CLASSES, CLOSED_STATUSES, LIFECYCLE_STATUSES, NORMAL,
    SELF_ANNOUNCING_SOURCES, UPDATE_STATUSES, alert_schema,
)

CONTENT_ID = "_content_id"
NO_DAY = -1_000_000_000  # where alerts without a time stand: after all others


# ---- ingest -------------------------------------------------------------

def normalise_alerts(df: DataFrame, now: Column) -> DataFrame:
    """Incoming records in alert layout: defaults for missing or NULL fields, status pending.

    A field of another type is cast; what can not be cast counts as missing.  An
    alert without an id gets one from its content, so a replay repeats it, and
    records with equal content are one alert.
    """
    # zone-free input stays zone-free, anything else becomes an instant
    time_type = "timestamp_ntz" if dict(df.dtypes).get("timestamp") == "timestamp_ntz" else "timestamp"
    content = [c for c in df.columns if c != CONTENT_ID]

    def field(name: str, kind: str) -> Column:
        present = F.col(name) if name in df.columns else F.lit(None)
        return F.coalesce(present.try_cast(kind), F.lit(ALERT_DEFAULTS[name]).cast(kind))

    out = []
    for f in alert_schema().fields:
        kind = f.dataType.simpleString()
        if f.name in ALERT_DEFAULTS:
            value = field(f.name, kind)
        elif f.name == "status":
            value = F.lit("pending")
        elif f.name in ("resolved_by", "resolved_at"):
            value = F.lit(None).cast(time_type if f.name == "resolved_at" else kind)
        elif f.name == "timestamp":
            value = F.coalesce(F.col("timestamp").try_cast(time_type), now.cast(time_type)) if "timestamp" in df.columns else now
        else:
            derived = F.col(CONTENT_ID) if CONTENT_ID in df.columns else F.sha2(F.to_json(F.struct(*content)), 256)
            value = F.coalesce(F.col("id").cast("string"), derived) if "id" in df.columns else derived
        out.append(value.alias(f.name))
    alerts = df.select(*out)
    return alerts if "id" in df.columns else alerts.dropDuplicates(["id"])


def alerts_from_predictions(scored: DataFrame, probability: str = "attack_probability",
                            category: str = "attack_cat", source: str = "batch_predict", *,
                            now: Column, identity: list[str] | None = None) -> DataFrame:
    """Alert rows of the flows judged to be attacks, at the time ``now``.

    ``identity`` names the columns that tell one flow from another, such as the
    place of its message in a topic; without it two flows that are equal in every
    column are one alert.  The time is no part of the id.
    """
    p = F.col(probability)
    known = identity or [c for c in scored.columns if c != "timestamp"]
    return normalise_alerts(
        scored.filter(p >= 0.5).withColumns({
            CONTENT_ID: F.sha2(F.to_json(F.struct(*known)), 256),
            "attack_cat": F.col(category), "confidence": alert_confidence(p),
            "threat_score": alert_threat_score(p), "source": F.lit(source), "timestamp": now,
        }), now)


# ---- lists --------------------------------------------------------------

def with_status(alerts: DataFrame, status: str | None) -> DataFrame:
    return alerts if not status else alerts.filter(F.col("status") == status)


def newest_first(alerts: DataFrame) -> DataFrame:
    return alerts.orderBy(F.desc("timestamp"), F.desc("id"))


def alerts_page(alerts: DataFrame, page: int = 1, limit: int = 20, status: str | None = None) -> DataFrame:
    """One page of alerts, newest first; equal times by id.

    The place of the page in time is found first: alerts are counted per day, then
    per second of the days that hold the page (a row per day and per second of
    these few days).  Only the seconds of the page are then sorted, at any depth.
    """
    if limit < 1 or page < 1:
        raise ValueError("page and limit must be at least 1")
    chosen, skip = with_status(alerts, status), (page - 1) * limit
    day = F.coalesce(F.floor(F.unix_seconds(F.col("timestamp").cast("timestamp")) / 86_400), F.lit(NO_DAY))
    second = F.coalesce(F.unix_seconds(F.col("timestamp").cast("timestamp")), F.lit(NO_DAY * 86_400))
    for unit in (day, second):
        w = Window.orderBy(F.desc("unit"))
        counts = chosen.groupBy(unit.alias("unit")).agg(F.count("*").alias("n")).withColumn("upto", F.sum("n").over(w))
        held = counts.filter((F.col("upto") > skip) & (F.col("upto") - F.col("n") < skip + limit)).agg(
            F.min("unit"), F.max("unit"), F.min(F.col("upto") - F.col("n"))).first()
        if held[0] is None:
            return chosen.limit(0)
        chosen, skip = chosen.filter(unit.between(held[0], held[1])), skip - held[2]
    return newest_first(chosen).offset(int(skip)).limit(limit)


def alerts_after(alerts: DataFrame, timestamp, alert_id: str, limit: int = 20) -> DataFrame:
    """The next page behind a known last row; costs the same at any depth."""
    zone_free = dict(alerts.dtypes)["timestamp"] == "timestamp_ntz"
    t = F.lit(timestamp.isoformat()).cast("timestamp_ntz") if zone_free else F.lit(timestamp)
    i = F.lit(alert_id)
    older = (F.col("timestamp") < t) | ((F.col("timestamp") == t) & (F.col("id") < i))
    return newest_first(alerts.filter(older)).limit(limit)


def page_meta(alerts: DataFrame, page: int = 1, limit: int = 20, status: str | None = None) -> DataFrame:
    """Total rows and pages of a listing; an empty listing has one page."""
    if limit < 1:
        raise ValueError("limit must be at least 1")
    total = F.col("total_records")
    return with_status(alerts, status).agg(F.count("*").alias("total_records")).select(
        "total_records",
        F.greatest(F.lit(1), F.ceil(total / limit)).cast("long").alias("total_pages"),
        F.lit(page).alias("current_page"), F.lit(limit).alias("limit"),
    )


def alerts_of_category(alerts: DataFrame, category: str) -> DataFrame:
    return newest_first(alerts.filter(F.col("attack_cat") == category))


def newest(alerts: DataFrame, keep: int = 100) -> DataFrame:
    return newest_first(alerts).limit(keep)


def visible(alerts: DataFrame) -> DataFrame:
    """Alerts not closed yet; a missing status is shown."""
    return alerts.filter(~F.coalesce(F.col("status").isin(CLOSED_STATUSES), F.lit(False)))


def unannounced(alerts: DataFrame) -> DataFrame:
    """Alerts from sources that do not announce themselves; a missing source passes."""
    return alerts.filter(~F.coalesce(F.col("source").isin(SELF_ANNOUNCING_SOURCES), F.lit(False)))


def recent_attacks(alerts: DataFrame, now: Column, lookback: str = "10 minutes") -> DataFrame:
    """Attacks since ``now`` minus ``lookback``; a missing class counts as attack."""
    return alerts.filter(
        ~F.col("attack_cat").eqNullSafe(F.lit(NORMAL))
        & (F.col("timestamp") >= now - F.expr(f"INTERVAL {lookback}")))


# ---- updates ------------------------------------------------------------

@dataclass(frozen=True)
class CheckedUpdates:
    accepted: DataFrame
    rejected: DataFrame


def check_updates(updates: DataFrame, allowed: list[str] = UPDATE_STATUSES) -> CheckedUpdates:
    """Updates with a known status and a named resolver, and the rest with the reason."""
    bad_status = ~F.coalesce(F.col("status").isin(allowed), F.lit(False))
    nameless = F.coalesce(F.trim("resolved_by"), F.lit("")) == ""
    reason = F.when(bad_status, "unknown-status").when(nameless, "no-resolver")
    marked = updates.withColumn("reason", reason)
    return CheckedUpdates(
        accepted=marked.filter("reason is null").drop("reason").withColumn("resolved_by", F.trim("resolved_by")),
        rejected=marked.filter("reason is not null"),
    )


def _last_per_alert(updates: DataFrame) -> DataFrame:
    return updates.groupBy("id").agg(
        F.max(F.struct("resolved_at", "status", "resolved_by")).alias("u"))


def apply_updates(alerts: DataFrame, updates: DataFrame, allowed: list[str] = UPDATE_STATUSES) -> DataFrame:
    """Alerts with the last accepted update per id.

    The updates are reduced and stored first: a usual batch of updates is then
    broadcast by its size and the alert table is not shuffled.
    """
    last = materialise(_last_per_alert(check_updates(updates, allowed).accepted), "last-updates")
    changed = alerts.join(last, "id", "left").withColumns({
        c: F.when(F.col("u").isNotNull(), F.col(f"u.{c}")).otherwise(F.col(c))
        for c in ("status", "resolved_by", "resolved_at")
    })
    return changed.select(*alerts.columns)


def unmatched_updates(alerts: DataFrame, updates: DataFrame, allowed: list[str] = UPDATE_STATUSES) -> DataFrame:
    """Accepted updates whose alert does not exist."""
    return check_updates(updates, allowed).accepted.join(alerts.select("id"), "id", "left_anti")


# ---- summaries ----------------------------------------------------------

def alert_summary(alerts: DataFrame, now: Column, lookback: str = "10 minutes") -> DataFrame:
    """(metric, name, n): rows per class, recent attacks, pending alerts; one pass."""
    recent = (~F.col("attack_cat").eqNullSafe(F.lit(NORMAL))
              & (F.col("timestamp") >= now - F.expr(f"INTERVAL {lookback}")))
    cube = (
        alerts.select("attack_cat", recent.alias("recent"), (F.col("status") == "pending").alias("pending"))
        .groupingSets([[F.col("attack_cat")], []], F.col("attack_cat"))
        .agg(F.grouping_id().alias("g"), F.count("*").alias("n"),
             F.count_if("recent").alias("recent"), F.count_if("pending").alias("pending"))
    )
    text = F.lit(None).cast("string")
    rows = F.when(F.col("g") == 0, F.array(
        F.struct(F.lit("category").alias("metric"), F.col("attack_cat").alias("name"), F.col("n").alias("n")),
    )).otherwise(F.array(
        F.struct(F.lit("recent_attacks").alias("metric"), text.alias("name"), F.col("recent").alias("n")),
        F.struct(F.lit("pending_alerts").alias("metric"), text.alias("name"), F.col("pending").alias("n")),
    ))
    return cube.select(F.explode(rows).alias("r")).select("r.*")


def status_totals(alerts: DataFrame, statuses: list[str] = LIFECYCLE_STATUSES) -> DataFrame:
    """All alerts and those in each lifecycle status."""
    return alerts.agg(F.count("*").alias("total"),
                      *[F.count_if(F.col("status") == s).alias(s) for s in statuses])


def dashboard_totals(alerts: DataFrame) -> DataFrame:
    """All, pending and handled alerts; handled is what is not pending."""
    return alerts.agg(F.count("*").alias("total"), F.count_if(F.col("status") == "pending").alias("pending")
                      ).withColumn("handled", F.col("total") - F.col("pending"))


def dashboard_categories(alerts: DataFrame, classes: list[str] = ALL_CLASSES) -> DataFrame:
    """Alerts per known class, zero where there are none, most first."""
    listed = alerts.sparkSession.createDataFrame([(c,) for c in classes], "attack_cat string")
    counted = (alerts.filter(F.col("attack_cat").isin(classes))
               .groupBy("attack_cat").agg(F.count("*").alias("n")))
    return (counted.unionByName(listed.withColumn("n", F.lit(0).cast("long")))
            .groupBy("attack_cat").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "attack_cat"))


def peak_hours(alerts: DataFrame, time: Column | str = "timestamp") -> DataFrame:
    """Alerts per hour of day, in hour order."""
    return (alerts.groupBy(F.date_format(time, "HH").alias("hour"))
            .agg(F.count("*").alias("attack_count")).orderBy("hour"))


def threat_distribution(alerts: DataFrame, bucket: Column) -> DataFrame:
    """Alerts per threat band."""
    return alerts.groupBy(bucket.alias("range")).agg(F.count("*").alias("n"))


def batch_stats(alerts: DataFrame, edges: list[int] = THREAT_EDGES, names: list[str] = THREAT_NAMES) -> DataFrame:
    """(section, key, n) for peak hours, threat bands, classes and the true total; one pass."""
    keys = {"peak_hours": "hour", "threat_score_distribution": "band", "category_summary": "attack_cat"}
    cut = alerts.select(F.date_format("timestamp", "HH").alias("hour"),
                        threat_bucket("threat_score", edges, names).alias("band"), "attack_cat")
    g = F.col("g")
    return (
        cut.groupingSets([[F.col(c)] for c in keys.values()] + [[]], *[F.col(c) for c in keys.values()])
        .agg(F.grouping_id().alias("g"), F.count("*").alias("n"))
        .select(
            F.when(g == 0b011, "peak_hours").when(g == 0b101, "threat_score_distribution")
            .when(g == 0b110, "category_summary").otherwise("total_records_processed").alias("section"),
            F.when(g == 0b011, F.col("hour")).when(g == 0b101, F.col("band"))
            .when(g == 0b110, F.col("attack_cat")).alias("key"),
            "n",
        )
    )


def batch_stats_document(alerts: DataFrame, now: Column) -> DataFrame:
    """The same figures as one nested row.

    The arrays hold a row per hour, band and class.  With no alerts they fall
    back to the hour of ``now`` and the lowest band with a count of zero.
    """
    flat = batch_stats(alerts)

    def part(section: str, *names: str) -> Column:
        row = F.when(F.col("section") == section, F.struct(F.col("key").alias(names[0]), F.col("n").alias(names[1])))
        return F.array_sort(F.collect_list(row))

    hours = F.col("peak_hours")
    bands = F.col("threat_score_distribution")
    zero = F.lit(0).cast("long")
    doc = flat.agg(
        part("peak_hours", "hour", "attack_count").alias("peak_hours"),
        part("threat_score_distribution", "range", "count").alias("threat_score_distribution"),
        part("category_summary", "attack_cat", "count").alias("category_summary"),
        F.coalesce(F.sum(F.when(F.col("section") == "total_records_processed", F.col("n"))), zero)
        .alias("total_records_processed"),
    )
    return doc.withColumns({
        "peak_hours": F.when(F.size(hours) > 0, hours).otherwise(F.array(F.struct(
            F.date_format(now, "HH").alias("hour"), zero.alias("attack_count")))),
        "threat_score_distribution": F.when(F.size(bands) > 0, bands).otherwise(F.array(F.struct(
            F.lit(f"[{THREAT_EDGES[0]},{THREAT_EDGES[1]}) {THREAT_NAMES[0]}").alias("range"), zero.alias("count")))),
    })


def detection_counts(scored: DataFrame, batch: str = "batch_id", flag: str = "is_attack") -> DataFrame:
    """Records and attacks per batch."""
    return scored.groupBy(batch).agg(
        F.count("*").alias("total_records"),
        F.count_if(F.col(flag).cast("boolean")).alias("attacks_detected"))
