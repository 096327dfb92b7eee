"""The test tables seen as flows, alerts, updates and predictions.

Every view exists twice: as a DataFrame for the operators and as a SQL common
table expression for the twin query.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.functions.columns import attack_name, utc_epoch


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# ---- flows --------------------------------------------------------------

# Which class an order priority stands for, untidy on purpose.
PRIORITY_CLASS = {"1-URGENT": "DoS", "2-HIGH": "  Fuzzers ", "3-MEDIUM": "Backdoors", "4-NOT SPECIFIED": ""}

# All columns of a line item: rows that tie in them are equal in every column.
FLOW_ORDER = ["stime", "stcpb", "dtcpb", "srcip", "sport", "sbytes", "sload", "dload_raw", "dur", "proto", "state"]


def packets(spark: SparkSession, sf: str) -> DataFrame:
    """Flows without label and service, from the line items alone."""
    return packets_of(table(spark, sf, "lineitem"))


def packets_of(item: DataFrame, *more: str) -> DataFrame:
    """Line items as flows, with ``more`` of their columns as they are."""
    return item.select(
        *more,
        F.concat(F.lit("s"), "l_suppkey").alias("srcip"),
        F.concat(F.lit("p"), "l_partkey").alias("dstip"),
        F.col("l_linenumber").cast("string").alias("sport"),
        F.col("l_quantity").cast("int").cast("string").alias("dsport"),
        F.col("l_returnflag").alias("proto"),
        F.col("l_linestatus").alias("state"),
        F.col("l_tax").alias("dur"),
        F.col("l_quantity").alias("sbytes"),
        (F.col("l_extendedprice") * F.col("l_discount")).alias("dbytes"),
        F.col("l_extendedprice").alias("sload"),
        F.nullif("l_discount", F.lit(0.0)).alias("dload"),
        F.col("l_discount").alias("dload_raw"),
        F.col("l_linenumber").alias("spkts"),
        (F.col("l_linenumber") + 1).alias("dpkts"),
        F.col("l_orderkey").alias("stcpb"),
        F.col("l_partkey").alias("dtcpb"),
        utc_epoch("l_shipdate").alias("stime"),
        F.col("l_shipdate").alias("start_clock"),
    )


PACKETS_SQL = """
packets AS (
  SELECT 's' || l_suppkey AS srcip, 'p' || l_partkey AS dstip,
         CAST(l_linenumber AS VARCHAR) AS sport, CAST(CAST(l_quantity AS INT) AS VARCHAR) AS dsport,
         l_returnflag AS proto, l_linestatus AS state, l_tax AS dur, l_quantity AS sbytes,
         l_extendedprice * l_discount AS dbytes, l_extendedprice AS sload,
         nullif(l_discount, 0.0) AS dload, l_discount AS dload_raw,
         l_linenumber AS spkts, l_linenumber + 1 AS dpkts, l_orderkey AS stcpb, l_partkey AS dtcpb,
         CAST(epoch(l_shipdate) AS BIGINT) AS stime, l_shipdate AS start_clock
  FROM lineitem)"""


def flows(spark: SparkSession, sf: str) -> DataFrame:
    """Flows with label, class and service, which live on the order.

    The tables are joined as they are stored and made into flows afterwards, so a shuffle moves
    each stored column once and none of those made from it.
    """
    order = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    item = table(spark, sf, "lineitem")
    made = packets_of(item.join(order, F.col("l_orderkey") == F.col("o_orderkey")), "o_orderstatus", "o_orderpriority")
    priority = F.col("o_orderpriority")
    category: Column | None = None
    for key, name in PRIORITY_CLASS.items():
        category = F.when(priority == key, name) if category is None else category.when(priority == key, name)
    names = [c for c in made.columns if c not in ("stcpb", "o_orderstatus", "o_orderpriority")]
    return made.select(
        "stcpb", *names,
        F.nullif("o_orderstatus", F.lit("P")).alias("service"),
        category.alias("attack_cat"),
        priority.isin("1-URGENT", "2-HIGH", "3-MEDIUM").cast("int").alias("label"),
    )


FLOWS_SQL = PACKETS_SQL + """,
flows AS (
  SELECT packets.*, nullif(o_orderstatus, 'P') AS service,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'DoS' WHEN '2-HIGH' THEN '  Fuzzers '
              WHEN '3-MEDIUM' THEN 'Backdoors' WHEN '4-NOT SPECIFIED' THEN '' END AS attack_cat,
         CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN 1 ELSE 0 END AS label
  FROM packets JOIN orders ON stcpb = o_orderkey),
named AS (
  SELECT * REPLACE (CASE WHEN attack_cat IS NULL OR trim(attack_cat) = '' THEN 'Normal'
                         WHEN trim(attack_cat) = 'Backdoors' THEN 'Backdoor'
                         ELSE trim(attack_cat) END AS attack_cat)
  FROM flows)"""


def named_flows(spark: SparkSession, sf: str) -> DataFrame:
    """Flows with tidy class names."""
    return flows(spark, sf).withColumn("attack_cat", attack_name("attack_cat"))


# ---- predictions --------------------------------------------------------

def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Flows with a rule as the model: one class is never predicted, one never true."""
    big = F.col("sbytes") > 25
    by_protocol = (F.when(F.col("proto") == "R", "DoS").when(F.col("proto") == "A", "Fuzzers")
                   .otherwise("Exploits"))
    return named_flows(spark, sf).select(
        "srcip", "dstip", "proto", "service", "state", "start_clock", "spkts",
        F.col("attack_cat").alias("label"),
        by_protocol.alias("pred_stage2"),
        (F.col("attack_cat") != "Normal").cast("int").alias("is_attack"),
        big.cast("int").alias("pred_stage1"),
        F.col("dload_raw").alias("score"),
        (F.col("sbytes") / 50).alias("attack_probability"),
    )


PREDICTIONS_SQL = FLOWS_SQL + """,
predictions AS (
  SELECT srcip, dstip, proto, service, state, start_clock, spkts, attack_cat AS label,
         CASE proto WHEN 'R' THEN 'DoS' WHEN 'A' THEN 'Fuzzers' ELSE 'Exploits' END AS pred_stage2,
         CASE WHEN attack_cat <> 'Normal' THEN 1 ELSE 0 END AS is_attack,
         CASE WHEN sbytes > 25 THEN 1 ELSE 0 END AS pred_stage1,
         dload_raw AS score, sbytes / 50 AS attack_probability
  FROM named),
final AS (
  SELECT *, CASE WHEN pred_stage1 = 0 THEN 'Normal' ELSE pred_stage2 END AS prediction FROM predictions),
confusion AS (
  SELECT label, prediction, count(*) AS n FROM final GROUP BY ALL),
classes AS (
  SELECT c AS class FROM (SELECT label AS c FROM confusion UNION SELECT prediction FROM confusion)),
scores AS (
  SELECT class, support, predicted, hits,
         CASE WHEN predicted = 0 THEN 0.0 ELSE hits / predicted END AS precision,
         CASE WHEN support = 0 THEN 0.0 ELSE hits / support END AS recall,
         CASE WHEN hits = 0 THEN 0.0
              ELSE 2.0 * (hits / predicted) * (hits / support) / (hits / predicted + hits / support) END AS f1
  FROM (SELECT class,
               CAST(coalesce((SELECT sum(n) FROM confusion WHERE label = class), 0) AS DOUBLE) AS support,
               CAST(coalesce((SELECT sum(n) FROM confusion WHERE prediction = class), 0) AS DOUBLE) AS predicted,
               CAST(coalesce((SELECT sum(n) FROM confusion
                              WHERE label = class AND prediction = class), 0) AS DOUBLE) AS hits
        FROM classes))"""


# ---- alerts -------------------------------------------------------------

# Which class an event type stands for.
EVENT_CLASS = {"click": "Normal", "error": "DoS", "purchase": "Exploits", "signup": "Fuzzers",
               "view": "Reconnaissance"}


def alerts(spark: SparkSession, sf: str) -> DataFrame:
    return alerts_of(table(spark, sf, "events"))


def alerts_of(events: DataFrame) -> DataFrame:
    """Events in alert layout; ``lifecycle`` is a second, five-state status."""
    kind = F.col("event_type")
    category = None
    for key, name in EVENT_CLASS.items():
        category = F.when(kind == key, name) if category is None else category.when(kind == key, name)
    handled = F.col("event_id") % 3 == 0
    phase = F.col("event_id") % 5
    return events.select(
        F.col("event_id").cast("string").alias("id"),
        F.concat(F.lit("u"), "user_id").alias("srcip"),
        F.lit("unknown").alias("dstip"), F.lit("unknown").alias("proto"),
        F.lit("-").alias("service"), F.lit("unknown").alias("state"),
        category.alias("attack_cat"),
        F.least(F.col("value") / 100, F.lit(1.0)).alias("confidence"),
        F.get_json_object("props", "$.k").cast("int").alias("threat_score"),
        F.when(handled, "handled").otherwise("pending").alias("status"),
        F.when(handled, "analyst").alias("resolved_by"),
        F.when(handled, F.col("ts")).alias("resolved_at"),
        F.when(phase == 0, "streaming").when(phase == 1, "external").when(phase == 2, None)
        .otherwise("external-feed").alias("source"),
        F.col("ts").alias("timestamp"),
        F.when(phase == 0, "unverified").when(phase == 1, "confirmed").when(phase == 2, "resolved")
        .when(phase == 3, "false_positive").alias("lifecycle"),
    )


ALERTS_SQL = """
alerts AS (
  SELECT CAST(event_id AS VARCHAR) AS id, 'u' || user_id AS srcip, 'unknown' AS dstip, 'unknown' AS proto,
         '-' AS service, 'unknown' AS state,
         CASE event_type WHEN 'click' THEN 'Normal' WHEN 'error' THEN 'DoS' WHEN 'purchase' THEN 'Exploits'
              WHEN 'signup' THEN 'Fuzzers' WHEN 'view' THEN 'Reconnaissance' END AS attack_cat,
         least(value / 100, 1.0) AS confidence,
         CAST(json_extract_string(props, '$.k') AS INT) AS threat_score,
         CASE WHEN event_id % 3 = 0 THEN 'handled' ELSE 'pending' END AS status,
         CASE WHEN event_id % 3 = 0 THEN 'analyst' END AS resolved_by,
         CASE WHEN event_id % 3 = 0 THEN ts END AS resolved_at,
         CASE event_id % 5 WHEN 0 THEN 'streaming' WHEN 1 THEN 'external' WHEN 2 THEN NULL
              ELSE 'external-feed' END AS source,
         ts AS timestamp,
         CASE event_id % 5 WHEN 0 THEN 'unverified' WHEN 1 THEN 'confirmed' WHEN 2 THEN 'resolved'
              WHEN 3 THEN 'false_positive' END AS lifecycle
  FROM events)"""


def latest(alerts_df: DataFrame) -> Column:
    """The newest alert time, standing in for the current time."""
    return alerts_df.agg(F.max("timestamp")).scalar()


def updates(spark: SparkSession, sf: str) -> DataFrame:
    return updates_of(table(spark, sf, "events"))


def updates_of(events: DataFrame) -> DataFrame:
    """Status updates: several per alert, some invalid, some for unknown alerts."""
    target = F.col("event_id") - F.when(F.col("event_type") == "click", 1).otherwise(0)
    return events.select(
        F.when(F.col("event_type") == "error", F.concat(F.lit("x"), "event_id"))
        .otherwise(target.cast("string")).alias("id"),
        F.when(F.col("event_type") == "signup", "pending").when(F.col("value") > 90, "closed")
        .otherwise("handled").alias("status"),
        F.when(F.col("user_id") % 7 == 0, "  ").when(F.col("user_id") % 11 == 0, None)
        .otherwise(F.concat(F.lit(" user"), "user_id", F.lit(" "))).alias("resolved_by"),
        F.col("ts").alias("resolved_at"),
    )


UPDATES_SQL = ALERTS_SQL + """,
updates AS (
  SELECT CASE WHEN event_type = 'error' THEN 'x' || event_id
              ELSE CAST(event_id - CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS VARCHAR) END AS id,
         CASE WHEN event_type = 'signup' THEN 'pending' WHEN value > 90 THEN 'closed' ELSE 'handled' END AS status,
         CASE WHEN user_id % 7 = 0 THEN '  ' WHEN user_id % 11 = 0 THEN NULL
              ELSE ' user' || user_id || ' ' END AS resolved_by,
         ts AS resolved_at
  FROM events),
accepted AS (
  SELECT id, status, trim(resolved_by) AS resolved_by, resolved_at FROM updates
  WHERE status IN ('pending', 'handled') AND trim(coalesce(resolved_by, '')) <> ''),
last_update AS (
  SELECT * FROM accepted
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY resolved_at DESC, status DESC, resolved_by DESC) = 1)"""
