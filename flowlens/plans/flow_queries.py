"""Cleaning, profiles, exploration, windows and graph queries over flows."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowlens.functions.columns import (
    attack_name, bytes_ratio, handshake_time, is_attack, same_endpoint, to_double, to_int, utc_clock,
)
from flowlens.operators import daily, explore, graph, growing_graph, profile, sequence, split
from flowlens.operators.clean import clean_flows, lower_names
from flowlens.operators.encode import category_codes, encode
from flowlens.operators.sampling import class_weights, sample_by_hash, undersample, with_class_weights
from flowlens.plans.adapters import FLOW_ORDER, FLOWS_SQL, PACKETS_SQL, flows, named_flows, packets, table
from flowlens.plans.registry import Registry, r6
from flowlens.runtime import materialise, scratch_path
from flowlens.schema import PROFILE_MEASURES, flow_schema
from flowlens.sources.readers import read_flows, read_named_csv, read_partition
from flowlens.sources.writers import as_messages, write_table
from flowlens.streaming.ingest import decode_json

REG = Registry()
PACKETS, FLOWS = "WITH" + PACKETS_SQL, "WITH" + FLOWS_SQL


def _averages_sql(key: str, rounded: bool = True) -> str:
    cut = "round(avg({m}), 6)" if rounded else "avg({m})"
    return ", ".join(f"{cut.format(m=m)} AS avg_{m}_{key}" for m in PROFILE_MEASURES)


def _usual(key: str) -> list:
    return [r6(f"avg_{m}_{key}") for m in PROFILE_MEASURES]


# ---- cleaning -----------------------------------------------------------

@REG.add("clean_attack_cat", FLOWS + " SELECT attack_cat, count(*) AS n FROM named GROUP BY 1")
def _(spark, sf):
    return explore.category_counts(flows(spark, sf).select(attack_name("attack_cat").alias("attack_cat")))


@REG.add("clean_attack_cat_keep_null", FLOWS + """
 SELECT replace(trim(attack_cat), 'Backdoors', 'Backdoor') AS attack_cat, count(*) AS n FROM flows GROUP BY 1""")
def _(spark, sf):
    return explore.category_counts(
        flows(spark, sf).select(attack_name("attack_cat", null_as_normal=False).alias("attack_cat")))


@REG.add("clean_flows", FLOWS + """
 SELECT proto, state, coalesce(service, 'Unknown') AS service, attack_cat, dur, sbytes,
        round(dbytes, 6) AS dbytes, sload, coalesce(dload, 0.0) AS dload, dload_raw, spkts, dpkts, start_clock
 FROM named""")
def _(spark, sf):
    return clean_flows(flows(spark, sf)).withColumn("dbytes", r6("dbytes"))


@REG.add("is_attack_counts", FLOWS + """
 SELECT CASE WHEN attack_cat = 'Normal' THEN 0 ELSE 1 END AS is_attack, count(*) AS n FROM named GROUP BY 1""")
def _(spark, sf):
    return explore.attack_flag_counts(named_flows(spark, sf))


@REG.add("bytes_ratio", PACKETS + """
 SELECT srcip, dstip, sbytes, round(CASE WHEN dbytes = 0 THEN 0.0 ELSE sbytes / dbytes END, 6) AS bytes_ratio
 FROM packets""")
def _(spark, sf):
    return packets(spark, sf).select("srcip", "dstip", "sbytes", r6(bytes_ratio(), "bytes_ratio"))


@REG.add("event_time", PACKETS + """
 SELECT srcip, dstip, CAST(epoch(start_clock) AS BIGINT) AS stime, start_clock AS event_time FROM packets""")
def _(spark, sf):
    return packets(spark, sf).select("srcip", "dstip", "stime", utc_clock("stime").alias("event_time"))


@REG.add("derived_flags", PACKETS + """
 SELECT CASE WHEN 's' || dtcpb = srcip AND sport = dsport THEN 1 ELSE 0 END AS is_sm_ips_ports,
        round(dur + dload_raw, 6) AS tcprtt, count(*) AS n
 FROM packets GROUP BY ALL""")
def _(spark, sf):
    flagged = packets(spark, sf).withColumns({
        "dstip": F.concat(F.lit("s"), "dtcpb"), "synack": F.col("dur"), "ackdat": F.col("dload_raw")})
    return (flagged.select(same_endpoint().alias("is_sm_ips_ports"), r6(handshake_time(), "tcprtt"))
            .groupBy("is_sm_ips_ports", "tcprtt").agg(F.count("*").alias("n")))


# ---- profiles -----------------------------------------------------------

@REG.add("proto_stats", PACKETS + f" SELECT proto, {_averages_sql('proto')} FROM packets GROUP BY 1")
def _(spark, sf):
    return profile.key_averages(packets(spark, sf), "proto").select("proto", *_usual("proto"))


@REG.add("state_stats", PACKETS + f" SELECT state, {_averages_sql('state')} FROM packets GROUP BY 1")
def _(spark, sf):
    return profile.key_averages(packets(spark, sf), "state").select("state", *_usual("state"))


@REG.add("proto_stats_by_days", PACKETS + f" SELECT proto, {_averages_sql('proto')} FROM packets GROUP BY 1")
def _(spark, sf):
    """The same averages from the states of the months, added year by year; the last year is added twice."""
    path, rows = scratch_path(spark, "days"), packets(spark, sf)
    year = F.year("start_clock")
    first, last = rows.agg(F.min(year), F.max(year)).first()
    for y in [*range(first, last + 1), last] if first is not None else ():
        daily.add_days(rows.filter(year == y), path, F.trunc("start_clock", "month"))
    return daily.profile_of_days(spark, path).tables["proto"].select("proto", *_usual("proto"))


def _enrich_sql(key: str) -> str:
    return PACKETS + f""", stats AS (SELECT {key}, {_averages_sql(key)} FROM packets GROUP BY 1)
 SELECT srcip, dstip, {key}, {', '.join(f'avg_{m}_{key}' for m in PROFILE_MEASURES)}
 FROM packets LEFT JOIN stats USING ({key})"""


@REG.add("enrich_proto", _enrich_sql("proto"))
def _(spark, sf):
    rows = packets(spark, sf)
    learned = profile.fit_profile(rows, ["proto"])
    return (profile.attach_usual(rows, learned.tables["proto"], "proto")
            .select("srcip", "dstip", "proto", *_usual("proto")))


@REG.add("enrich_state", _enrich_sql("state"))
def _(spark, sf):
    rows = packets(spark, sf)
    learned = profile.fit_profile(rows, ["state"])
    return (profile.attach_usual(rows, learned.tables["state"], "state")
            .select("srcip", "dstip", "state", *_usual("state")))


_THREAT = """0.5 * abs(sbytes - avg_sbytes_proto) / (avg_sbytes_proto + 1)
             + 0.5 * abs(sload - avg_sload_proto) / (avg_sload_proto + 1)"""


@REG.add("enrich_unseen_proto", PACKETS + f""",
 p AS (SELECT proto, {_averages_sql('proto', False)} FROM packets WHERE proto <> 'R' GROUP BY 1),
 s AS (SELECT state, {_averages_sql('state', False)} FROM packets WHERE proto <> 'R' GROUP BY 1)
 SELECT srcip, dstip, proto, state,
        round(CASE WHEN dbytes = 0 THEN 0.0 ELSE sbytes / dbytes END, 6) AS bytes_ratio,
        {', '.join(f'round(coalesce(avg_{m}_proto, 0.0), 6) AS avg_{m}_proto' for m in PROFILE_MEASURES)},
        {', '.join(f'round(coalesce(avg_{m}_state, 0.0), 6) AS avg_{m}_state' for m in PROFILE_MEASURES)},
        round(coalesce({_THREAT}, 0.0), 6) AS threat_score
 FROM packets LEFT JOIN p USING (proto) LEFT JOIN s USING (state)""")
def _(spark, sf):
    rows = packets(spark, sf)
    learned = profile.fit_profile(rows.filter("proto <> 'R'"))
    return profile.enrich(rows, learned).select(
        "srcip", "dstip", "proto", "state", r6("bytes_ratio"), *_usual("proto"), *_usual("state"),
        r6("threat_score"))


_STATS = f"stats AS (SELECT proto, {_averages_sql('proto', False)} FROM packets GROUP BY 1)"


@REG.add("threat_score", PACKETS + f""", {_STATS}
 SELECT srcip, dstip, proto, sbytes, sload, round({_THREAT}, 6) AS threat_score
 FROM packets JOIN stats USING (proto)""")
def _(spark, sf):
    rows = packets(spark, sf)
    scored = profile.enrich(rows, profile.fit_profile(rows, ["proto"]))
    return scored.select("srcip", "dstip", "proto", "sbytes", "sload", r6("threat_score"))


def threat_by_category(spark, sf):
    """Clean, learn, enrich, score, summarise: the batch job from end to end."""
    cleaned = clean_flows(flows(spark, sf), drop=[])
    scored = profile.enrich(cleaned, profile.fit_profile(packets(spark, sf), ["proto"]))
    return explore.threat_by_category(scored).select(
        "attack_cat", r6("avg_threat"), r6("max_threat"), r6("threat_volatility"))


REG.add("threat_by_category", FLOWS + f""", {_STATS}
 SELECT attack_cat, round(avg(t), 6) AS avg_threat, round(max(t), 6) AS max_threat,
        round(stddev_samp(t), 6) AS threat_volatility
 FROM (SELECT attack_cat, {_THREAT} AS t FROM named JOIN stats USING (proto)) GROUP BY 1""")(threat_by_category)


# ---- split --------------------------------------------------------------

@REG.add("chrono_split", PACKETS + """,
 cut AS (SELECT quantile_disc(stime, 0.8) AS t FROM packets)
 SELECT CASE WHEN stime <= t THEN 'train' ELSE 'test' END AS side, count(*) AS n,
        min(stime) AS first_stime, max(stime) AS last_stime
 FROM packets, cut GROUP BY 1""")
def _(spark, sf):
    parts = split.chronological_split(packets(spark, sf), method="exact")
    both = (parts.train.select("stime", F.lit("train").alias("side"))
            .unionByName(parts.test.select("stime", F.lit("test").alias("side"))))
    return both.groupBy("side").agg(F.count("*").alias("n"), F.min("stime").alias("first_stime"),
                                    F.max("stime").alias("last_stime"))


@REG.add("split_counts", PACKETS + """,
 cut AS (SELECT quantile_disc(stime, 0.8) AS t FROM packets)
 SELECT count(*) AS n_rows, count(*) FILTER (stime <= t) AS n_train, count(*) FILTER (stime > t) AS n_test,
        count(*) FILTER (stime IS NULL) AS n_untimed, CAST(18 AS BIGINT) AS n_columns
 FROM packets, cut""")
def _(spark, sf):
    rows = packets(spark, sf)
    return split.split_counts(rows, split.exact_quantile(rows, "stime", 0.8))


# ---- exploration --------------------------------------------------------

@REG.add("labelled_count", FLOWS + " SELECT count(*) AS n FROM flows WHERE attack_cat IS NOT NULL")
def _(spark, sf):
    return explore.labelled(flows(spark, sf)).agg(F.count("*").alias("n"))


@REG.add("outlier_by_cat", FLOWS + " SELECT attack_cat, count(*) AS n FROM named WHERE dur = 0.08 GROUP BY 1")
def _(spark, sf):
    return explore.value_counts_where(named_flows(spark, sf), "dur", 0.08)


@REG.add("dos_by_proto", FLOWS + """
 SELECT proto, round(avg(sbytes), 6) AS avg_sbytes, round(avg(dur), 6) AS avg_dur, count(*) AS n
 FROM named WHERE attack_cat = 'DoS' GROUP BY 1 ORDER BY n DESC, proto LIMIT 10""")
def _(spark, sf):
    return explore.protocols_of(named_flows(spark, sf), "DoS").select("proto", r6("avg_sbytes"), r6("avg_dur"), "n")


@REG.add("category_counts", FLOWS + " SELECT attack_cat, count(*) AS n FROM flows GROUP BY 1")
def _(spark, sf):
    return explore.category_counts(flows(spark, sf))


@REG.add("distinct_categories", FLOWS + " SELECT DISTINCT attack_cat FROM flows")
def _(spark, sf):
    return explore.distinct_categories(flows(spark, sf))


@REG.add("describe_dur", PACKETS + """
 SELECT count(dur) AS n, round(avg(dur), 6) AS mean, round(stddev_samp(dur), 6) AS stddev,
        min(dur) AS min, max(dur) AS max FROM packets""")
def _(spark, sf):
    return explore.describe_column(packets(spark, sf), "dur").select("n", r6("mean"), r6("stddev"), "min", "max")


@REG.add("packets_5m", PACKETS + """
 SELECT time_bucket(INTERVAL 5 MINUTE, start_clock) AS window_start,
        time_bucket(INTERVAL 5 MINUTE, start_clock) + INTERVAL 5 MINUTE AS window_end, count(*) AS packet_count
 FROM packets GROUP BY ALL""")
def _(spark, sf):
    return explore.window_counts(packets(spark, sf), "start_clock", count_name="packet_count")


@REG.add("class_distribution", FLOWS + """,
 c AS (SELECT attack_cat, count(*) AS n FROM named GROUP BY 1)
 SELECT attack_cat, n, round(100.0 * n / (SELECT sum(n) FROM c), 6) AS pct,
        CASE WHEN n / (SELECT sum(n) FROM c) >= 0.05
             THEN CAST(CAST(round(100.0 * n / (SELECT sum(n) FROM c)) AS INT) AS VARCHAR) || '%' END AS pct_label
 FROM c""")
def _(spark, sf):
    return explore.class_distribution(named_flows(spark, sf)).select("attack_cat", "n", r6("pct"), "pct_label")


@REG.add("top_talkers", PACKETS + """
 SELECT srcip, count(*) AS connection_count FROM packets GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")
def _(spark, sf):
    return explore.top_talkers(packets(spark, sf))


@REG.add("attack_sources", FLOWS + """
 SELECT srcip, count(*) AS attack_count FROM flows WHERE label = 1 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")
def _(spark, sf):
    return explore.top_attack_sources(flows(spark, sf))


@REG.add("attack_counts_partitioned", FLOWS + """
 SELECT attack_cat, count(*) AS n FROM named WHERE label = 1 GROUP BY 1""")
def _(spark, sf):
    path = scratch_path(spark, "flows-by-label")
    write_table(named_flows(spark, sf).select("attack_cat", "proto", "label"), path, partition_by=["label"])
    return explore.category_counts(read_partition(spark, path, "label", 1))


# ---- learning helpers ---------------------------------------------------

_WEIGHTS = """,
 c AS (SELECT attack_cat, count(*) AS n FROM flows GROUP BY 1)"""


@REG.add("class_weights", FLOWS + _WEIGHTS + """
 SELECT attack_cat, n, round(CASE WHEN attack_cat IS NULL THEN 1.0
        ELSE (SELECT sum(n) FROM c) / ((SELECT count(*) FROM c) * n) END, 6) AS class_weight FROM c""")
def _(spark, sf):
    return class_weights(flows(spark, sf)).select("attack_cat", "n", r6("class_weight"))


@REG.add("class_weights_per_row", FLOWS + _WEIGHTS + """
 SELECT srcip, dstip, f.attack_cat, round(CASE WHEN f.attack_cat IS NULL THEN 1.0
        ELSE (SELECT sum(n) FROM c) / ((SELECT count(*) FROM c) * n) END, 6) AS class_weight
 FROM flows f JOIN c ON f.attack_cat IS NOT DISTINCT FROM c.attack_cat""")
def _(spark, sf):
    return with_class_weights(flows(spark, sf)).select("srcip", "dstip", "attack_cat", r6("class_weight"))


@REG.add("undersample_exact", FLOWS + """
 SELECT attack_cat, least(count(*), 5000) AS n FROM named GROUP BY 1""")
def _(spark, sf):
    return undersample(named_flows(spark, sf), "attack_cat").groupBy("attack_cat").agg(F.count("*").alias("n"))


@REG.add("sample_rows", PACKETS + """
 SELECT srcip, dstip, stcpb FROM packets WHERE md5(concat_ws('|', srcip, dstip, CAST(stcpb AS VARCHAR))) < '19999999'""")
def _(spark, sf):
    return sample_by_hash(packets(spark, sf), ["srcip", "dstip", "stcpb"]).select("srcip", "dstip", "stcpb")


_CODES = """,
 codes AS (
  SELECT 'proto' AS col, proto AS value, CAST(dense_rank() OVER (ORDER BY proto) - 1 AS INT) AS code
  FROM (SELECT DISTINCT proto FROM flows WHERE proto IS NOT NULL)
  UNION ALL
  SELECT 'service', service, CAST(dense_rank() OVER (ORDER BY service) - 1 AS INT)
  FROM (SELECT DISTINCT service FROM flows WHERE service IS NOT NULL)
  UNION ALL
  SELECT 'state', state, CAST(dense_rank() OVER (ORDER BY state) - 1 AS INT)
  FROM (SELECT DISTINCT state FROM flows WHERE state IS NOT NULL))"""


@REG.add("category_codes", FLOWS + _CODES + ' SELECT col AS "column", value, code FROM codes')
def _(spark, sf):
    return category_codes(flows(spark, sf), ["state", "proto", "service"])


@REG.add("encode_category", FLOWS + _CODES + """
 SELECT srcip, dstip, proto, service, p.code AS proto_code, coalesce(s.code, -1) AS service_code
 FROM flows JOIN codes p ON p.col = 'proto' AND p.value = proto
 LEFT JOIN codes s ON s.col = 'service' AND s.value = service""")
def _(spark, sf):
    rows = flows(spark, sf)
    codes = category_codes(rows, ["proto", "service"])
    return encode(rows, codes, ["proto", "service"]).select(
        "srcip", "dstip", "proto", "service", "proto_code", "service_code")


# ---- sequence -----------------------------------------------------------

_ORDER_SQL = ", ".join(FLOW_ORDER)


@REG.add("synthetic_ts", PACKETS + f"""
 SELECT srcip, dstip, stcpb, to_timestamp_seconds_utc AS "timestamp" FROM (
  SELECT *, TIMESTAMP '1970-01-01' + to_seconds(1421927414 + row_number() OVER (ORDER BY {_ORDER_SQL}))
         AS to_timestamp_seconds_utc FROM packets)""")
def _(spark, sf):
    rows = packets(spark, sf).select("dstip", *FLOW_ORDER)
    stamped = sequence.synthetic_timestamps(rows, FLOW_ORDER)
    return stamped.select("srcip", "dstip", "stcpb", utc_clock(F.unix_seconds("timestamp")).alias("timestamp"))


@REG.add("category_5m", FLOWS + f""",
 t AS (SELECT attack_cat, TIMESTAMP '1970-01-01'
         + to_seconds(1421927414 + row_number() OVER (ORDER BY {_ORDER_SQL})) AS ts FROM flows)
 SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start,
        time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE AS window_end, attack_cat, count(*) AS n
 FROM t WHERE attack_cat IS NOT NULL GROUP BY ALL""")
def _(spark, sf):
    return explore.window_counts(explore.labelled(_stamped(spark, sf)), "ts", by=["attack_cat"])


@REG.add("hour_category_pivot", FLOWS + f""",
 t AS (SELECT attack_cat, TIMESTAMP '1970-01-01'
         + to_seconds(1421927414 + row_number() OVER (ORDER BY {_ORDER_SQL})) AS ts FROM named)
 SELECT CAST(hour(ts) AS INT) AS hour,
        {', '.join(f"nullif(count(*) FILTER (attack_cat = '{c}'), 0) AS {c}"
                   for c in ("Normal", "Backdoor", "DoS", "Fuzzers", "Worms"))},
        nullif(count(*) FILTER (attack_cat NOT IN ('Normal', 'Backdoor', 'DoS', 'Fuzzers', 'Worms')), 0) AS other
 FROM t GROUP BY 1""")
def _(spark, sf):
    stamped = _stamped(spark, sf).withColumn("attack_cat", attack_name("attack_cat"))
    return explore.hour_pivot(stamped, "ts", ["Normal", "Backdoor", "DoS", "Fuzzers", "Worms"])


@REG.add("hour_pivot_unlisted", """
 SELECT CAST(hour(ts) AS INT) AS hour, nullif(count(*) FILTER (event_type = 'click'), 0) AS click,
        nullif(count(*) FILTER (event_type <> 'click'), 0) AS other
 FROM events GROUP BY 1""")
def _(spark, sf):
    """Classes that the caller does not list are counted together."""
    return explore.hour_pivot(table(spark, sf, "events"), "ts", ["click"], "event_type")


def _stamped(spark, sf):
    rows = flows(spark, sf).select("attack_cat", *FLOW_ORDER)
    return (sequence.synthetic_timestamps(rows, FLOW_ORDER)
            .select("attack_cat", utc_clock(F.unix_seconds("timestamp")).alias("ts")))


def _last_connections_sql(names: list[str]) -> str:
    counts = ", ".join(
        f"count(*) OVER (PARTITION BY {', '.join(sequence.CONNECTION_COUNTS[n])} ORDER BY seq"
        f" RANGE BETWEEN 99 PRECEDING AND CURRENT ROW) AS {n}" for n in names)
    keys = sorted({k for n in names for k in sequence.CONNECTION_COUNTS[n]})
    return FLOWS + f""",
 numbered AS (SELECT *, row_number() OVER (ORDER BY {_ORDER_SQL}) AS seq FROM flows)
 SELECT stime, stcpb, {', '.join(keys)}, {counts} FROM numbered"""


def _last_connections(names: list[str]):
    keys = sorted({k for n in names for k in sequence.CONNECTION_COUNTS[n]})

    def query(spark, sf):
        columns = list(dict.fromkeys([*FLOW_ORDER, *keys]))
        source = flows if "service" in keys else packets
        rows = source(spark, sf).select(*columns)
        return sequence.connection_counts(rows, FLOW_ORDER, names).select("stime", "stcpb", *keys, *names)
    return query


REG.add("connection_counts", _last_connections_sql(list(sequence.CONNECTION_COUNTS)))(
    _last_connections(list(sequence.CONNECTION_COUNTS)))
for _name in sequence.CONNECTION_COUNTS:
    REG.add(f"{_name}_100", _last_connections_sql([_name]))(_last_connections([_name]))


# ---- graph --------------------------------------------------------------

_EDGES = FLOWS + ", edges AS (SELECT srcip AS src, dstip AS dst, label FROM flows)"
_LINKS = PACKETS + ", edges AS (SELECT srcip AS src, dstip AS dst FROM packets)"


@REG.add("ip_graph_vertices", _LINKS + " SELECT src AS id FROM edges UNION SELECT dst FROM edges")
def _(spark, sf):
    return graph.graph_vertices(packets(spark, sf))


@REG.add("ip_graph_edges", _EDGES + " SELECT * FROM edges")
def _(spark, sf):
    return graph.graph_edges(flows(spark, sf))


@REG.add("ip_graph_size", _LINKS + """
 SELECT (SELECT count(*) FROM (SELECT src FROM edges UNION SELECT dst FROM edges)) AS n_vertices,
        (SELECT count(*) FROM edges) AS n_edges""")
def _(spark, sf):
    return graph.graph_size(packets(spark, sf))


@REG.add("ip_degrees", _LINKS + """
 SELECT id, CAST(sum(o) AS BIGINT) AS out_degree, CAST(sum(i) AS BIGINT) AS in_degree, count(*) AS degree
 FROM (SELECT src AS id, 1 AS o, 0 AS i FROM edges UNION ALL SELECT dst, 0, 1 FROM edges) GROUP BY 1""")
def _(spark, sf):
    return graph.degrees(packets(spark, sf).select(F.col("srcip").alias("src"), F.col("dstip").alias("dst")))


@REG.add("ip_components", "WITH RECURSIVE" + PACKETS_SQL + """,
 edges AS (SELECT DISTINCT strftime(start_clock, '%Y-%m-%d') || '/' || srcip AS src,
                  strftime(start_clock, '%Y-%m-%d') || '/' || dstip AS dst FROM packets),
 links AS (SELECT src AS a, dst AS b FROM edges UNION SELECT dst, src FROM edges),
 reach AS (SELECT a AS id, a AS other FROM links UNION SELECT r.id, l.b FROM reach r JOIN links l ON l.a = r.other)
 SELECT id, min(other) AS component FROM reach GROUP BY 1""")
def _(spark, sf):
    """Components of the traffic of each day, all days in one graph."""
    day = F.date_format("start_clock", "yyyy-MM-dd")
    edges = packets(spark, sf).select(
        F.concat(day, F.lit("/"), "srcip").alias("src"), F.concat(day, F.lit("/"), "dstip").alias("dst"))
    return graph.connected_components(edges)


@REG.add("ip_components_by_batches", REG.sql["ip_components"])
def _(spark, sf):
    """The components of the traffic of each day, its edges added in three batches."""
    path, day = scratch_path(spark, "growing-graph"), F.date_format("start_clock", "yyyy-MM-dd")
    edges = packets(spark, sf).select(
        F.concat(day, F.lit("/"), "srcip").alias("src"), F.concat(day, F.lit("/"), "dstip").alias("dst"),
        F.pmod("stcpb", F.lit(3)).alias("batch"))
    for batch in range(3):
        growing_graph.add_edges(edges.filter(F.col("batch") == batch), path)
    return growing_graph.components(spark, path)


@REG.add("ip_bfs", "WITH RECURSIVE" + PACKETS_SQL + """,
 links AS (SELECT srcip AS a, dstip AS b FROM packets UNION SELECT dstip, srcip FROM packets),
 walk AS (SELECT 's1' AS id, 0 AS distance UNION
          SELECT l.b, w.distance + 1 FROM walk w JOIN links l ON l.a = w.id WHERE w.distance < 8),
 near AS (SELECT id, min(distance) AS distance FROM walk GROUP BY 1)
 SELECT n.id, n.distance, min(p.id) AS via
 FROM near n LEFT JOIN (links l JOIN near p ON p.id = l.a) ON l.b = n.id AND p.distance = n.distance - 1
 GROUP BY 1, 2""")
def _(spark, sf):
    edges = packets(spark, sf).select(F.col("srcip").alias("src"), F.col("dstip").alias("dst"))
    return graph.shortest_paths(edges, "s1", directed=False)


@REG.add("ip_bfs_deep", """
WITH RECURSIVE links AS (
   SELECT DISTINCT strftime(date_trunc('quarter', o_orderdate), '%Y-%m') AS a,
          strftime(date_trunc('quarter', o_orderdate) + INTERVAL 3 MONTH, '%Y-%m') AS b FROM orders),
 walk AS (SELECT min(a) AS id, 0 AS distance FROM links UNION ALL
          SELECT l.b, w.distance + 1 FROM walk w JOIN links l ON l.a = w.id)
 SELECT id, distance, CASE WHEN distance > 0 THEN strftime(CAST(id || '-01' AS DATE) - INTERVAL 3 MONTH, '%Y-%m') END AS via
 FROM walk""")
def _(spark, sf):
    """A walk of more than twenty hops: every order leads from its quarter to the next."""
    quarter = F.date_trunc("quarter", "o_orderdate")
    edges = table(spark, sf, "orders").select(
        F.date_format(quarter, "yyyy-MM").alias("src"), F.date_format(F.add_months(quarter, 3), "yyyy-MM").alias("dst"))
    return graph.shortest_paths(edges, edges.agg(F.min("src")).first()[0])


# ---- files and messages -------------------------------------------------

_LAYOUT = ["srcip", "sport", "dstip", "dsport", "proto", "state", "dur", "sbytes", "dbytes", "service",
           "sload", "dload", "spkts", "dpkts", "stcpb", "dtcpb", "stime", "attack_cat", "label"]
_LAYOUT_SQL = FLOWS + """
 SELECT srcip, sport, dstip, dsport, proto, state, dur, CAST(sbytes AS INT) AS sbytes,
        CAST(floor(dbytes) AS INT) AS dbytes, service, sload, dload, spkts, dpkts, stcpb, dtcpb,
        CAST(stime AS INT) AS stime, {cat} AS attack_cat, label FROM flows"""


def _in_layout(spark, sf):
    """Flows with all 49 columns in file order; columns the tables lack are NULL."""
    rows = flows(spark, sf).withColumn("dbytes", F.floor("dbytes"))
    return rows.select(*[
        (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in flow_schema().fields])


@REG.add("flows_csv_roundtrip", _LAYOUT_SQL.format(cat="nullif(trim(attack_cat), '')"))
def _(spark, sf):
    path = scratch_path(spark, "flows-csv")
    _in_layout(spark, sf).write.csv(path, header=False, compression="gzip")
    back = read_flows(spark, path).withColumn("attack_cat", F.nullif(F.trim("attack_cat"), F.lit("")))
    return back.select(*_LAYOUT)


@REG.add("flows_json_roundtrip", _LAYOUT_SQL.format(cat="attack_cat"))
def _(spark, sf):
    return decode_json(as_messages(_in_layout(spark, sf), order=None), flow_schema()).select(*_LAYOUT)


@REG.add("flows_to_json")
def _(spark, sf):
    return as_messages(_in_layout(spark, sf).select(*_LAYOUT))


@REG.add("messages_in_order", PACKETS + " SELECT row_number() OVER (ORDER BY stime) AS place, stime FROM packets")
def _(spark, sf):
    """The time of the n-th message: messages of several tasks stand in time order."""
    sent = as_messages(packets(spark, sf)).withColumn("_sent", F.monotonically_increasing_id())
    # the messages are read where they lie; only place and time are moved
    read = materialise(sent, "sent").select("_sent", F.get_json_object("value", "$.stime").cast("long").alias("stime"))
    return sequence.dense_index(read, ["_sent"], "place", unique=True).select("place", "stime")


_NAMED = ["srcip", "dstip", "sport", "stcpb", "stime", "proto"]


@REG.add("named_csv_roundtrip", PACKETS + """
 SELECT srcip, dstip, CAST(sport AS INT) AS sport, CAST(stcpb AS INT) AS stcpb, CAST(stime AS INT) AS stime, proto FROM packets""")
def _(spark, sf):
    """A CSV without header, named by a description table; types are inferred."""
    path = scratch_path(spark, "named-csv")
    packets(spark, sf).select(*_NAMED).write.csv(path, header=False)
    names = spark.createDataFrame([(i + 1, f" {n.upper()} ") for i, n in enumerate(_NAMED)], "`No.` int, Name string")
    return lower_names(read_named_csv(spark, path, names))


@REG.add("free_form_numbers", """
WITH told AS (SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN ' ' || o_custkey || ' ' WHEN 1 THEN '' WHEN 2 THEN o_orderpriority
              WHEN 3 THEN '-' ELSE o_orderstatus END AS value FROM orders)
 SELECT o_orderkey, TRY_CAST(value AS INT) AS as_int, coalesce(TRY_CAST(value AS DOUBLE), 0.0) AS as_double FROM told""")
def _(spark, sf):
    """Numbers between blanks, empty cells and text."""
    place = F.pmod("o_orderkey", F.lit(5))
    value = (F.when(place == 0, F.concat(F.lit(" "), "o_custkey", F.lit(" "))).when(place == 1, "")
             .when(place == 2, F.col("o_orderpriority")).when(place == 3, "-").otherwise(F.col("o_orderstatus")))
    return table(spark, sf, "orders").select("o_orderkey", to_int(value).alias("as_int"), to_double(value).alias("as_double"))
