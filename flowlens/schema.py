"""Table layouts and domain constants."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# The 49 flow columns in file order.
FLOW_DDL = """
srcip STRING, sport STRING, dstip STRING, dsport STRING, proto STRING, state STRING,
dur DOUBLE, sbytes INT, dbytes INT, sttl INT, dttl INT, sloss INT, dloss INT, service STRING,
sload DOUBLE, dload DOUBLE, spkts INT, dpkts INT, swin INT, dwin INT, stcpb LONG, dtcpb LONG,
smean INT, dmean INT, trans_depth INT, res_bdy_len INT, sjit DOUBLE, djit DOUBLE,
stime INT, ltime INT, sintpkt DOUBLE, dintpkt DOUBLE, tcprtt DOUBLE, synack DOUBLE, ackdat DOUBLE,
is_sm_ips_ports INT, ct_state_ttl INT, ct_flw_http_mthd INT, is_ftp_login INT, ct_ftp_cmd INT,
ct_srv_src INT, ct_srv_dst INT, ct_dst_ltm INT, ct_src_ltm INT, ct_src_dport_ltm INT,
ct_dst_sport_ltm INT, ct_dst_src_ltm INT, attack_cat STRING, label INT
"""

# The alert columns.
ALERT_DDL = """
id STRING, srcip STRING, dstip STRING, proto STRING, service STRING, state STRING,
attack_cat STRING, confidence DOUBLE, threat_score INT, status STRING, resolved_by STRING,
resolved_at TIMESTAMP, source STRING, timestamp TIMESTAMP
"""

# The security-event message of the demonstration topic.
EVENT_DDL = "id INT, event STRING, severity STRING, source_ip STRING, timestamp DOUBLE"

# Traffic classes, benign first.
NORMAL = "Normal"
ATTACK_CLASSES = [
    "Analysis", "Backdoor", "DoS", "Exploits", "Fuzzers",
    "Generic", "Reconnaissance", "Shellcode", "Worms",
]
ALL_CLASSES = [NORMAL, *ATTACK_CLASSES]

# Columns widened to double, columns removed before learning, and
# columns that leak the label through the time-to-live.
WIDENED_COLUMNS = ["sbytes", "dbytes", "dur", "sttl", "dttl", "sloss", "dloss"]
IDENTIFIER_COLUMNS = [
    "srcip", "dstip", "sport", "dsport", "stcpb", "dtcpb", "stime", "ltime", "label",
]
LEAKY_COLUMNS = ["sttl", "dttl", "ct_state_ttl"]
CATEGORICAL_FEATURES = ["state", "proto", "service"]

# The six measures averaged per protocol and per state.
PROFILE_MEASURES = ["dur", "sbytes", "dbytes", "sload", "spkts", "dpkts"]

# Defaults of an alert field that is missing or NULL.
ALERT_DEFAULTS = {
    "srcip": "unknown", "dstip": "unknown", "proto": "unknown", "service": "-",
    "state": "unknown", "attack_cat": "Unknown", "confidence": 0.0, "threat_score": 0,
    "source": "external",
}

# Alert vocabulary.
UPDATE_STATUSES = ["pending", "handled"]
LIFECYCLE_STATUSES = ["unverified", "confirmed", "resolved"]
CLOSED_STATUSES = ["resolved", "false_positive"]
SELF_ANNOUNCING_SOURCES = ["streaming", "batch_predict", "external", "seed_mock"]

# Description types that become double in a stream message.
NUMERIC_DESCRIPTIONS = ["integer", "float", "binary", "timestamp"]


def flow_schema() -> T.StructType:
    return T.StructType.fromDDL(FLOW_DDL)


def alert_schema() -> T.StructType:
    return T.StructType.fromDDL(ALERT_DDL)


def event_schema() -> T.StructType:
    return T.StructType.fromDDL(EVENT_DDL)


def schema_from_features(features: DataFrame, name: str = "Name", kind: str = "Type ") -> T.StructType:
    """Message schema from a feature-description table, one row per column.

    The table has one row per message column, so it is as small as a schema.
    """
    described = [(str(r[0]).strip().lower(), str(r[1]).strip().lower())
                 for r in features.select(f"`{name}`", f"`{kind}`").toLocalIterator()]
    return T.StructType([
        T.StructField(column, T.DoubleType() if kind_ in NUMERIC_DESCRIPTIONS else T.StringType())
        for column, kind_ in described
    ])
