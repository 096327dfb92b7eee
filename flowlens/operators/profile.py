"""Per-protocol and per-state averages, learned on one side and applied to any."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.functions.columns import bytes_ratio, threat_score
from flowlens.runtime import materialise
from flowlens.schema import PROFILE_MEASURES

PROFILE_KEYS = ["proto", "state"]


def usual_name(measure: str, key: str) -> str:
    return f"avg_{measure}_{key}"


def key_averages(df: DataFrame, key: str) -> DataFrame:
    """Average of every measure per value of ``key``."""
    return df.groupBy(key).agg(*[F.avg(m).alias(usual_name(m, key)) for m in PROFILE_MEASURES])


@dataclass(frozen=True)
class TrafficProfile:
    """Averages per key column, one small table each."""

    tables: dict[str, DataFrame]


def fit_profile(train: DataFrame, keys: list[str] = PROFILE_KEYS) -> TrafficProfile:
    """Learn the averages of all ``keys`` in a single pass over ``train``.

    Grouping sets let one scan serve every key.  The result is written, so that
    enriching several tables never repeats the scan, and so that its real size
    decides how it is joined.
    """
    present = [k for k in keys if k in train.columns]
    if not present:
        return TrafficProfile({})
    bits = {k: 1 << (len(present) - 1 - i) for i, k in enumerate(present)}
    all_bits = (1 << len(present)) - 1
    averaged = materialise(
        train.select(*present, *PROFILE_MEASURES)
        .groupingSets([[F.col(k)] for k in present], *[F.col(k) for k in present])
        .agg(F.grouping_id().alias("_set"), *[F.avg(m).alias(m) for m in PROFILE_MEASURES]),
        "profile",
    )
    return TrafficProfile({
        k: averaged.filter(F.col("_set") == all_bits - bits[k])
        .select(k, *[F.col(m).alias(usual_name(m, k)) for m in PROFILE_MEASURES])
        for k in present
    })


def attach_usual(df: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Left equi-join of one averages table; broadcast only if its files are small."""
    return df.join(table, key, "left")


def enrich(df: DataFrame, profile: TrafficProfile) -> DataFrame:
    """Ratio, averages and threat score per row; unseen keys end up with zeros.

    Works on streams as well: the profile is the static side of the join.
    """
    out = df
    if {"sbytes", "dbytes"} <= set(df.columns):
        out = out.withColumn("bytes_ratio", bytes_ratio())
    for key, table in profile.tables.items():
        if key in df.columns:
            out = attach_usual(out, table, key)
    if {"sbytes", "sload", "avg_sbytes_proto", "avg_sload_proto"} <= set(out.columns):
        out = out.withColumn("threat_score", threat_score())
    return out.fillna(0.0)
