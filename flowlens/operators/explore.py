"""Counts, windows, pivots and top lists over flows or alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.functions.columns import is_attack
from flowlens.runtime import materialise

# Fixed value: the longest duration the recorder can express.
LONGEST_DURATION = 65535.0


def labelled(df: DataFrame, column: str = "attack_cat") -> DataFrame:
    return df.filter(F.col(column).isNotNull())


def preview(df: DataFrame, rows: int = 1000) -> DataFrame:
    """A few rows for a look or a trial fit; which ones is up to Spark."""
    return df.limit(rows)


def category_counts(df: DataFrame, column: str = "attack_cat") -> DataFrame:
    """Rows per class, most frequent first."""
    return df.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column)


def distinct_categories(df: DataFrame, column: str = "attack_cat") -> DataFrame:
    return df.select(column).distinct()


def attack_flag_counts(df: DataFrame) -> DataFrame:
    return df.groupBy(is_attack().alias("is_attack")).agg(F.count("*").alias("n"))


def value_counts_where(df: DataFrame, column: str, value, by: str = "attack_cat") -> DataFrame:
    """Rows per class among those that hold one exact value (an outlier probe)."""
    return df.filter(F.col(column) == F.lit(value)).groupBy(by).agg(F.count("*").alias("n"))


def protocols_of(df: DataFrame, category: str, top: int = 10) -> DataFrame:
    """Protocols most used by one class, with their average size and duration."""
    return (
        df.filter(F.col("attack_cat") == category)
        .groupBy("proto")
        .agg(F.avg("sbytes").alias("avg_sbytes"), F.avg("dur").alias("avg_dur"),
             F.count("*").alias("n"))
        .orderBy(F.desc("n"), "proto")
        .limit(top)
    )


def threat_by_category(df: DataFrame) -> DataFrame:
    """Average, highest and spread of the threat score per class."""
    return (
        labelled(df).groupBy("attack_cat")
        .agg(F.avg("threat_score").alias("avg_threat"),
             F.max("threat_score").alias("max_threat"),
             F.stddev_samp("threat_score").alias("threat_volatility"))
        .orderBy(F.desc("avg_threat"), "attack_cat")
    )


def window_counts(df: DataFrame, time: Column | str, width: str = "5 minutes",
                  by: list[str] | None = None, count_name: str = "n") -> DataFrame:
    """Rows per tumbling window (and per ``by``), window flattened to its bounds."""
    keys = by or []
    return (
        df.groupBy(F.window(time, width).alias("w"), *keys)
        .agg(F.count("*").alias(count_name))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                *keys, count_name)
    )


def hour_pivot(df: DataFrame, time: Column | str, categories: list[str],
               column: str = "attack_cat", other: str = "other") -> DataFrame:
    """Hour of day by class; an absent cell stays NULL.

    The class list is given, so no extra job looks for it; rows of any class
    outside it are counted in the column ``other``.
    """
    t = F.col(time) if isinstance(time, str) else time
    listed = F.when(F.col(column).isin(categories), F.col(column)).otherwise(other)
    return (labelled(df, column).select(F.hour(t).alias("hour"), listed.alias("_class"))
            .groupBy("hour").pivot("_class", [*categories, other]).count())


def describe_column(df: DataFrame, column: str) -> DataFrame:
    """Count, mean, sample deviation, least and greatest value, with their types."""
    c = F.col(column)
    return df.agg(F.count(c).alias("n"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("stddev"),
                  F.min(c).alias("min"), F.max(c).alias("max"))


def top_talkers(df: DataFrame, top: int = 10, column: str = "srcip") -> DataFrame:
    """Addresses with the most connections; equal counts in address order."""
    return (df.groupBy(column).agg(F.count("*").alias("connection_count"))
            .orderBy(F.desc("connection_count"), column).limit(top))


def top_attack_sources(df: DataFrame, top: int = 10, column: str = "srcip") -> DataFrame:
    """Addresses behind the most attack rows."""
    return (df.filter(F.col("label") == 1).groupBy(column).agg(F.count("*").alias("attack_count"))
            .orderBy(F.desc("attack_count"), column).limit(top))


def class_distribution(df: DataFrame, column: str = "attack_cat", hide_below: float = 0.05) -> DataFrame:
    """Rows and share per class, and the share as a label unless it is too small to show."""
    counts = materialise(df.groupBy(column).agg(F.count("*").alias("n")), "class-counts")
    share = F.col("n") / counts.agg(F.sum("n")).scalar()
    return counts.select(
        column, "n", (share * 100).alias("pct"),
        F.when(share >= hide_below, F.concat(F.format_number(share * 100, 0), F.lit("%"))).alias("pct_label"),
    )
