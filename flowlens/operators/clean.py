"""Row preparation before learning or exploring."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.functions.columns import attack_name, to_double
from flowlens.schema import IDENTIFIER_COLUMNS, LEAKY_COLUMNS, WIDENED_COLUMNS

ZERO_FILLED_TYPES = {"int", "double", "bigint"}


def lower_names(df: DataFrame) -> DataFrame:
    """Column names stripped and in lower case."""
    return df.toDF(*[c.strip().lower() for c in df.columns])


def clean_flows(df: DataFrame, drop: list[str] | None = None) -> DataFrame:
    """Labels normalised, text NULLs ``Unknown``, number NULLs 0, identifiers dropped.

    One projection: Spark sees a single list of expressions over the scan and
    reads only the columns that survive.
    """
    dropped = set(IDENTIFIER_COLUMNS if drop is None else drop)
    out = []
    for name, kind in df.dtypes:
        if name in dropped:
            continue
        if name == "attack_cat":
            out.append(attack_name(name).alias(name))
        elif name in WIDENED_COLUMNS:
            # text goes through try_cast: a blank is NULL, not an error
            number = to_double(name, default=None)
            out.append(F.coalesce(F.nanvl(number, F.lit(None)), F.lit(0.0)).alias(name))
        elif kind == "string":
            out.append(F.coalesce(F.col(name), F.lit("Unknown")).alias(name))
        elif kind == "double":
            out.append(F.coalesce(F.nanvl(name, F.lit(None)), F.lit(0.0)).alias(name))
        elif kind in ZERO_FILLED_TYPES:
            out.append(F.coalesce(F.col(name), F.lit(0).cast(kind)).alias(name))
        else:
            out.append(F.col(name))
    return df.select(*out)


def drop_leaky(df: DataFrame) -> DataFrame:
    """Without the columns that give the label away."""
    return df.drop(*LEAKY_COLUMNS)


def drop_labels(df: DataFrame) -> DataFrame:
    """Without the answer columns, as an incoming stream must be."""
    return df.drop("attack_cat", "label")


def with_endpoints(df: DataFrame) -> DataFrame:
    """Rows that name both a source and a destination address."""
    return df.dropna(subset=["srcip", "dstip"])
