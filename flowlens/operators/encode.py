"""Category codes as tables, the same at training and at scoring."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.operators.sequence import dense_index
from flowlens.runtime import materialise

UNSEEN = -1


def category_codes(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, code) with codes 0, 1, 2, … in alphabetic order per column."""
    seen = (
        df.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns
        ])).alias("p"))
        .select("p.*").filter(F.col("value").isNotNull()).distinct()
    )
    placed = dense_index(seen, ["column", "value"], "_seq", unique=True)
    first = placed.groupBy("column").agg(F.min("_seq").alias("_first"))
    return (
        placed.join(first, "column")
        .select("column", "value", (F.col("_seq") - F.col("_first")).cast("int").alias("code"))
    )


def encode(df: DataFrame, codes: DataFrame, columns: list[str], suffix: str = "_code") -> DataFrame:
    """Each column's code beside it; a value without a code gets -1."""
    table = materialise(codes, "codes")
    out = df
    for c in columns:
        lookup = table.filter(F.col("column") == c).select(
            F.col("value").alias(c), F.col("code").alias(c + suffix))
        out = out.join(lookup, c, "left").fillna({c + suffix: UNSEEN})
    return out
