"""Run a registered query and its SQL twin and compare the results."""

from __future__ import annotations

import datetime
import math
from collections import Counter

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else (int(v) if v == int(v) else v)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if v is not None and type(v).__name__ == "Decimal":
        return plain(float(v))
    return v


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def difference(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when equal, else a short account of the difference."""
    result = con.execute(sql)
    theirs_cols = [d[0] for d in result.description]
    theirs = rows_of(theirs_cols, result.fetchall())
    ours = rows_of(spark_df.columns, spark_df.collect())
    if sorted(spark_df.columns) != sorted(theirs_cols):
        return f"columns {sorted(spark_df.columns)} against {sorted(theirs_cols)}"
    if ours == theirs:
        return None
    more, less = ours - theirs, theirs - ours
    return (f"{sum(ours.values())} rows against {sum(theirs.values())}; only Spark {sum(more.values())}:"
            f" {list(more)[:3]}; only SQL {sum(less.values())}: {list(less)[:3]}")
