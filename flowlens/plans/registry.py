"""Name → (query, SQL twin)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]


@dataclass
class Registry:
    queries: dict[str, Query] = field(default_factory=dict)
    sql: dict[str, str] = field(default_factory=dict)

    def add(self, name: str, sql: str | None = None) -> Callable[[Query], Query]:
        def keep(query: Query) -> Query:
            self.queries[name] = query
            if sql is not None:
                self.sql[name] = sql
            return query
        return keep


def r6(c: str | Column, name: str | None = None) -> Column:
    """Six digits, for comparing floating-point results."""
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col, 6).alias(name or c)
