"""Distributed running totals and row numbers.

A window without PARTITION BY moves the whole table into one task.  These
operators instead range-sort the rows, number them inside each range, and add
the total of all earlier ranges, which is one small row per range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlens.runtime import materialise

# monotonically_increasing_id() is (range << 33) + position inside the range
_POSITION_BITS = 33
# rows that one task sorts; larger tables get more ranges than the session's shuffle partitions
ROWS_PER_TASK = 250_000


def with_tie_break(df: DataFrame) -> DataFrame:
    """``df`` with a distinct number per row in ``_tie``, stored.

    Sorted last, it lets Spark spread rows that are equal in the sort columns,
    even exact copies, over several ranges.  It is stored before it is used, so
    a task that runs again after an executor was lost sees the same numbers.
    The whole table is written, so it is compressed harder than other tables.
    """
    return materialise(df.withColumn("_tie", F.monotonically_increasing_id()), "numbered", compression="zstd")


def _more_tasks(rows: DataFrame) -> list[int]:
    """The number of partitions a stored table needs, if the usual ones would hold more than ``ROWS_PER_TASK`` rows each."""
    usual = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wanted = -(-rows.count() // ROWS_PER_TASK)
    return [wanted] if wanted > usual else []


def _range_sorted(df: DataFrame, order: list[Column], unique: bool, tasks: list[int] | None = None) -> DataFrame:
    """Rows in ranges of ``order``, each with its range ``_part`` and place ``_pos``.

    Written once, because the ranges are drawn from a sample and the second
    pass must see the same ones.
    """
    source = df if unique else with_tie_break(df)
    keys = order if unique else [*order, F.col("_tie")]
    if tasks is None:
        tasks = [] if unique else _more_tasks(source)
    placed = (
        source.repartitionByRange(*tasks, *keys)
        .sortWithinPartitions(*keys)
        .drop("_tie")
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    stored = materialise(placed, "ranges")
    return stored.select(
        "*",
        F.shiftright("_mid", _POSITION_BITS).alias("_part"),
        F.col("_mid").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)).alias("_pos"),
    ).drop("_mid")


def _earlier(totals: DataFrame, names: list[str]) -> DataFrame:
    """Per range, the sums over all earlier ranges (a row per shuffle partition)."""
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(
        "_part", *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"_before_{n}") for n in names]
    )


def dense_index(df: DataFrame, order: list[Column | str], name: str = "seq", unique: bool = False,
                tasks: list[int] | None = None) -> DataFrame:
    """Row numbers 1, 2, 3, … in ``order`` over the whole table.

    Rows that tie in ``order`` are numbered in any order and may be spread over
    several tasks.  ``unique`` says that no rows tie, which saves a write; ``tasks`` may
    name a number of ranges.
    """
    keys = [F.col(c) if isinstance(c, str) else c for c in order]
    placed = _range_sorted(df, keys, unique, tasks)
    sizes = placed.groupBy("_part").agg(F.count("*").alias("n"))
    # bounded: one row per range
    offsets = F.broadcast(_earlier(sizes, ["n"]))
    return (
        placed.join(offsets, "_part")
        .withColumn(name, F.col("_before_n") + F.col("_pos") + 1)
        .drop("_part", "_pos", "_before_n")
    )


def running_sums(df: DataFrame, order: list[Column], sums: dict[str, str], unique: bool = False) -> DataFrame:
    """Inclusive running sums ``{new: column}`` in ``order`` over the whole table."""
    placed = _range_sorted(df, order, unique)
    totals = placed.groupBy("_part").agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    # bounded: one row per range
    offsets = F.broadcast(_earlier(totals, list(sums)))
    inside = (
        Window.partitionBy("_part").orderBy("_pos")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        placed.join(offsets, "_part")
        .withColumns({n: F.col(f"_before_{n}") + F.sum(c).over(inside) for n, c in sums.items()})
        .drop("_part", "_pos", *[f"_before_{n}" for n in sums])
    )


# The connection-count features and the columns two connections
# must share to be counted together.
CONNECTION_COUNTS = {
    "ct_srv_src": ["service", "srcip"],
    "ct_srv_dst": ["service", "dstip"],
    "ct_dst_ltm": ["dstip"],
    "ct_src_ltm": ["srcip"],
    "ct_src_dport_ltm": ["srcip", "dsport"],
    "ct_dst_sport_ltm": ["dstip", "sport"],
    "ct_dst_src_ltm": ["srcip", "dstip"],
}


def connection_counts(
    flows: DataFrame,
    order: list[Column | str],
    features: list[str] | None = None,
    last: int = 100,
    block_rows: int = 25_000,
) -> DataFrame:
    """Per flow, how many of the ``last`` connections share its endpoints.

    The numbered table is cut into blocks of consecutive rows; a row is also
    handed to every later block that begins within ``last - 1`` rows.  Every count
    is then local to a block, so all features share one shuffle, and an address
    that owns a third of the traffic is spread over the blocks instead of
    filling one task.
    """
    wanted = features or list(CONNECTION_COUNTS)
    stored = with_tie_break(flows)
    # a task sorts its rows once per feature: its memory is bounded by rows, however large the table
    tasks = _more_tasks(stored)
    numbered = dense_index(stored, [*order, "_tie"], "_seq", unique=True, tasks=tasks)
    home = F.floor((F.col("_seq") - 1) / block_rows).cast("long")
    reach = F.floor((F.col("_seq") - 1 + last - 1) / block_rows).cast("long")
    blocked = (
        numbered.withColumn("_home", home)
        .withColumn("_block", F.explode(F.sequence("_home", reach)))
        .repartition(*tasks, "_block")
    )
    counted = blocked.withColumns({
        name: F.count("*").over(
            Window.partitionBy("_block", *CONNECTION_COUNTS[name])
            .orderBy("_seq").rangeBetween(-(last - 1), 0))
        for name in wanted
    })
    return counted.filter(F.col("_block") == F.col("_home")).drop("_block", "_home", "_seq")


def synthetic_timestamps(df: DataFrame, order: list[Column | str], name: str = "timestamp",
                         start: int = 1_421_927_414) -> DataFrame:
    """One second per row after a fixed start, for data whose time was dropped.

    The default start is the fixed epoch of the published data set.
    """
    numbered = dense_index(df, order, "_seq")
    return numbered.withColumn(name, F.timestamp_seconds(F.lit(start) + F.col("_seq"))).drop("_seq")
