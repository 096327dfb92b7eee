"""Connection counts on a stream: every flow gets its counts over the last connections, also across micro-batches.

A flow is final once no earlier one can come any more, that is when the newest flow seen is more than ``lateness`` ahead of
it.  State between micro-batches is a table of two kinds of rows: flows that still wait, and the last ``last - 1`` final
ones, which the next final flows look back on.  It is bounded by the traffic of ``lateness`` and lies in shared storage; the
final flows of a batch are counted by ``connection_counts`` in blocks of consecutive rows, so an address with a third
of the traffic is spread over tasks here too.

Flows that come after later ones have become final, and flows without a time, are not counted; they are kept in a table of
their own.  Flows that tie in time and order are ordered by their other columns.

Batch N reads the state of batch N - 1 and replaces its own tables, so a replayed batch changes nothing.  A path belongs to
one checkpoint.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from flowlens.operators.sequence import CONNECTION_COUNTS, connection_counts
from flowlens.runtime import delete_path, materialise, path_names, scratch_scope
from flowlens.streaming.jobs import TRIGGER

AT, HELD = "_at", "_held"


class StreamedConnections:
    """The tables below ``path`` and the micro-batches that fill them."""

    def __init__(self, spark: SparkSession, path: str, time: Column, order: list[str], lateness: str = "10 minutes",
                 features: list[str] | None = None, last: int = 100):
        """``time`` is the instant of a flow; ``order`` the columns that decide between flows of the same instant."""
        self.spark, self.path, self.time, self.order, self.last = spark, path.rstrip("/"), time, order, last
        self.features = features or list(CONNECTION_COUNTS)
        self.lateness = int(pd.Timedelta(lateness) / pd.Timedelta(microseconds=1))

    def _order(self, rows: DataFrame) -> list[str]:
        return [AT, *self.order, *[c for c in rows.columns if c not in (AT, HELD, *self.order)]]

    def _count(self, rows: DataFrame) -> DataFrame:
        """Counts of the held rows among ``rows``."""
        counted = connection_counts(rows, self._order(rows), self.features, self.last)
        return counted.filter(HELD).drop(AT, HELD)

    def process(self, batch: DataFrame, batch_id: int) -> None:
        """The work of one micro-batch, for ``foreachBatch``."""
        session = batch.sparkSession
        with scratch_scope(session):
            rows = batch.withColumns({AT: F.unix_micros(self.time), HELD: F.lit(True)})
            if batch_id > 0:
                rows = rows.unionByName(session.read.schema(rows.schema).parquet(f"{self.path}/state/batch_id={batch_id - 1}"))
            rows = materialise(rows, "connections")
            newest, final = rows.agg(F.max(AT), F.max(F.when(~F.col(HELD), F.col(AT)))).first()
            late = F.col(HELD) & (F.col(AT).isNull() | F.coalesce(F.col(AT) <= F.lit(final), F.lit(False)))
            waits = F.col(HELD) & (F.col(AT) > F.lit(None if newest is None else newest - self.lateness).cast("long"))
            placed = rows.filter(~late)
            ready, waiting = placed.filter(~waits), placed.filter(waits)
            # at least one row, because the greatest final time is read from them
            carried = ready.orderBy(*[F.col(c).desc() for c in self._order(rows)]).limit(max(self.last - 1, 1))
            for name, table in (("counts", self._count(ready)), ("late", rows.filter(late).drop(AT, HELD)),
                                ("state", waiting.unionByName(carried.withColumn(HELD, F.lit(False))))):
                table.write.mode("overwrite").parquet(f"{self.path}/{name}/batch_id={batch_id}")
        if batch_id > 1:  # a replay reads the state before its own, nothing reads older ones
            delete_path(session, f"{self.path}/state/batch_id={batch_id - 2}")

    def start(self, flows: DataFrame, checkpoint: str, drain: bool = False, trigger: str = TRIGGER) -> StreamingQuery:
        """Run a stream of flows into the tables: every ``trigger``, or until the input is used up."""
        writer = flows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(self.process)
        return (writer.trigger(availableNow=True) if drain else writer.trigger(processingTime=trigger)).start()

    def _table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}").drop("batch_id")

    def final(self) -> DataFrame:
        """Flows with their final counts."""
        return self._table("counts")

    def late(self) -> DataFrame:
        """Flows that came too late or have no time."""
        return self._table("late")

    def waiting(self) -> DataFrame:
        """The flows that wait, with their counts as far as flows have come; nothing is stored."""
        newest = max(int(n.split("=")[1]) for n in path_names(self.spark, f"{self.path}/state") if "=" in n)
        return self._count(self.spark.read.parquet(f"{self.path}/state/batch_id={newest}"))
