"""Streaming computations and sinks.

Sinks write one folder per micro-batch and replace it when a batch is replayed,
so a restart neither loses nor repeats rows.  Checkpoints and tables belong in
shared storage.
"""

from __future__ import annotations

import json
import threading
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupStateTimeout

from flowlens.operators.alerts import unannounced
from flowlens.operators.explore import window_counts
from flowlens.runtime import materialise

WATERMARK = "10 minutes"
TRIGGER = "5 seconds"


def windowed_stream_counts(stream: DataFrame, time: str, width: str = "5 minutes",
                           by: list[str] | None = None, watermark: str = WATERMARK) -> DataFrame:
    """Rows per closed window; state is dropped once the watermark has passed it."""
    return window_counts(stream.withWatermark(time, watermark), time, width, by)


def without_redelivery(stream: DataFrame, time: str, keys: list[str], watermark: str = WATERMARK) -> DataFrame:
    """First delivery of every message; copies within the watermark are dropped.

    One state store holds the keys of the last ``watermark``.
    """
    return stream.withWatermark(time, watermark).dropDuplicatesWithinWatermark(keys)


def running_category_counts(alerts: DataFrame) -> DataFrame:
    """Rows and pending alerts per class so far; state is one row per class."""
    return alerts.groupBy("attack_cat").agg(
        F.count("*").alias("n"), F.count_if(F.col("status") == "pending").alias("pending"))


ALERT_STATE = "alerts string"
CHANGES = "attack_cat string, n long, pending long"


def alert_changes(events: DataFrame, keep: str = "24 hours", buckets: int = 4096) -> DataFrame:
    """What every alert or update adds to the counts of its class: rows (attack_cat, n, pending) of +1 and -1.

    ``events`` has id, attack_cat, status, at (a time) and is_update.  Keyed state holds the class and the last status of
    an alert, so an update that handles it takes it off the pending ones, and a message delivered again changes
    nothing.  Of several updates the latest counts (then the greater status), in whatever order they come; an update that
    comes before its alert waits for it.  Events more than ``keep`` behind the newest are late and have no effect; the state
    of a handled alert is dropped that long after its last event.

    A call per alert costs far more than its rows, so alerts share a call and a state by the hash of their id.  A
    checkpoint belongs to one number of ``buckets``.
    """
    wait = int(pd.Timedelta(keep).total_seconds() * 1000)

    def standing(seen, category, status, updated, changed, until):
        return bool(seen), bool(seen) and (changed or status) == "pending"

    def step(key, batches, state):
        # id: seen, class, first status, time and status of the last update, when it is dropped
        alerts = {a[0]: a[1:] for a in json.loads(state.get[0])} if state.exists else {}
        watermark = state.getCurrentWatermarkMs()
        before, newest = {}, {}
        for rows in () if state.hasTimedOut else batches:
            columns = (rows[c].tolist() for c in ("id", "attack_cat", "status", "_order", "is_update"))
            for id_, cat, new, order, is_update in zip(*columns):
                now = alerts.get(id_, (False, None, None, None, None, None))
                seen, category, status, updated, changed, until = now
                if id_ not in before:
                    before[id_] = standing(*now)
                newest[id_] = max(newest.get(id_, 0), order)
                new = None if pd.isna(new) else new
                if is_update:
                    if updated is None or (order, new or "") > (updated, changed or ""):
                        updated, changed = order, new
                elif not seen:
                    seen, category, status = True, None if pd.isna(cat) else cat, new
                alerts[id_] = (seen, category, status, updated, changed, until)
        said = []
        for id_, (was_seen, was_pending) in before.items():
            seen, pending = standing(*alerts[id_])
            # every event starts the time anew; what is pending or waits for its alert stays
            until = max(watermark, newest[id_] // 1000) + wait if seen and not pending else None
            alerts[id_] = (*alerts[id_][:5], until)
            if (seen, pending) != (was_seen, was_pending):
                said.append((alerts[id_][1], seen - was_seen, pending - was_pending))
        alerts = {i: a for i, a in alerts.items() if a[5] is None or a[5] >= watermark}
        if alerts:
            state.update((json.dumps([(i, *a) for i, a in alerts.items()]),))
            ends = [a[5] for a in alerts.values() if a[5] is not None]
            if ends:
                state.setTimeoutTimestamp(max(min(ends), watermark + 1))
        elif state.exists:
            state.remove()
        if said:
            yield pd.DataFrame(said, columns=["attack_cat", "n", "pending"])

    ordered = events.withWatermark("at", keep).withColumns({
        "_order": F.coalesce(F.unix_micros("at"), F.lit(0)), "_bucket": F.pmod(F.xxhash64("id"), F.lit(buckets))})
    return ordered.groupBy("_bucket").applyInPandasWithState(step, CHANGES, ALERT_STATE, "append", GroupStateTimeout.EventTimeTimeout)


def sum_of_batch(changes: DataFrame) -> DataFrame:
    """One row per class of a micro-batch, so that the table of changes stays small."""
    return changes.groupBy("attack_cat").agg(F.sum("n").alias("n"), F.sum("pending").alias("pending"))


def sum_changes(changes: DataFrame) -> DataFrame:
    """Rows and pending alerts per class after all changes so far, never below zero."""
    total = lambda c: F.greatest(F.sum(c), F.lit(0)).cast("long").alias(c)
    return changes.groupBy("attack_cat").agg(total("n"), total("pending"))


def new_alerts(stream: DataFrame) -> DataFrame:
    """The alerts that still have to be announced."""
    return unannounced(stream)


def batch_table_sink(path: str, transform: Callable[[DataFrame], DataFrame] | None = None
                     ) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that writes each batch to its own folder, replacing it on replay."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = transform(batch) if transform else batch
        rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def start(stream: DataFrame, path: str, checkpoint: str,
          transform: Callable[[DataFrame], DataFrame] | None = None,
          mode: str = "append", drain: bool = False, trigger: str = TRIGGER) -> StreamingQuery:
    """Run a stream into a batch table: every ``trigger``, or until the input is used up."""
    writer = (stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
              .foreachBatch(batch_table_sink(path, transform)))
    writer = writer.trigger(availableNow=True) if drain else writer.trigger(processingTime=trigger)
    return writer.start()


def drain(stream: DataFrame, path: str, checkpoint: str,
          transform: Callable[[DataFrame], DataFrame] | None = None, mode: str = "append") -> DataFrame:
    """Process what is available, stop, and return the table written so far."""
    start(stream, path, checkpoint, transform, mode, drain=True).awaitTermination()
    return stream.sparkSession.read.parquet(path)


def last_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The newest batch of a table written in complete mode."""
    table = spark.read.parquet(path)
    return table.filter(F.col("batch_id") == table.agg(F.max("batch_id")).scalar()).drop("batch_id")


def show(stream: DataFrame, checkpoint: str | None = None) -> StreamingQuery:
    """Print what is available to the console and stop."""
    writer = stream.writeStream.outputMode("append").format("console").trigger(availableNow=True)
    return (writer.option("checkpointLocation", checkpoint) if checkpoint else writer).start()


def peek(stream: DataFrame, path: str, checkpoint: str, rows: int = 5,
         order: list[Column | str] | None = None) -> DataFrame:
    """The first few messages of the first batch that has any; the stream is stopped after it."""
    seen = threading.Event()

    def first(batch: DataFrame, batch_id: int) -> None:
        if not seen.is_set():
            found = materialise((batch.orderBy(*order) if order else batch).limit(rows), "peek")
            found.write.mode("overwrite").parquet(path)
            if not found.isEmpty():
                seen.set()

    query = (stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(first)
             .trigger(availableNow=True).start())
    while query.isActive and not seen.wait(0.2):
        pass
    if seen.is_set():
        query.stop()
    elif query.exception():
        raise query.exception()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)
