"""Tables above the rows of a task get more tasks, with the same numbers and counts."""

import contextlib
import io

from pyspark.sql import functions as F

from flowlens.operators import sequence
from flowlens.plans import flow_queries

COUNTS = list(sequence.CONNECTION_COUNTS)


def flows(spark, n):
    rows = [(i // 2, f"s{i * i % 5}" if i % 3 else None, f"d{i % 4}", str(i % 3), str(i % 2), "http" if i % 2 else None) for i in range(n)]
    return spark.createDataFrame(rows, "t int, srcip string, dstip string, sport string, dsport string, service string").withColumn("n", F.monotonically_increasing_id())


def test_tasks_grow_with_the_rows(spark, monkeypatch):
    df = flows(spark, 400)
    want = {tuple(r) for r in sequence.connection_counts(df, ["t", "n"], last=10, block_rows=20).collect()}
    monkeypatch.setattr(sequence, "ROWS_PER_TASK", 40)
    counted = sequence.connection_counts(df, ["t", "n"], last=10, block_rows=20)
    assert {tuple(r) for r in counted.collect()} == want and len(want) == 400
    with contextlib.redirect_stdout(io.StringIO()) as text:
        counted.explain("formatted")
    assert "_block" in text.getvalue() and ", 10)" in text.getvalue()
    assert sequence.dense_index(df, ["t"], "k").agg(F.max("k"), F.count_distinct("k")).first()[:] == (400, 400)


def test_messages_are_not_moved_again(spark, sf, monkeypatch):
    moved = []
    real = sequence.dense_index
    monkeypatch.setattr(sequence, "dense_index", lambda df, *a, **k: moved.append(df.columns) or real(df, *a, **k))
    got = flow_queries.REG.queries["messages_in_order"](spark, sf)
    assert moved == [["_sent", "stime"]]
    times = [r.stime for r in got.orderBy("place").collect()]
    assert times == sorted(times) and len(times) > 0
