"""Connection counts across micro-batches against the same counts over the whole table."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from flowlens.operators.sequence import CONNECTION_COUNTS, connection_counts
from flowlens.runtime import path_names, scratch_home
from flowlens.streaming.connections import StreamedConnections
from flowlens.streaming.ingest import table_stream

NOON = dt.datetime(2024, 1, 1, 12)
SCHEMA = "n long, at timestamp, srcip string, dstip string, sport string, dsport string, service string"
LAST = 7


def flow(rng, n, second):
    # one source has a third of all flows
    source = "hot" if rng.random() < 0.34 else f"s{rng.randrange(5)}"
    return (n, None if second is None else NOON + dt.timedelta(seconds=second), source, f"d{rng.randrange(3)}",
            str(rng.randrange(2)), str(rng.randrange(2)), rng.choice(["http", None]))


def found(df):
    return sorted(tuple(r) for r in df.select("n", *CONNECTION_COUNTS).collect())


@pytest.fixture
def counts(spark, tmp_path):
    return StreamedConnections(spark, f"{tmp_path}/out", F.col("at"), ["n"], "30 seconds", last=LAST)


def deliver(spark, counts, tmp_path, rows):
    feed = f"{tmp_path}/feed"
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(feed)
    stream = table_stream(spark, feed, spark.createDataFrame([], SCHEMA).schema)
    counts.start(stream, f"{tmp_path}/cp", drain=True).awaitTermination()


def whole(spark, rows):
    return connection_counts(spark.createDataFrame(rows, SCHEMA), ["at", "n"], last=LAST)


def test_equal_to_the_whole_table(spark, counts, tmp_path):
    rng = random.Random(1)
    rows = [flow(rng, n, n // 3) for n in range(240)]  # three flows a second
    arrived = sorted(rows, key=lambda r: (r[1] + dt.timedelta(seconds=rng.randrange(25)), r[0]))
    # also a delivery of a few rows, fewer than a flow looks back on
    for a, b in ((0, 100), (100, 103), (103, 240)):
        deliver(spark, counts, tmp_path, arrived[a:b])
        so_far = {r.n for r in counts.final().select("n").collect()}
        assert so_far.isdisjoint(r.n for r in counts.waiting().select("n").collect())
    assert counts.late().isEmpty()
    assert found(counts.final().unionByName(counts.waiting())) == found(whole(spark, rows))
    # final counts did not change after they were written
    assert set(found(counts.final())) < set(found(whole(spark, rows)))


def test_late_flows_and_flows_without_time_are_kept_apart(spark, counts, tmp_path):
    rng = random.Random(2)
    rows = [flow(rng, n, 10 * n) for n in range(30)]
    deliver(spark, counts, tmp_path, rows)
    late = [flow(rng, 100, 3), flow(rng, 101, None)]
    deliver(spark, counts, tmp_path, late + [flow(rng, 102, 275)])
    assert sorted(r.n for r in counts.late().collect()) == [100, 101]
    rows.append(next(r for r in [(*x,) for x in counts.waiting().select(*[f.name for f in whole(spark, rows).schema][:7]).collect()] if r[0] == 102))
    assert found(counts.final().unionByName(counts.waiting())) == found(whole(spark, rows))


def test_only_rows_without_time(spark, counts, tmp_path):
    deliver(spark, counts, tmp_path, [flow(random.Random(3), n, None) for n in range(3)])
    assert counts.late().count() == 3 and counts.final().isEmpty() and counts.waiting().isEmpty()
    rows = [flow(random.Random(4), n, n) for n in range(50)]
    deliver(spark, counts, tmp_path, rows)
    assert found(counts.final().unionByName(counts.waiting())) == found(whole(spark, rows))


def test_replay_changes_nothing_and_old_state_goes(spark, counts, tmp_path):
    rng = random.Random(5)
    parts = [[flow(rng, n, 5 * n) for n in range(a, a + 20)] for a in (0, 20, 40)]
    for i, rows in enumerate(parts):
        batch = spark.createDataFrame(rows, SCHEMA)
        counts.process(batch, i)
        before = found(counts.final()), found(counts.waiting())
        counts.process(batch, i)
        assert (found(counts.final()), found(counts.waiting())) == before
    assert path_names(spark, f"{counts.path}/state") == ["batch_id=1", "batch_id=2"]
    assert not [n for n in path_names(spark, scratch_home(spark)) if n.startswith("scope-")]
    assert found(counts.final().unionByName(counts.waiting())) == found(whole(spark, sum(parts, [])))


def test_equal_flows_and_a_reach_of_one(spark, tmp_path):
    counts = StreamedConnections(spark, f"{tmp_path}/out", F.col("at"), ["n"], "0 seconds", last=1)
    same = [(1, NOON, "a", "b", "1", "2", "http")] * 5
    for i in range(2):
        counts.process(spark.createDataFrame([(*r[:1], NOON + dt.timedelta(seconds=i), *r[2:]) for r in same], SCHEMA), i)
    assert {tuple(r) for r in counts.final().select(*CONNECTION_COUNTS).collect()} == {(1,) * 7}
    assert counts.final().count() == 10 and counts.waiting().isEmpty()
