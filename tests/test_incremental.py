"""States that grow by the day or by the batch, against full runs."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from flowlens.operators import daily, graph, growing_graph
from flowlens.operators.profile import fit_profile
from flowlens.operators.split import exact_quantile
from flowlens.plans.adapters import packets
from flowlens.runtime import scratch_path

DAY = "start_clock"


def month():
    return F.trunc(DAY, "month")


@pytest.fixture(scope="module")
def rows(spark, sf):
    return packets(spark, sf).withColumn("year", F.year("start_clock")).persist()


def years(rows):
    return sorted(r[0] for r in rows.select("year").distinct().collect())


def test_averages_equal_a_full_fit(spark, rows):
    path = scratch_path(spark, "days")
    for y in years(rows):
        daily.add_days(rows.filter(F.col("year") == y), path, month())
        got = daily.profile_of_days(spark, path)
        want = fit_profile(rows.filter(F.col("year") <= y))
        for key in ("proto", "state"):
            a, b = ({r[0]: r[1:] for r in p.tables[key].collect()} for p in (got, want))
            assert a.keys() == b.keys() and all(x == pytest.approx(y_, rel=1e-12) for k in a for x, y_ in zip(a[k], b[k]))


def test_quantile_within_its_error(spark, rows):
    path = scratch_path(spark, "days")
    daily.add_days(rows, path, month())
    found = daily.quantile_of_days(spark, path, 0.8)
    share = rows.agg(F.avg((F.col("stime") <= found).cast("int"))).first()[0]
    assert abs(share - 0.8) < 0.01 and isinstance(exact_quantile(rows, "stime", 0.8), int)


def test_a_day_given_again_is_replaced_and_others_keep_their_files(spark, rows):
    path = scratch_path(spark, "days")
    first, second = dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 2)
    two = rows.limit(50).withColumn("start_clock", F.when(F.col("spkts") % 2 == 0, F.lit(first)).otherwise(F.lit(second)))
    daily.add_days(two, path, DAY)
    before = set(spark.read.parquet(f"{path}/times").filter("day = '2020-01-01'").inputFiles())
    kept = {f for f in before if "2020-01-01" in f}
    daily.add_days(two.filter(F.col("start_clock") == F.lit(second)).limit(3), path, DAY)
    assert kept <= set(spark.read.parquet(f"{path}/times").inputFiles())
    assert {r.day: r.n for r in daily.day_counts(spark, path).collect()}["2020-01-02"] == 3


def test_rows_without_time(spark, rows):
    path = scratch_path(spark, "days")
    daily.add_days(rows.limit(5).withColumn("start_clock", F.lit(None).cast("timestamp_ntz")).unionByName(rows.limit(2)), path, DAY)
    assert sum(r.n for r in daily.day_counts(spark, path).collect()) == 2
    assert daily.quantile_of_days(spark, path, 0.5, upto="1900-01-01") is None


def as_dict(df):
    return {r.id: r.component for r in df.collect()}


def test_components_equal_a_full_run_after_every_batch(spark):
    rng = random.Random(3)
    path = scratch_path(spark, "graph")
    seen = []
    assert growing_graph.components(spark, path).collect() == []
    for batch in range(4):
        new = [(f"v{rng.randint(0, 120):03}", f"v{rng.randint(0, 120):03}") for _ in range(25)] + [("loop", "loop"), (None, "x")]
        seen += new
        for _ in range(2 if batch == 2 else 1):  # a batch given twice changes nothing
            growing_graph.add_edges(spark.createDataFrame(new, "src string, dst string"), path)
        want = as_dict(graph.connected_components(spark.createDataFrame(seen, "src string, dst string")))
        assert as_dict(growing_graph.components(spark, path)) == want


def test_work_follows_the_batch(spark, monkeypatch):
    path = scratch_path(spark, "graph")
    big = spark.range(500).select(F.concat(F.lit("a"), F.col("id") % 50).alias("src"), F.concat(F.lit("a"), F.col("id") % 49).alias("dst"))
    growing_graph.add_edges(big, path)
    sizes = []
    real = growing_graph.connected_components
    monkeypatch.setattr(growing_graph, "connected_components", lambda e: sizes.append(e.count()) or real(e))
    growing_graph.add_edges(spark.createDataFrame([("a1", "z"), ("a2", "z"), ("y", "x")], "src string, dst string"), path)
    assert sizes == [2]  # two edges into one component are one edge
    got = as_dict(growing_graph.components(spark, path))
    assert got["z"] == got["a1"] == "a0" and got["y"] == "x"


def test_an_unfinished_batch_does_not_count(spark):
    path = scratch_path(spark, "graph")
    growing_graph.add_edges(spark.createDataFrame([("b", "a")], "src string, dst string"), path)
    spark.createDataFrame([("q", "q")], growing_graph.VERTICES).write.parquet(f"{path}/vertices/batch=2")
    assert as_dict(growing_graph.components(spark, path)) == {"a": "a", "b": "a"}
    growing_graph.add_edges(spark.createDataFrame([("c", "b")], "src string, dst string"), path)
    assert as_dict(growing_graph.components(spark, path)) == {"a": "a", "b": "a", "c": "a"}
