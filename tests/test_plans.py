"""What the physical plans must and must not contain."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from flowlens.operators import explore, profile, sequence
from flowlens.plans.adapters import FLOW_ORDER, packets
from flowlens.plans.catalog import REGISTRY
from flowlens.runtime import scratch_path
from flowlens.sources.readers import read_partition
from flowlens.sources.writers import write_table

TRAINS = {"two_stage_fit_score", "two_stage_boosted_fit_score", "single_stage_fit_score"}


def plan(df) -> str:
    with contextlib.redirect_stdout(io.StringIO()) as text:
        df.explain("formatted")
    return text.getvalue()


@pytest.mark.parametrize("name", sorted(set(REGISTRY.queries) - TRAINS))
def test_no_python_and_no_cross_join(spark, sf, name):
    text = plan(REGISTRY.queries[name](spark, sf))
    for unwanted in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert unwanted not in text, unwanted


def test_learned_tables_are_broadcast_by_their_size(spark, sf):
    rows = packets(spark, sf)
    scored = profile.enrich(rows, profile.fit_profile(rows))
    assert plan(scored).count("BroadcastHashJoin") >= 2
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        assert "BroadcastHashJoin" not in plan(profile.enrich(rows, profile.fit_profile(rows)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_filters_and_columns_reach_the_scan(spark, sf):
    text = plan(explore.value_counts_where(packets(spark, sf), "dur", 0.08, by="proto"))
    assert "EqualTo(l_tax,0.08)" in text
    assert re.search(r"ReadSchema: struct<l_tax:double,l_returnflag:string>", text)


def test_partition_pruning(spark, sf):
    path = scratch_path(spark, "pruned")
    write_table(spark.range(10).withColumn("label", (F.col("id") % 2).cast("int")), path, partition_by=["label"])
    assert re.search(r"PartitionFilters: \[.*label#\d+ = 1", plan(read_partition(spark, path)))


def test_top_lists_do_not_sort_everything(spark, sf):
    assert "TakeOrderedAndProject" in plan(explore.top_talkers(packets(spark, sf)))


def test_connection_counts_share_one_shuffle(spark, sf):
    counted = sequence.connection_counts(
        packets(spark, sf).withColumn("service", F.lit("x")), FLOW_ORDER)
    shuffles = re.findall(r"Arguments: hashpartitioning\((_\w+)", plan(counted))
    assert shuffles.count("_block") == 1 and set(shuffles) <= {"_block", "_part"}
