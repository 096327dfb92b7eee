"""What is moved and stored of the flow table."""

from pyspark.sql import functions as F

from flowlens.operators import sequence
from flowlens.plans.adapters import flows


def test_stored_columns_are_joined_not_made_ones(spark, sf):
    text = flows(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    above, below = text.split("Join", 1)
    assert "concat(" in above and "concat(" not in below and "CASE WHEN" not in below


def test_flows_of_rows_with_missing_keys(spark, tmp_path):
    item = ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double,"
            " l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz")
    kept = [1, 2, 3, 1, 5.0, 10.0, 0.0, 0.1, "R", "F"]
    lines = [tuple(kept), (None, *kept[1:]), (9, *kept[1:]), (1, None, *kept[2:])]
    spark.createDataFrame([(*x, None) for x in lines], item).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(1, "P", "1-URGENT"), (1, "F", "5-LOW"), (None, "F", "2-HIGH")],
                          "o_orderkey long, o_orderstatus string, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    got = flows(spark, str(tmp_path))
    assert got.columns[0] == "stcpb" and got.columns[-3:] == ["service", "attack_cat", "label"]
    rows = [tuple(r) for r in got.select("stcpb", "dstip", "dload", "service", "attack_cat", "label").collect()]
    assert sorted(rows, key=str) == sorted(
        [(1, p, None, *label) for p in ("p2", None) for label in ((None, "DoS", 1), ("F", None, 0))], key=str)


def test_numbered_tables_are_compressed_harder(spark):
    numbered = sequence.with_tie_break(spark.range(10).withColumn("x", F.lit("a")))
    assert all(name.endswith(".zstd.parquet") for name in numbered.inputFiles())
    assert sorted(numbered.columns) == ["_tie", "id", "x"] and numbered.select("_tie").distinct().count() == 10
