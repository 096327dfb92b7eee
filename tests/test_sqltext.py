"""Detectors written as SQL, read by Spark and by another engine."""

import duckdb
import pytest
from pyspark.sql import functions as F

from flowlens.detection import detector as dt
from flowlens.detection.sqltext import number, score_sql, text


@pytest.fixture(scope="module")
def rows(spark):
    i = F.col("id")
    kind = F.when(i % 10 < 6, "Normal").when(i % 10 < 8, "DoS").otherwise("Worms")
    noise = F.pmod(F.xxhash64("id"), F.lit(1000)) / 37
    return spark.range(1500).select(
        "id", kind.alias("attack_cat"), F.when(i % 3 == 0, "udp").when(i % 3 == 1, "it's").otherwise("a\\b").alias("proto"),
        F.when(i % 7 == 0, "FIN").otherwise("CON").alias("state"), F.lit("-").alias("service"),
        F.when(i % 13 != 0, F.when(kind == "Normal", 10.0).when(kind == "Worms", 20.0).otherwise(30.0) + noise).alias("sbytes"),
        F.when(i % 17 == 0, F.lit(float("nan"))).otherwise(noise).alias("dur")).persist()


@pytest.mark.parametrize("stages", ["forest", "softmax"])
def test_both_engines_say_what_the_model_says(spark, rows, stages):
    # Spark's own learners take no missing values
    rows = rows.fillna({"sbytes": -1.0, "dur": 0.5}) if stages == "forest" else rows
    made = dt.forest_stages(5, 6) if stages == "forest" else dt.softmax_stages(4, 3, 3, 3)
    detector = dt.fit_two_stage(rows, made, numeric=["sbytes", "dur"])
    new = rows.withColumn("proto", F.when(F.col("id") % 11 == 0, "unseen").otherwise(F.col("proto")))
    want = {r.id: (r.stage2_class, r.predicted_class, r.attack_probability) for r in detector.score(new).collect()}
    new.createOrReplaceTempView("sqltext_rows")
    sqltext_rows = new.toPandas()  # found by name below
    assert len(sqltext_rows) == 1500
    sql = score_sql(detector, spark, "sqltext_rows", ["id"])
    for got in ([tuple(r) for r in spark.sql(sql).collect()], duckdb.sql(sql).fetchall()):
        assert len(got) == 1500
        for i, p, second, both in got:
            assert (second, both) == want[i][:2] and p == pytest.approx(want[i][2], abs=1e-12)


def test_single_stage(spark, rows):
    detector = dt.fit_single_stage(rows, dt.single_stage("softmax", 3, 3), numeric=["sbytes"])
    rows.createOrReplaceTempView("sqltext_single")
    got = {r.id: r.predicted_class for r in spark.sql(score_sql(detector, spark, "sqltext_single", ["id"])).collect()}
    assert got == {r.id: r.predicted_class for r in detector.score(rows).collect()}


def test_models_without_sql_are_refused(spark, rows):
    with pytest.raises(ValueError):
        score_sql(dt.fit_single_stage(rows.fillna({"sbytes": -1.0}), dt.single_stage("boosted", 1, 2), numeric=["sbytes"]), spark, "x", ["id"])


def test_literals():
    assert number(0.1) == "CAST('0.1' AS DOUBLE)" and text("") == "''" and text("a") == "'a'"
    assert duckdb.sql("SELECT " + text("it's\\x")).fetchall()[0][0] == "it's\\x"
