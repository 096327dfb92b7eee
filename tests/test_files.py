"""Readers and writers."""

import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from flowlens import runtime
from flowlens.schema import event_schema, flow_schema
from flowlens.sources import readers, writers
from flowlens.streaming.ingest import CORRUPT, decode_json


def test_flow_csv_with_bad_cells(spark, tmp_path):
    row = ["10.0.0.1", "0x20", "10.0.0.2", "80", "tcp", "FIN", "0.5"] + ["1"] * 6 + ["http"] + ["2"] * 33 + ["DoS", "1"]
    assert len(row) == 49
    bad = list(row)
    bad[7] = "many"
    for i, lines in enumerate(([row], [bad])):
        (tmp_path / f"flows_{i}.csv").write_text("\n".join(",".join(r) for r in lines) + "\n")
    got = readers.read_flows(spark, f"{tmp_path}/flows_*.csv").orderBy(F.col("sbytes").asc_nulls_last()).collect()
    assert [r.sbytes for r in got] == [1, None]
    assert got[0].sport == "0x20" and got[0].label == 1 and len(got[0]) == 49


def test_inferred_and_named_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,rate\n1,0.5\n2,1.5\n")
    df = readers.read_csv(spark, f"{tmp_path}/a.csv")
    assert dict(df.dtypes) == {"id": "int", "rate": "double"}
    (tmp_path / "b.csv").write_text("1,x\n2,y\n")
    names = spark.createDataFrame([(10, "kind"), (2, "id ")], "`No.` int, Name string")
    assert readers.read_named_csv(spark, f"{tmp_path}/b.csv", names).columns == ["id", "kind"]
    with pytest.raises(ValueError, match="1 column names for 2 columns"):
        readers.read_named_csv(spark, f"{tmp_path}/b.csv", names.limit(1))


def test_write_modes_and_files(spark, tmp_path):
    df = spark.range(1000).withColumn("label", (F.col("id") % 2).cast("int"))
    path = f"{tmp_path}/deep/er/table"
    writers.write_table(df, path, files=4)
    assert readers.read_table(spark, path).count() == 1000
    assert len(readers.read_table(spark, path).inputFiles()) == 4
    with pytest.raises(AnalysisException):
        writers.write_table(df, path, overwrite=False)
    writers.write_table(df, path, files=3, range_by=["id"])
    spans = (readers.read_table(spark, path).groupBy(F.input_file_name())
             .agg(F.min("id").alias("a"), F.max("id").alias("b")).orderBy("a").collect())
    assert len(spans) == 3 and all(x.b < y.a for x, y in zip(spans, spans[1:]))
    writers.write_table(df, path, partition_by=["label"])
    assert readers.read_partition(spark, path, "label", 1).count() == 500


def test_messages_are_in_numeric_time_order(spark):
    df = spark.createDataFrame([(100, "c"), (9, "a"), (20, "b")], "stime int, srcip string")
    got = [json.loads(r.value) for r in writers.as_messages(df).collect()]
    assert [m["stime"] for m in got] == [9, 20, 100]


def test_malformed_messages(spark):
    df = spark.createDataFrame([('{"id": 1, "event": "scan"}',), ("not json",)], "value string")
    rows = decode_json(df, event_schema(), keep_corrupt=True).collect()
    assert rows[0].id == 1 and rows[0][CORRUPT] is None
    assert rows[1].id is None and rows[1][CORRUPT] == "not json"
    assert decode_json(df, event_schema()).columns == [f.name for f in event_schema()]


@pytest.mark.parametrize("doc,expected", [
    ({"stage1": {"accuracy": 0.9}, "stage2": {"macro_f1": 0.5}, "overall": {"accuracy": 0.8}}, (0.9, 0.5, 0.8)),
    ({"accuracy": 0.7, "f1": 0.6}, (0.7, 0.0, 0.0)),
    ({}, (0.0, 0.0, 0.0)),
])
def test_metrics_documents(spark, tmp_path, doc, expected):
    (tmp_path / "m.json").write_text(json.dumps(doc, indent=2))
    row = readers.read_metrics(spark, f"{tmp_path}/m.json").first()
    assert (row.stage1.accuracy, row.stage2.macro_f1, row.overall.accuracy) == expected


def test_metrics_document_is_written_and_read(spark, sf, tmp_path):
    from flowlens.operators.evaluate import metrics_document
    from flowlens.plans.metric_queries import final
    from flowlens.schema import ALL_CLASSES
    doc = metrics_document(final(spark, sf), ALL_CLASSES)
    writers.write_json_document(doc, f"{tmp_path}/metrics")
    back, want = readers.read_metrics(spark, f"{tmp_path}/metrics").first(), doc.first()
    assert back.stage1.auc_roc == want.stage1.auc_roc and back.overall.macro_f1 == want.overall.macro_f1


def test_alerts_are_stored_by_day(spark, tmp_path):
    import datetime as dt
    df = spark.createDataFrame([("1", dt.datetime(2024, 1, 1)), ("2", dt.datetime(2024, 1, 2))],
                               "id string, timestamp timestamp")
    for batch in ("a", "b", "b"):  # a batch written again is replaced
        writers.write_alerts(df, f"{tmp_path}/alerts", batch)
    table = readers.read_table(spark, f"{tmp_path}/alerts")
    assert table.count() == 4 and table.filter("day = date'2024-01-02'").count() == 2
    recent = readers.read_alerts_since(spark, f"{tmp_path}/alerts", F.lit(dt.datetime(2024, 1, 1, 12)))
    assert [r.id for r in recent.collect()] == ["2", "2"]


class Settings(dict):
    """Stands for a session: only its settings are asked."""

    @property
    def conf(self):
        return self


def test_scratch_follows_the_session(spark):
    shared = Settings({"spark.checkpoint.dir": "hdfs://cluster/shared/", "spark.master": "yarn"})
    assert runtime.scratch_dir(shared) == "hdfs://cluster/shared"
    assert runtime.scratch_path(shared, "x").startswith("hdfs://cluster/shared/flowlens/x-")
    with pytest.raises(RuntimeError):
        runtime.scratch_dir(Settings({"spark.master": "yarn"}))
    assert runtime.scratch_dir(spark) == runtime.scratch_dir(spark)
    stored = runtime.materialise(spark.range(3), "x")
    assert stored.count() == 3 and runtime.scratch_dir(spark) in stored.inputFiles()[0]


def test_flow_layout():
    assert [f.name for f in flow_schema()][:5] == ["srcip", "sport", "dstip", "dsport", "proto"]


def test_every_test_module_has_a_name_of_its_own():
    """Two modules of one name hide each other, and the tests of one of them do not run."""
    from collections import Counter
    from pathlib import Path
    here = Path(__file__).resolve().parent
    names = Counter(p.stem for p in here.rglob("*.py") if p.stem not in ("__init__", "conftest"))
    assert [n for n, k in names.items() if k > 1] == []
    assert not any("from conftest" in p.read_text() for p in here.rglob("test_*.py") if p.name != Path(__file__).name)
