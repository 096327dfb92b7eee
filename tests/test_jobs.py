"""The three jobs from raw CSV to alerts, over the test tables."""

from pyspark.sql import functions as F

from flowlens import jobs
from flowlens.detection.detector import load_detector
from flowlens.plans.flow_queries import _in_layout
from flowlens.operators.alerts import alerts_page
from flowlens.schema import alert_schema
from flowlens.sources.readers import read_alerts_since, read_metrics, read_table
from flowlens.sources.writers import as_messages
from flowlens.streaming.ingest import text_stream


def test_prepare_train_watch(spark, sf, tmp_path):
    raw, out, model = f"{tmp_path}/raw", f"{tmp_path}/flows", f"{tmp_path}/model"
    flows = _in_layout(spark, sf)
    # a benign flow sends little, so there is something to learn
    told = flows.withColumn("attack_cat", F.when(F.col("sbytes") > 25, "DoS")).repartition(3)
    told.write.csv(raw)
    counts = jobs.prepare_flows(spark, f"{raw}/*.csv", out, method="exact", files=2).first()
    train, test = read_table(spark, f"{out}/train"), read_table(spark, f"{out}/test")
    assert counts.n_rows == flows.count() == counts.n_train + counts.n_test
    assert (train.count(), test.count()) == (counts.n_train, counts.n_test)
    assert {"bytes_ratio", "avg_dur_proto", "avg_dur_state", "threat_score"} <= set(train.columns)
    assert not {"srcip", "stime", "label"} & set(train.columns) and len(train.inputFiles()) == 2

    verdict = jobs.train_detector(spark, out, model, trees1=5, trees2=5).first()
    assert verdict.verdict == "OK" and verdict.test_accuracy > 0.95
    figures = read_metrics(spark, f"{model}/metrics").first()
    assert figures.overall.accuracy == verdict.test_accuracy
    assert min(figures.stage1.accuracy, figures.stage1.auc_roc, figures.stage2.accuracy, figures.overall.macro_f1) > 0
    assert spark.read.json(f"{model}/confusion").count() >= 2 and spark.read.json(f"{model}/importances").count() > 0
    assert set(r["column"] for r in spark.read.json(f"{model}/category_codes").collect()) <= {"proto", "state", "service"}
    assert spark.read.json(f"{model}/classes").count() == 2

    topic, alerts = f"{tmp_path}/topic", f"{tmp_path}/alerts"
    messages = as_messages(flows).distinct()
    messages.write.text(topic)
    messages.limit(200).write.mode("append").text(topic)  # delivered again
    spark.createDataFrame([("broken",), ("",), ("{\"sbytes\":",)], "value string").write.mode("append").text(topic)
    detector, profile = load_detector(f"{model}/pipeline"), jobs.read_profile(spark, out)
    stream = text_stream(spark, topic, max_files_per_trigger=3)
    jobs.watch(stream, detector, profile, alerts, f"{tmp_path}/cp", drain=True).awaitTermination()
    found = spark.read.parquet(alerts)
    told = messages.withColumn(jobs.MESSAGE, F.sha2("value", 256))
    _, wanted = jobs.alerts_by_message(told, detector, profile, F.lit("2024-01-01").cast("timestamp"))
    same = ["id", "srcip", "attack_cat", "confidence", "threat_score"]
    assert found.count() == wanted.count() > 0
    assert sorted(wanted.select(same).collect()) == sorted(found.select(same).collect())
    assert {r.attack_cat for r in found.select("attack_cat").distinct().collect()} == {"DoS"}
    assert found.filter("source <> 'streaming' or threat_score < 50 or timestamp is null").isEmpty()
    assert {r.value for r in spark.read.parquet(f"{alerts}_rejects").collect()} >= {"broken", "{\"sbytes\":"}
    counts = spark.read.parquet(f"{alerts}_counts").agg(F.sum("total_records"), F.sum("attacks_detected")).first()
    assert tuple(counts) == (messages.count(), found.count())
    # what the stream wrote is what the readers read
    since = found.agg(F.max("timestamp")).first()[0]
    recent = read_alerts_since(spark, alerts, F.lit(since))
    assert recent.count() == found.filter(F.col("timestamp") == F.lit(since)).count() > 0
    assert [f.name for f in alert_schema().fields] == recent.columns
    assert len(alerts_page(recent, 1, 5).collect()) == min(5, recent.count())
