"""A few rows are not spread thinner than their number is worth."""

from pyspark.sql import functions as F

from flowlens.detection import detector as dt
from flowlens.plans import flow_queries


class Learner:
    """Stands in for an estimator and notes the tasks of its rows."""

    def __init__(self, tasks):
        self.tasks = tasks

    def copy(self):
        return self

    def fit(self, rows):
        self.tasks.append((rows.rdd.getNumPartitions(), rows.count()))
        return self.tasks

    def __getattr__(self, name):
        if name.startswith("set"):
            return lambda *_: self
        raise AttributeError(name)


def test_models_per_class_of_few_rows(spark, monkeypatch):
    rows = spark.range(500).select((F.col("id") % 3).cast("double").alias(dt.LABEL_INDEX)).repartition(6)
    tasks = []
    dt._fit_classes(dt.PerClass(Learner(tasks)), rows)
    assert tasks == [(1, 500)] * 3
    monkeypatch.setattr(dt, "TASK_ROWS", 100)
    dt._fit_classes(dt.PerClass(Learner(tasks)), rows)
    assert tasks[3:] == [(5, 500)] * 3


def test_csv_files_are_compressed(spark, sf, monkeypatch):
    paths, real = [], flow_queries.scratch_path
    monkeypatch.setattr(flow_queries, "scratch_path", lambda *a: paths.append(real(*a)) or paths[-1])
    assert flow_queries.REG.queries["flows_csv_roundtrip"](spark, sf).count() > 0
    assert all(name.endswith(".csv.gz") for name in spark.read.text(paths[0]).inputFiles())
