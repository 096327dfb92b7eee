"""Evaluation of a detector on both sides of the split, as DataFrames."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from flowlens.detection.detector import Detector, feature_importances
from flowlens.operators import evaluate as ev
from flowlens.runtime import materialise

LABEL, PREDICTED = "attack_cat", "predicted_class"


@dataclass(frozen=True)
class Report:
    train: DataFrame
    test: DataFrame
    verdict: DataFrame
    confusion: DataFrame
    per_class: DataFrame
    confused_pairs: DataFrame
    importances: DataFrame | None


def evaluate_detector(detector: Detector, train: DataFrame, test: DataFrame, top: int = 10) -> Report:
    """Metrics of both sides, the overfit verdict, the confusion matrix and what the model relies on."""
    seen, unseen = (materialised_confusion(detector, side) for side in (train, test))
    figures = [ev.weighted_metrics(c, LABEL, PREDICTED) for c in (seen, unseen)]
    spark = test.sparkSession
    try:
        importances = feature_importances(detector, spark, stage=1 if detector.two_stages else 2, top=top)
    except ValueError:
        importances = None
    return Report(
        train=figures[0], test=figures[1], verdict=ev.overfit_verdict(*figures), confusion=unseen,
        per_class=ev.class_report(unseen, label=LABEL, prediction=PREDICTED),
        confused_pairs=ev.top_confusions(unseen, label=LABEL, prediction=PREDICTED), importances=importances,
    )


def materialised_confusion(detector: Detector, rows: DataFrame) -> DataFrame:
    """Confusion matrix of one side, scored once."""
    return materialise(ev.confusion_matrix(detector.score(rows), LABEL, PREDICTED), "confusion")
