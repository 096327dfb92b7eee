"""Evaluation of predictions.  The rule in the adapter stands for the model."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowlens.detection.cascade import final_class
from flowlens.functions.columns import is_attack
from flowlens.operators import evaluate as ev
from flowlens.plans.adapters import PREDICTIONS_SQL, named_flows, predictions
from flowlens.plans.registry import Registry, r6
from flowlens.schema import ALL_CLASSES

REG = Registry()
PREDICTIONS = "WITH" + PREDICTIONS_SQL
_BINARY = """
 SELECT *, (tp + tn) / (tp + fp + tn + fn) AS accuracy, tp / (tp + fp) AS precision, tp / (tp + fn) AS recall,
        2.0 * tp / (2 * tp + fp + fn) AS f1, fp / (fp + tn) AS fpr, fn / (fn + tp) AS fnr
 FROM (SELECT count(*) FILTER (is_attack = 1 AND pred_stage1 = 1) AS tp,
              count(*) FILTER (is_attack = 0 AND pred_stage1 = 1) AS fp,
              count(*) FILTER (is_attack = 0 AND pred_stage1 = 0) AS tn,
              count(*) FILTER (is_attack = 1 AND pred_stage1 = 0) AS fn FROM {source})"""
_RATES = ["accuracy", "precision", "recall", "f1", "fpr", "fnr"]
_CLASS_LIST = ", ".join(f"'{c}'" for c in ALL_CLASSES)


def final(spark, sf):
    return predictions(spark, sf).withColumn("prediction", final_class("pred_stage1", "pred_stage2"))


@REG.add("cascade_rule", PREDICTIONS + " SELECT srcip, dstip, pred_stage1, pred_stage2, prediction FROM final")
def _(spark, sf):
    return final(spark, sf).select("srcip", "dstip", "pred_stage1", "pred_stage2", "prediction")


@REG.add("confusion_matrix", PREDICTIONS + " SELECT * FROM confusion")
def _(spark, sf):
    return ev.confusion_matrix(final(spark, sf))


@REG.add("multiclass_metrics", PREDICTIONS + """
 SELECT round(sum(hits) / sum(support), 6) AS accuracy,
        round(sum(precision * support) / sum(support), 6) AS weighted_precision,
        round(sum(recall * support) / sum(support), 6) AS weighted_recall,
        round(sum(f1 * support) / sum(support), 6) AS weighted_f1 FROM scores""")
def _(spark, sf):
    row = ev.weighted_metrics(ev.confusion_matrix(final(spark, sf)))
    return row.select(*[r6(c) for c in row.columns])


@REG.add("binary_metrics", PREDICTIONS + f"""
 SELECT tp, fp, tn, fn, {', '.join(f'round({c}, 6) AS {c}' for c in _RATES)}
 FROM ({_BINARY.format(source='predictions')})""")
def _(spark, sf):
    row = ev.binary_metrics(predictions(spark, sf), "is_attack", "pred_stage1")
    return row.select("tp", "fp", "tn", "fn", *[r6(c) for c in _RATES])


@REG.add("auc_roc", PREDICTIONS + """,
 ranked AS (SELECT is_attack, rank() OVER (ORDER BY score)
                   + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS mid_rank FROM predictions)
 SELECT round((sum(mid_rank) FILTER (is_attack = 1)
               - count(*) FILTER (is_attack = 1) * (count(*) FILTER (is_attack = 1) + 1.0) / 2)
              / (CAST(count(*) FILTER (is_attack = 1) AS DOUBLE) * count(*) FILTER (is_attack = 0)), 6) AS auc_roc
 FROM ranked""")
def _(spark, sf):
    return ev.auc_roc(predictions(spark, sf), "is_attack", "score").select(r6("auc_roc"))


@REG.add("auc_roc_fine", PREDICTIONS + """,
 fine AS (SELECT CASE WHEN label <> 'Normal' THEN 1 ELSE 0 END AS y, sload AS score
          FROM (SELECT attack_cat AS label, sload FROM named)),
 ranked AS (SELECT y, rank() OVER (ORDER BY score)
                   + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS mid_rank FROM fine)
 SELECT round((sum(mid_rank) FILTER (y = 1) - count(*) FILTER (y = 1) * (count(*) FILTER (y = 1) + 1.0) / 2)
              / (CAST(count(*) FILTER (y = 1) AS DOUBLE) * count(*) FILTER (y = 0)), 6) AS auc_roc
 FROM ranked""")
def _(spark, sf):
    """The same with a score that hardly ever repeats."""
    scored = named_flows(spark, sf).select(is_attack().alias("y"), F.col("sload").alias("score"))
    return ev.auc_roc(scored, "y", "score").select(r6("auc_roc"))


@REG.add("macro_f1", PREDICTIONS + f"""
 SELECT round(avg(coalesce(f1, 0.0)), 6) AS macro_f1,
        round(sum(coalesce(f1, 0.0) * coalesce(support, 0)) / sum(coalesce(support, 0)), 6) AS weighted_f1
 FROM (SELECT unnest([{_CLASS_LIST}]) AS class) LEFT JOIN scores USING (class)""")
def _(spark, sf):
    return ev.averaged_f1(ev.confusion_matrix(final(spark, sf)), ALL_CLASSES).select(r6("macro_f1"), r6("weighted_f1"))


@REG.add("class_report", PREDICTIONS + f""",
 listed AS (SELECT class, coalesce(precision, 0.0) AS precision, coalesce(recall, 0.0) AS recall,
                   coalesce(f1, 0.0) AS f1, CAST(coalesce(support, 0) AS BIGINT) AS support
            FROM (SELECT unnest([{_CLASS_LIST}]) AS class) LEFT JOIN scores USING (class))
 SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM listed
 UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6),
                  CAST(sum(support) AS BIGINT) FROM listed
 UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6),
                  round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6),
                  CAST(sum(support) AS BIGINT) FROM listed""")
def _(spark, sf):
    report = ev.class_report(ev.confusion_matrix(final(spark, sf)), ALL_CLASSES)
    return report.select("class", r6("precision"), r6("recall"), r6("f1"), "support")


@REG.add("top_confusions", PREDICTIONS + """
 SELECT label, prediction, n FROM confusion WHERE label <> prediction
 ORDER BY n DESC, label DESC, prediction DESC LIMIT 5""")
def _(spark, sf):
    return ev.top_confusions(ev.confusion_matrix(final(spark, sf)))


@REG.add("overfit_verdict", PREDICTIONS + """,
 conf AS (SELECT score <= 0.07 AS train, label, prediction, count(*) AS n FROM final GROUP BY ALL),
 per AS (SELECT train, class, sum(s) AS support, sum(p) AS predicted, sum(h) AS hits FROM (
    SELECT train, label AS class, n AS s, 0 AS p, CASE WHEN label = prediction THEN n ELSE 0 END AS h FROM conf
    UNION ALL SELECT train, prediction, 0, n, 0 FROM conf) GROUP BY ALL),
 m AS (SELECT train, sum(hits) / sum(support) AS accuracy,
              sum(CASE WHEN hits = 0 THEN 0.0 ELSE 2.0 * hits / (support + predicted) END * support) / sum(support) AS f1
       FROM per GROUP BY 1)
 SELECT round(a.accuracy, 6) AS train_accuracy, round(b.accuracy, 6) AS test_accuracy,
        round(a.accuracy - b.accuracy, 6) AS accuracy_gap, round(a.f1 - b.f1, 6) AS f1_gap,
        CASE WHEN a.accuracy - b.accuracy > 0.05 THEN 'OVERFIT' WHEN a.accuracy - b.accuracy > 0.02 THEN 'CAUTION'
             ELSE 'OK' END AS verdict
 FROM m a JOIN m b ON a.train AND NOT b.train""")
def _(spark, sf):
    rows = final(spark, sf)
    train = ev.weighted_metrics(ev.confusion_matrix(rows.filter("score <= 0.07")))
    test = ev.weighted_metrics(ev.confusion_matrix(rows.filter("score > 0.07")))
    out = ev.overfit_verdict(train, test)
    return out.select(*[r6(c) for c in out.columns if c != "verdict"], "verdict")


@REG.add("metrics_document", PREDICTIONS + f""",
 s1 AS ({_BINARY.format(source='predictions')}),
 c2 AS (SELECT label, pred_stage2 AS prediction, count(*) AS n FROM predictions WHERE is_attack = 1 GROUP BY ALL)
 SELECT round(s1.accuracy, 6) AS stage1_accuracy, round(s1.precision, 6) AS stage1_precision,
        round(s1.recall, 6) AS stage1_recall, round(s1.f1, 6) AS stage1_f1,
        s1.tp AS stage1_tp, s1.fp AS stage1_fp, s1.tn AS stage1_tn, s1.fn AS stage1_fn,
        (SELECT round(sum(n) FILTER (label = prediction) / sum(n), 6) FROM c2) AS stage2_accuracy,
        (SELECT round(sum(hits) / sum(support), 6) FROM scores) AS overall_accuracy,
        (SELECT round(avg(coalesce(f1, 0.0)), 6) FROM (SELECT unnest([{_CLASS_LIST}]) AS class)
           LEFT JOIN scores USING (class)) AS overall_macro_f1,
        (SELECT round(sum(f1 * support) / sum(support), 6) FROM scores) AS overall_weighted_f1
 FROM s1""")
def _(spark, sf):
    doc = ev.metrics_document(final(spark, sf), ALL_CLASSES)
    return doc.select(
        *[r6(f"stage1.{c}", f"stage1_{c}") for c in ("accuracy", "precision", "recall", "f1")],
        *[F.col(f"stage1.{c}").alias(f"stage1_{c}") for c in ("tp", "fp", "tn", "fn")],
        r6("stage2.accuracy", "stage2_accuracy"),
        *[r6(f"overall.{c}", f"overall_{c}") for c in ("accuracy", "macro_f1", "weighted_f1")],
    )
