"""Held-out accuracy, the risk on known mixtures, and odd rows."""

import zlib

import numpy as np
import pyarrow as pa

from flowlens.llm import quality as q
from flowlens.llm.arrowtext import texts_of
from flowlens.llm.queries import LLM


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    rows = LLM.queries["op1_quality_classifier"](spark, sf).collect()
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    held = [(r.score, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    good, bad = ([s for s, y in held if y == v] for v in (1, 0))
    assert np.mean([(g > b) + (g == b) / 2 for g in good for b in bad]) > 0.97
    assert np.mean([(s >= 0.5) == (y == 1) for s, y in held]) > 0.95


def test_prior_and_risk_on_a_known_mixture():
    rng = np.random.default_rng(1)
    draw = lambda n, at: rng.normal(at, 1, (n, 6)).astype(np.float32)
    for prior in (0.3, 0.7):
        n = 6000
        pos, unl = draw(4000, 1.2), np.concatenate([draw(int(n * prior), 1.2), draw(n - int(n * prior), -1.2)])
        model = q.fit(pos, unl, q.Learning(epochs=20))
        assert abs(model.prior - prior) < 0.06
        y = np.arange(n) < int(n * prior)
        assert ((model.score(unl) >= 0.5) == y).mean() > 0.97


def test_features_do_not_depend_on_the_batch():
    texts = ["", "A b c.\nA b c.\n\nx | y", "é😀 \n", None, "same same same same", "\n\n", "x" * 5000, "Trail\n"]
    together = q.features(texts_of(pa.array(texts)))
    for i, t in enumerate(texts):
        assert np.allclose(together[i], q.features(texts_of(pa.array([t], pa.string())))[0], atol=1e-6), t
    assert np.isfinite(together).all()


def test_edge_rows(spark):
    schema = "doc_id long, text string, score string"
    docs = spark.createDataFrame([(1, None, "s"), (1, "a", "s"), (None, "b c", None), (4, "d " * 60_000, None)], schema)
    none = spark.createDataFrame([], "doc_id long, quality int")
    model = q.fit_on(docs, none)
    assert [r.score for r in q.score_quality(docs, model).collect()] == [0.5] * 4
    assert q.score_quality(docs.limit(0), model).count() == 0
    labels = spark.createDataFrame([(1, 1), (1, 1), (4, None), (None, 1), (77, 1)], "doc_id long, quality int")
    out = q.score_quality(docs, q.fit_on(docs, labels)).collect()
    assert len(out) == 4 and all(0 <= r.score <= 1 for r in out)
