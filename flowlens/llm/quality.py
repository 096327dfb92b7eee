"""Quality classifier by positive-unlabelled learning.

Trusted positives are labelled rows of quality 1; everything else is unlabelled web text, whose labels are never
looked at.  A logistic score is fitted by the non-negative unbiased risk

    prior * R+(positives) + max(0, R-(unlabelled) - prior * R-(positives)),

with the paper's rule for mini-batches: where the bracket is below zero, the step goes up its gradient.  The class prior
is estimated first: a classifier of positives against unlabelled text orders a set-aside half of both, and the
least ratio of their upper tails, with a confidence term, is the prior (best bin estimation).

Features come from whole texts: shares of byte classes, lengths, repetition of words, word triples and lines, and
hashed letter triples; nothing else of a row enters.  Fitting reads at most ``max_positives`` and ``max_unlabelled``
rows of the training fold, the ones least in a hash of their id; scoring covers every row and needs no shuffle.

Edge cases: null and empty texts have zero features and a score like any other; labels without a document, repeated or null labels
are ignored; a document without id is scored, never learnt from and not held out; without positives every score is
0.5; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlens.llm.arrowtext import LOWER, Texts, parts_of, roller, texts_of, word_hashes, words_of

CLASSES = ["\n", " \t\r", "0123456789", ".,;:", "!?", "#*$%&", "|<>{}[]\\/=+-_~^@", "\"'()`"]
HASHED = 128
ROWS = 2000  # texts whose features are made at once


@dataclass(frozen=True)
class Learning:
    max_positives: int = 10_000
    max_unlabelled: int = 14_000
    epochs: int = 60
    batch: int = 512
    rate: float = 0.02
    ridge: float = 1e-3
    beta: float = 0.0
    seed: int = 3


@dataclass(frozen=True)
class Model:
    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float

    def score(self, features: np.ndarray) -> np.ndarray:
        z = np.clip((features - self.centre) / self.scale, -5, 5) @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def is_held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


_CLASS = np.full(256, len(CLASSES), np.int64)
for _i, _letters in enumerate(CLASSES):
    _CLASS[[ord(c) for c in _letters]] = _i
_CLASS[65:91] = len(CLASSES) + 1
_CLASS[128:] = len(CLASSES) + 2


def _distinct(owner: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    """Distinct values per owner."""
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    new = np.ones(len(value), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
    return np.bincount(owner[new], minlength=n)


def features(texts: Texts) -> np.ndarray:
    n, k = len(texts), len(CLASSES) + 3
    size = np.diff(texts.offsets)
    owner = np.repeat(np.arange(n), size)
    shares = np.bincount(owner * k + _CLASS[texts.data], minlength=n * k).reshape(n, k) / np.maximum(size, 1)[:, None]
    words = words_of(texts)
    counts = words.counts()
    word_owner = np.repeat(np.arange(n), counts)
    hashes = word_hashes(texts, words, roller(31), fold_case=True)
    triples = roller(32).windows(hashes, 3)
    inside = word_owner[: len(triples)] == word_owner[2:][: len(triples)]
    lines_end = np.unique(np.concatenate([np.flatnonzero(texts.data == 10), texts.offsets[1:]]))
    lines_start = np.concatenate([[0], lines_end[:-1] + (texts.data[np.minimum(lines_end[:-1], max(0, len(texts.data) - 1))] == 10 if len(texts.data) else 0)])
    real = lines_end > lines_start
    lines_start, lines_end = lines_start[real], lines_end[real]
    line_owner = np.searchsorted(texts.offsets, lines_start, "right") - 1
    line_hash = roller(33).spans(roller(33).letters[texts.data], lines_start, lines_end)
    n_lines = np.bincount(line_owner, minlength=n)
    n_triples = np.bincount(word_owner[: len(triples)][inside], minlength=n)
    some = np.maximum(counts, 1)
    letters = words.end - words.start
    length = np.bincount(word_owner, letters, n) / some
    spread = np.sqrt(np.maximum(0, np.bincount(word_owner, letters**2, n) / some - length**2))
    stats = np.column_stack([
        np.sqrt(shares), np.log1p(size), np.log1p(length), np.log1p(spread),
        _distinct(word_owner, hashes, n) / some, np.log1p(counts) - np.log1p(_distinct(word_owner, hashes, n)),
        1 - _distinct(word_owner[: len(triples)][inside], triples[inside], n) / np.maximum(n_triples, 1) * (n_triples > 0) - (n_triples == 0),
        1 - _distinct(line_owner, line_hash, n) / np.maximum(n_lines, 1) * (n_lines > 0) - (n_lines == 0),
        np.log1p(n_lines / some), np.bincount(word_owner, letters > 15, n) / some])
    low = LOWER[texts.data].astype(np.uint32)
    hashed = np.zeros((n, HASHED))
    if len(low) > 2:
        code = ((low[:-2] * np.uint32(0x9E3779B1)) ^ (low[1:-1] * np.uint32(0x85EBCA77)) ^ (low[2:] * np.uint32(0xC2B2AE3D)))
        code = ((code ^ (code >> np.uint32(15))) * np.uint32(0x2C1B3C6D)) >> np.uint32(25)
        within = owner[:-2] == owner[2:]
        hashed = np.bincount(owner[:-2][within] * HASHED + code[within], minlength=n * HASHED).reshape(n, HASHED)
        hashed = np.sqrt(hashed / np.maximum(size - 2, 1)[:, None])
    return np.column_stack([stats, hashed]).astype(np.float32)


def _small_parts(batch: pa.RecordBatch, at: int) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    for i in range(0, batch.num_rows, ROWS):
        yield from parts_of(batch.slice(i, ROWS), at)


def _gradient(x, weight, bias, target):
    """Mean logistic loss towards ``target`` (1 or 0) and its gradient."""
    z = x @ weight + bias
    p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    loss = np.logaddexp(0, -z if target else z).mean()
    return loss, x.T @ (p - target) / len(x), (p - target).mean()


def _descend(x_pos, x_unl, how: Learning, step) -> tuple[np.ndarray, float]:
    """Adam on the gradient that ``step`` gives for a batch of each kind."""
    rng = np.random.default_rng(how.seed)
    w, b = np.zeros(x_pos.shape[1]), 0.0
    m, v, t = np.zeros(len(w) + 1), np.zeros(len(w) + 1), 0
    n_batches = max(1, len(x_unl) // how.batch)
    for epoch in range(how.epochs):
        rate = how.rate / (1 + 0.1 * epoch)
        pos, unl = (np.array_split(rng.permutation(len(x)), n_batches) for x in (x_pos, x_unl))
        for i, j in zip(pos, unl):
            if not len(i) or not len(j):
                continue
            g_w, g_b = step(x_pos[i], x_unl[j], w, b)
            g = np.append(g_w + how.ridge * w, g_b)
            t += 1
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            move = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
            w, b = w - move[:-1], b - move[-1]
    return w, b


def estimate_prior(pos: np.ndarray, unl: np.ndarray, delta: float = 0.1) -> float:
    """Best bin estimation from scores of positives and unlabelled rows that the scorer has not seen."""
    cut = np.unique(pos)
    tail = lambda s: 1 - np.searchsorted(np.sort(s), cut, "left") / len(s)
    p, u = tail(pos), tail(unl)
    doubt = np.sqrt(np.log(4 / delta) / (2 * len(pos))) + np.sqrt(np.log(4 / delta) / (2 * len(unl)))
    best = np.argmin((u + doubt) / p)
    return float(np.clip(u[best] / p[best], 0.01, 0.99))


def fit(positives: np.ndarray, unlabelled: np.ndarray, how: Learning = Learning()) -> Model:
    if not len(positives) or not len(unlabelled):
        none = np.zeros(features(texts_of(pa.array([""]))).shape[1])
        return Model(none, none + 1, none, 0.0, 0.5)
    centre, scale = unlabelled.mean(0), np.maximum(unlabelled.std(0), 1e-3)
    pos, unl = (np.clip((x - centre) / scale, -5, 5).astype(np.float64) for x in (positives, unlabelled))

    def against(p, u, w, b):
        _, gp, bp = _gradient(p, w, b, 1)
        _, gu, bu = _gradient(u, w, b, 0)
        return gp + gu, bp + bu

    if len(pos) > 3 and len(unl) > 3:
        w, b = _descend(pos[::2], unl[::2], how, against)
        prior = estimate_prior(pos[1::2] @ w + b, unl[1::2] @ w + b)
    else:
        prior = 0.5

    def non_negative(p, u, w, b):
        _, gp, bp = _gradient(p, w, b, 1)
        loss_p, gn, bn = _gradient(p, w, b, 0)
        loss_u, gu, bu = _gradient(u, w, b, 0)
        if loss_u - prior * loss_p < -how.beta:
            return prior * gn - gu, prior * bn - bu
        return prior * gp + gu - prior * gn, prior * bp + bu - prior * bn

    w, b = _descend(pos, unl, how, non_negative)
    return Model(centre, scale, w, b, prior)


def _features_of(docs: DataFrame, ids: DataFrame) -> np.ndarray:
    """Features of a bounded number of documents, in the order of their hash."""
    chosen = docs.join(F.broadcast(ids), "doc_id").select("doc_id", "text")

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in _small_parts(batch, 1):
                found = features(texts)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([row.tobytes() for row in found], pa.binary())], names=["doc_id", "x"])

    rows = chosen.mapInArrow(work, "doc_id long, x binary").toArrow().sort_by("doc_id")
    return np.array([np.frombuffer(x, np.float32) for x in rows.column("x").to_pylist()])


def fit_on(docs: DataFrame, labels: DataFrame, how: Learning = Learning()) -> Model:
    """Fit on the training fold of ``docs`` (doc_id, text) with the positives of ``labels`` (doc_id, quality)."""
    fold = docs.filter(F.col("doc_id").isNotNull() & ~is_held_out()).select("doc_id", "text")
    first = lambda rows, n: rows.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    trusted = labels.filter((F.col("quality") == 1) & ~is_held_out()).select("doc_id").distinct()
    positives = _features_of(fold, first(trusted.join(fold.select("doc_id"), "doc_id", "left_semi"), how.max_positives))
    unlabelled = _features_of(fold, first(fold, how.max_unlabelled))
    return fit(positives, unlabelled, how)


def score_quality(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``score``, the probability of quality."""
    docs = docs.drop("score") if "score" in docs.columns else docs
    names = [*docs.columns, "score"]
    at = names.index(text)
    schema = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType())])

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in _small_parts(batch, at):
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(model.score(features(texts)).astype(np.float64))], names=names)

    return docs.mapInArrow(work, schema)
