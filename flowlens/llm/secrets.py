"""Secret scans: fixed base patterns, then a character convolutional network over further candidates.

Base findings are the contract's three kinds and are never dropped.  Every token of ``CANDIDATE`` (16 or more key
characters) that is not wholly inside base findings is a candidate.  The network reads it in overlapping windows of
``WIDTH`` characters, the last one reaching into the text behind it, and the highest probability decides; characters
of the candidate and characters around it are different inputs.  The network is numpy: character embedding, one
convolution, maximum over the positions, a hidden layer, a logistic output.  It is trained on windows of texts that
``labelled_texts`` makes from a seed: keys of several alphabets after assignment-like contexts, some of them at the
end of long paths or chains, against identifiers, paths, numbers, words, rules and addresses.  Two thirds of the windows
train, the others calibrate the output (Platt).  The threshold is the largest one (at most 0.5) at which ``scan`` itself finds
``min_recall`` of the secrets in further texts.

No shuffle; whole texts; the weights (about 40 kB) travel with the function.

Edge cases: null text counts as empty; spans are code points, end exclusive; an empty table gives an empty result; repeated
rows are scanned each; other columns are passed through.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# fixed values: the contract's kinds, in its order
KINDS = ["assign", "access", "hex"]
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a run of 24 or more is the same as a whole run that is long enough
CUES = ("passw", "secret", "token", "apikey", "api_key")  # every assignment holds one of these

CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}")
MODEL_KIND = "model"
WIDTH = 80  # characters of a window: 24 before the place it judges, then the rest
BEFORE = 24
STEP = 28  # from window to window; a key of up to 52 characters is whole in one of them
CLASSES = 97  # of characters; twice as many inputs, for characters around a candidate and in it


def base_findings(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the three base kinds."""
    found = []
    if "=" in text or ":" in text:
        low = text.lower()
        if any(cue in low for cue in CUES):
            found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def other_candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Candidate spans that reach beyond the base findings."""
    out, starts, ends = [], [], []
    for s, _, e in base:  # joined where they overlap or touch, so that bisection finds the only one that may hold a span
        if ends and s <= ends[-1]:
            ends[-1] = max(ends[-1], e)
        else:
            starts.append(s)
            ends.append(e)
    for m in CANDIDATE.finditer(text):
        s, e = m.span()
        k = bisect_right(starts, s) - 1
        if k < 0 or ends[k] < e:
            out.append((s, e))
    return out


def places(start: int, end: int) -> range:
    """Where the windows of a candidate begin to judge; the last one sees its end."""
    return range(start, max(start + 1, end - (WIDTH - BEFORE) + STEP), STEP)


KEY = np.zeros(128, bool)
KEY[[ord(c) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"]] = True


def encode(text: str, start: int, end: int) -> np.ndarray:
    """Inputs of the window that judges a candidate, which ends at ``end``, from ``start`` on.

    Class 0 pads, 96 is any other character; the characters of the candidate, also those before ``start``, are raised by ``CLASSES``.
    """
    window = text[max(0, start - BEFORE): start].rjust(BEFORE, "\0") + text[start: start + WIDTH - BEFORE]
    codes = np.frombuffer(window.ljust(WIDTH, "\0").encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    other = np.flatnonzero(~KEY[np.minimum(codes[:BEFORE], 127)])
    begin = other[-1] + 1 if len(other) else 0
    classes = np.where(codes == 0, 0, np.where((codes >= 32) & (codes < 127), codes - 31, CLASSES - 1))
    classes[begin: BEFORE + max(0, end - start)] += CLASSES
    return classes


@dataclass(frozen=True)
class Net:
    """Sizes, training effort and the recall that the threshold must keep."""

    embed: int = 12
    filters: int = 32
    span: int = 5
    hidden: int = 16
    epochs: int = 12
    findings: int = 6000  # bound on the labelled windows
    texts: int = 3000  # bound on the texts that recall is measured on
    min_recall: float = 0.98
    seed: int = 7


def labelled_texts(n: int, seed: int) -> tuple[list[tuple[str, int, int]], np.ndarray]:
    """(text, start, end) of a key or of something harmless, and whether it is a secret; made by rule, half of each."""
    rng = np.random.default_rng(seed)
    pick = lambda xs: xs[rng.integers(len(xs))]
    chars = lambda alphabet, k: "".join(rng.choice(list(alphabet), k))
    upper, lower, digit = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
    syllables = ["an", "er", "the", "in", "on", "re", "st", "en", "at", "ti", "or", "al", "is", "le", "ou", "ment", "tion", "ing",
                 "ha", "th", "wh", "nd", "ly", "ea", "es", "ed", "que", "eau", "eux", "ier", "ai", "vi", "cion", "os", "ue", "ez", "rr", "ll", "ja", "bo",
                 "sch", "ch", "heit", "keit", "lich", "ung", "ein", "ver", "ge", "be", "zu", "pf", "tz", "nicht", "und", "der", "com", "pro", "con", "ble"]
    word = lambda k: "".join(pick(syllables) for _ in range(k))

    def secret() -> str:
        k = int(rng.integers(16, 64))
        return pick([
            lambda: chars(upper + lower + digit, k), lambda: chars(upper + lower + digit + "+/", k) + "=" * int(rng.integers(3)),
            lambda: "ghp_" + chars(upper + lower + digit, 36), lambda: "sk_live_" + chars(upper + lower + digit, 24),
            lambda: "xoxb-" + chars(digit, 11) + "-" + chars(upper + lower + digit, 24), lambda: chars(lower + digit, k),
            lambda: "AIza" + chars(upper + lower + digit + "_-", 35), lambda: chars(upper + digit, k),
            lambda: chars(upper + lower + digit, int(rng.integers(16, 25))), lambda: chars(upper + lower, k)])()

    def chain() -> str:
        """Path words or assignments in a row."""
        parts = [word(int(rng.integers(1, 5))) for _ in range(int(rng.integers(2, 16)))]
        parts = [pick([x, x, x, x.capitalize(), x + str(rng.integers(99)), str(rng.integers(2030))]) for x in parts]
        return pick(["/", "/", "_", "-", "="]).join(parts)

    def wordy() -> str:
        x = word(int(rng.integers(5, 12)))
        return pick([x, x.capitalize(), x.upper(), x.upper(), word(2) + "-" + x, "".join(word(2).capitalize() for _ in range(5))])

    def harmless() -> str:
        made = pick([
            lambda: word(5) + str(rng.integers(10)) + word(2), lambda: "_".join(word(2) for _ in range(4)) + "_" + str(rng.integers(99)),
            lambda: "/".join(word(2) for _ in range(4)) + "/" + str(rng.integers(2030)), lambda: "-".join(word(2) for _ in range(4)) + "-" + str(rng.integers(999)),
            lambda: "v" + "-".join(str(rng.integers(999)) for _ in range(6)), lambda: str(rng.integers(1900, 2030)) + "-" + word(6),
            lambda: "".join(w.capitalize() for w in (word(2), word(3), word(2))) + str(rng.integers(99)), lambda: chars(digit, 18) + pick(["ms", "kb", "px"]),
            lambda: "=" * 20 + word(2) + str(rng.integers(9)), lambda: "a1" * int(rng.integers(8, 20)), lambda: word(3) + "_" * 12 + str(rng.integers(9)),
            wordy, wordy, wordy, wordy, wordy, chain, chain, chain, lambda: chars(digit, int(rng.integers(16, 24))),
            lambda: pick("-=_/+aXn") * int(rng.integers(16, 90)), lambda: pick(["-=", "ha", "xo", "+-", "ab"]) * int(rng.integers(8, 40))])()
        while len(made) < 16:
            made += word(2)
        return made

    loaded = ["key: ", "auth = '", "bearer ", "pwd=", "credential \"", "export KEY=", "Authorization: Basic ", " "]
    plain = ["see ", "the file ", "in ", "release ", "https://host.example/", "section ", "class ", " "]
    rows, labels = [], np.arange(n) % 2
    for label in labels:
        lead = " ".join(word(int(rng.integers(1, 4))) for _ in range(4)) + " "
        before = lead + pick(loaded if label == (rng.random() < 0.8) else plain)
        token = secret() if label else harmless()
        if label and rng.random() < 0.35:
            before += chain() + pick(["/", "/", "="])
        behind = pick([" ", " ", ". ", "' ", "\n", ", "]) + pick([word(3), word(3), wordy(), secret() if rng.random() < 0.3 else word(2)])
        if label and rng.random() < 0.15:
            behind = pick(["/", "=", "_"]) + chain() + behind
        rows.append((before + token + behind, len(before), len(before) + len(token)))
    return rows, labels.astype(np.float64)


def labelled_findings(n: int, seed: int) -> tuple[list[tuple[str, int, int]], np.ndarray]:
    """(text, place, end) of windows as ``scan`` makes them, and whether they hold a secret; half of each.

    A window of a text with a secret is one that sees most of it, or one that sees nothing of it and is harmless.
    """
    rows, found = {0: [], 1: []}, 0
    while min(len(rows[0]), len(rows[1])) < n // 2 + 1:
        texts, labels = labelled_texts(n, seed + 7919 * found)
        found += 1
        for (text, start, end), label in zip(texts, labels):
            s, e = next(m.span() for m in CANDIDATE.finditer(text) if m.start() <= start < m.end())
            seen = [(p, min(end, p + WIDTH - BEFORE) - max(start, p - BEFORE, s)) for p in places(s, e)]
            best = max(seen, key=lambda x: x[1])[0]
            if label:
                rows[1].append((text, best, e))
                rows[0] += [(text, p, e) for p, n_seen in seen if n_seen <= 0][-1:]
            else:
                rows[0].append((text, seen[found * len(text) % len(seen)][0], e))
    rng = np.random.default_rng(seed)
    kinds = [[rows[k][i] for i in rng.permutation(len(rows[k]))] for k in (0, 1)]
    labels = np.arange(n) % 2
    return [kinds[k][i // 2] for i, k in enumerate(labels)], labels.astype(np.float64)


def _forward(w: dict[str, np.ndarray], x: np.ndarray) -> tuple[np.ndarray, ...]:
    span, n = int(w["span"]), len(x)
    embedded = w["embed"][x]
    steps = embedded.shape[1] - span + 1
    columns = np.concatenate([embedded[:, k: k + steps] for k in range(span)], axis=2)
    maps = columns @ w["conv"] + w["conv_b"]
    best = maps.argmax(axis=1)
    pooled = np.maximum(np.take_along_axis(maps, best[:, None, :], 1)[:, 0], 0)
    hidden = np.maximum(pooled @ w["hid"] + w["hid_b"], 0)
    return hidden @ w["out"] + w["out_b"], hidden, pooled, best, columns, np.arange(n)


def _gradients(w: dict[str, np.ndarray], x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    logit, hidden, pooled, best, columns, rows = _forward(w, x)
    d_logit = (1 / (1 + np.exp(-logit)) - y) / len(y)
    d_hidden = np.outer(d_logit, w["out"]) * (hidden > 0)
    d_pooled = (d_hidden @ w["hid"].T) * (pooled > 0)
    chosen = columns[rows[:, None], best]  # rows, filters, span * embed
    g = {"out": hidden.T @ d_logit, "out_b": d_logit.sum(), "hid": pooled.T @ d_hidden, "hid_b": d_hidden.sum(0),
         "conv": np.einsum("nfc,nf->cf", chosen, d_pooled), "conv_b": d_pooled.sum(0), "embed": np.zeros_like(w["embed"])}
    back = (d_pooled[:, :, None] * w["conv"].T[None]).reshape(*d_pooled.shape, int(w["span"]), -1)
    at = x[rows[:, None, None], best[:, :, None] + np.arange(int(w["span"]))]
    np.add.at(g["embed"], at.ravel(), back.reshape(-1, back.shape[-1]))
    return g


@lru_cache(maxsize=4)
def train(net: Net = Net()) -> dict[str, np.ndarray]:
    """Weights with ``scale`` and ``shift`` of the calibration and the ``threshold``; equal for equal settings."""
    rows, y = labelled_findings(net.findings, net.seed)
    x = np.array([encode(*r) for r in rows])
    rng = np.random.default_rng(net.seed)
    order = rng.permutation(len(y))
    fit, calibrate = np.split(order, [2 * len(order) // 3])
    size = net.span * net.embed
    w: dict[str, np.ndarray] = {
        "span": np.array(net.span), "embed": rng.normal(0, 0.5, (2 * CLASSES, net.embed)),
        "conv": rng.normal(0, (2 / size) ** 0.5, (size, net.filters)), "conv_b": np.zeros(net.filters),
        "hid": rng.normal(0, (2 / net.filters) ** 0.5, (net.filters, net.hidden)), "hid_b": np.zeros(net.hidden),
        "out": rng.normal(0, 0.3, net.hidden), "out_b": np.zeros(())}
    mean, square, step = {k: np.zeros_like(v) for k, v in w.items()}, {k: np.zeros_like(v) for k, v in w.items()}, 0
    for _ in range(net.epochs):
        for part in np.array_split(rng.permutation(fit), max(1, len(fit) // 64)):
            step += 1
            for k, g in _gradients(w, x[part], y[part]).items():
                mean[k] = 0.9 * mean[k] + 0.1 * g
                square[k] = 0.999 * square[k] + 0.001 * g * g
                w[k] = w[k] - 3e-3 * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8)
    a, b, logit = 1.0, 0.0, _forward(w, x[calibrate])[0]
    for _ in range(200):  # Platt scaling by Newton's method
        p = 1 / (1 + np.exp(-np.clip(a * logit + b, -30, 30)))
        g = np.array([((p - y[calibrate]) * logit).mean() + 1e-3 * (a - 1), (p - y[calibrate]).mean() + 1e-3 * b])
        s = p * (1 - p)
        h = np.array([[(s * logit * logit).mean() + 1e-3, (s * logit).mean()], [(s * logit).mean(), s.mean() + 1e-3]])
        move = np.linalg.solve(h, g)
        a, b = a - move[0], b - move[1]
        if np.abs(move).max() < 1e-9:
            break
    w |= {"scale": np.array(a), "shift": np.array(b)}
    scores = np.sort([reach(text, start, end, w) for (text, start, end), label in zip(*labelled_texts(net.texts, net.seed + 1)) if label])
    return w | {"threshold": np.array(min(0.5, scores[int((1 - net.min_recall) * len(scores))]))}


def reach(text: str, start: int, end: int, w: dict[str, np.ndarray]) -> float:
    """The largest threshold at which ``scan`` covers text[start:end]: 1 by a base finding, 0 if no candidate covers it."""
    base = base_findings(text)
    if any(s <= start and end <= e for s, _, e in base):
        return 1.0
    others = [(s, e) for s, e in other_candidates(text, base) if s <= start and end <= e]
    return float(judge(text, others, w).max()) if others else 0.0


def probability(w: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    """Calibrated probability of being a secret, for encoded windows."""
    if not len(x):
        return np.empty(0)
    logit = np.concatenate([_forward(w, part)[0] for part in np.array_split(x, -(-len(x) // 256))])
    return 1 / (1 + np.exp(-np.clip(w["scale"] * logit + w["shift"], -30, 30)))


def judge(text: str, spans: list[tuple[int, int]], w: dict[str, np.ndarray]) -> np.ndarray:
    """The highest probability over the windows of every span; windows are encoded in bounded blocks."""
    windows = ((k, p, e) for k, (s, e) in enumerate(spans) for p in places(s, e))
    best = np.zeros(len(spans))
    while part := list(islice(windows, 256)):
        np.maximum.at(best, [k for k, _, _ in part], probability(w, np.array([encode(text, p, e) for _, p, e in part])))
    return best


def scan(text: str, w: dict[str, np.ndarray]) -> tuple[list, list]:
    """Base findings, and all findings: (start, kind, end), ordered by start, then kind."""
    base = base_findings(text)
    others = other_candidates(text, base)
    if others:
        p = judge(text, others, w)
        return base, sorted(base + [(s, 3, e) for (s, e), x in zip(others, p) if x >= w["threshold"]])
    return base, base


def _line(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{[*KINDS, MODEL_KIND][k]}:{s}:{e}" for s, k, e in found)


def redact(text: str, found: list[tuple[int, int, int]], mark: str) -> str:
    """``text`` with every found stretch (overlaps joined) replaced by ``mark``."""
    out, at, end = [], 0, -1
    for s, _, e in found:
        if s >= end:
            out += [text[at:s], mark]
        at = end = max(e, end)
    return "".join([*out, text[at:]])


def scan_secrets(docs: DataFrame, net: Net = Net(), text: str = "text", mark: str | None = None) -> DataFrame:
    """``docs`` with n_assign, n_access, n_hex, base_spans and spans (kind:start:end, comma-joined).

    With ``mark`` the text is replaced by one in which every span is that string.
    """
    weights = train(net)
    made = ["n_assign", "n_access", "n_hex", "base_spans", "spans"]
    docs = docs.drop(*[c for c in made if c in docs.columns])
    names = [*docs.columns, *made]
    at = names.index(text)
    schema = T.StructType([*docs.schema.fields, *[T.StructField(c, T.LongType()) for c in made[:3]],
                           *[T.StructField(c, T.StringType()) for c in made[3:]]])

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            results = [scan(t or "", weights) for t in texts]
            columns = list(batch.columns)
            if mark is not None:
                columns[at] = pa.array([redact(t, r[1], mark) if r[1] else t for t, r in zip(texts, results)], batch.schema.field(at).type)
            counts = [pa.array([sum(f[1] == k for f in r[0]) for r in results], pa.int64()) for k in range(3)]
            yield pa.RecordBatch.from_arrays(
                [*columns, *counts, pa.array([_line(r[0]) for r in results], pa.string()), pa.array([_line(r[1]) for r in results], pa.string())],
                names=names)

    return docs.mapInArrow(work, schema)
