"""Repeated byte strings against a plain set of all strings; suffix arrays against sorting."""

import hashlib
import random

import numpy as np
import pytest

from flowlens.llm import suffixdedup as s
from flowlens.llm.queries import LLM


def brute(rows, length=100):
    """Rows must come in the order of age."""
    seen, out = set(), []
    for doc, text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data) + 1, np.int64)
        for i in range(len(data) - length + 1):
            piece = data[i: i + length]
            if piece in seen:
                gone[i] += 1
                gone[i + length] -= 1
            seen.add(piece)
        mask = np.cumsum(gone)[:-1] > 0
        spans = int(np.sum(np.diff(np.concatenate([[0], mask.astype(int)])) == 1))
        kept = bytes(b for b, m in zip(data, mask) if not m)
        out.append((doc, len(data), int(mask.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()), key=str)


def test_query(spark, sf):
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    assert got(LLM.queries["op8_suffix_dedup"](spark, sf)) == brute(rows)


def planted(seed):
    rng = random.Random(seed)
    text = lambda n: "".join(rng.choice("abcdefgh é漢") for _ in range(n))
    passages = [text(rng.randint(70, 400)) for _ in range(4)]
    rows = []
    for i in range(80):
        t = text(rng.randint(0, 150))
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            cut = sorted((rng.randint(0, len(p)), rng.randint(0, len(p))))
            t += p[cut[0]: cut[1]] + text(rng.randint(0, 60))
        rows.append((i, t))
    return rows + [(100, "a" * 1500), (101, "ab" * 400), (102, "a" * 99), (103, "a" * 100), (104, "xyz" * 60), (105, ""), (106, None), (107, "q" * 101),
                   (108, rows[5][1]), (109, "0123456789" * 11), (110, "0123456789" * 11)]


@pytest.mark.parametrize(("shard", "unit", "bucket", "length"), [(4 << 20, 6 << 20, 64 << 20, 100), (900, 1500, 2000, 100), (3000, 700, 10**6, 37), (500, 400, 500, 64)])
def test_planted(spark, monkeypatch, shard, unit, bucket, length):
    monkeypatch.setattr(s, "SHARD_BYTES", shard)
    monkeypatch.setattr(s, "UNIT_BYTES", unit)
    monkeypatch.setattr(s, "BUCKET_BYTES", bucket)
    rows = planted(length)
    mixed = [(*r, "x") for r in rows]
    random.Random(2).shuffle(mixed)
    out = s.remove_repeats(spark.createDataFrame(mixed, "doc_id long, text string, ids string").repartition(3), length)
    assert got(out) == brute(rows, length)
    assert all(sum(x.end - x.start for x in r.removed) == r.n_removed and len(r.removed) == r.n_spans for r in out.collect())


def test_edge_rows(spark):
    text = "".join(chr(97 + i * i % 23) for i in range(300))
    out = s.remove_repeats(spark.createDataFrame([(1, text), (None, text), (1, text)], "doc_id long, text string"))
    assert sorted((r.doc_id or 0, r.n_removed) for r in out.collect() if r.n_removed == 300) == [(1, 300), (1, 300)]
    assert s.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_suffix_array_and_prefixes():
    rng = np.random.default_rng(5)
    data = rng.integers(97, 100, 3000).astype(np.uint8)
    data[1000:1400] = data[:400]
    data[2000:2200] = 97
    order, eight, head = s.suffix_array(data, 10_000)
    raw = data.tobytes()
    want = sorted(range(len(raw)), key=lambda i: raw[i:])
    assert order.tolist() == want
    begin = np.arange(0, 3000, 250)
    shared = s.common_prefixes(data, order, eight, head, begin, np.full(len(begin), 250), 100)
    part, _, ties = s.suffix_array(data, 100)
    short = s.common_prefixes(data, part, eight, ties, begin, np.full(len(begin), 250), 100)
    assert np.array_equal(np.cumsum(short[part] < 100)[np.argsort(part)], np.cumsum(shared[order] < 100)[np.argsort(order)])
    for a, b in zip(want, want[1:]):
        k = 0
        while k < 100 and max(a, b) + k < len(raw) and raw[a + k] == raw[b + k]:
            k += 1
        assert min(shared[b], 100) == k
