"""Near-duplicates against all pairs of full sets."""

import random
import re

import numpy as np
import pytest

from flowlens.llm import neardup as nd
from flowlens.llm.arrowtext import texts_of
from flowlens.llm.components import connected_components
from flowlens.llm.queries import LLM

WORD = re.compile("[^\x20\x09-\x0D]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def shingles(text):
    w = WORD.findall((text or "").translate(UPPER))
    return {tuple(w[i: i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows, percent=85):
    """(doc_id, text) rows -> {doc_id: (n, component)}."""
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    where = {}
    for i in sorted(sets):
        for h in sets[i]:
            where.setdefault(h, []).append(i)
    pairs = {(a, b) for ids in where.values() for k, b in enumerate(ids) for a in ids[:k]}
    for a, b in pairs:
        n = len(sets[a] & sets[b])
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {i: (len(sets[i]), root(i)) for i in sets}


def got(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_query_against_all_pairs(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    out = LLM.queries["op3_near_dedup"](spark, sf)
    assert got(out) == brute(rows)
    assert out.filter("kept <> (doc_id = component_id)").count() == 0


def near_copies(seed, n, words=90):
    """A chain of slightly edited texts with similarities on both sides of the threshold."""
    rng = random.Random(seed)
    base = [f"w{rng.randint(0, 5000)}" for _ in range(words)]
    out = []
    for _ in range(n):
        if rng.random() < 0.2:
            base = base[:]
            base[rng.randrange(words)] = f"n{rng.randint(0, 10**6)}"
        text = base[:]
        for _ in range(rng.randint(0, 4)):
            text[rng.randrange(words)] = f"x{rng.randint(0, 10**6)}"
        out.append(" ".join(text))
    return out


@pytest.mark.parametrize("block", [1000, 7])
def test_many_near_copies(spark, monkeypatch, block):
    monkeypatch.setattr(nd, "BLOCK_ROWS", block)
    texts = near_copies(1, 90) + near_copies(2, 40, 30) + ["same words here"] * 5 + ["Same  WORDS\there"] + [None, "", " \n", "one"]
    rows = list(enumerate(texts))
    random.Random(4).shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = brute(rows)
    assert got(nd.near_duplicates(df)) == want and len({c for _, c in want.values()}) > 20


def test_edge_rows(spark):
    schema = "doc_id long, text string, component string, kept string, block int"
    rows = [(None, "a b c d e f", "", "", 1), (None, None, "", "", 1), (5, "a b c d e f", "", "", 1), (5, "a b c d e f", "", "", 1),
            (7, "A B C D E F", "", "", 1), (9, "x " * 100_000, "", "", 1)]
    out = nd.near_duplicates(spark.createDataFrame(rows, schema))
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0, r.kept) for r in out.collect()) == [
        (0, 0, 0, True), (0, 2, 0, True), (5, 2, 5, True), (5, 2, 5, True), (7, 2, 5, False), (9, 1, 9, True)]
    assert nd.near_duplicates(spark.createDataFrame([], schema)).count() == 0


def test_sketch_fills_and_estimates():
    texts = near_copies(3, 30, 400) + ["a", "a b", ""]
    sets = nd.shingle_sets(texts_of(__import__("pyarrow").array(texts)), 5)
    sketch = nd.fast_sketch(sets, 256)
    assert (sketch[:-1] != nd.FULL).all() and (sketch[-1] == nd.FULL).all()
    parts = [set(sets.values[a:b].tolist()) for a, b in zip(sets.first, sets.first[1:])]
    errors = [np.mean(sketch[i] == sketch[j]) - len(parts[i] & parts[j]) / len(parts[i] | parts[j]) for i in range(30) for j in range(i)]
    assert abs(np.mean(errors)) < 0.02 and np.max(np.abs(errors)) < 0.15


def test_components(spark):
    rng = random.Random(8)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(150)] + [(i, i + 1) for i in range(1000, 1200)] + [(2000, i) for i in range(2001, 2300)]
    found = {r.vertex: r.component for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    parent = {v: v for e in edges for v in e}
    for _ in range(300):
        for a, b in edges:
            parent[a] = parent[b] = min(parent[a], parent[b])
    assert found == {v: c for v, c in parent.items() if v in found} and set(found) == {v for a, b in edges if a != b for v in (a, b)}
