"""Compression, hard negatives and neighbours: SQL twins, brute force on odd rows, bounds."""

import math

import numpy as np
import pytest
from compare import connect, difference
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlens.llm import codebooks, negatives, neighbours, vectorblocks
from flowlens.llm.vector_queries import VECTORS

SCHEMA = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
    T.StructField("label", T.IntegerType()), T.StructField("block", T.StringType()), T.StructField("id", T.StringType()),
    T.StructField("rank", T.StringType())])


@pytest.mark.parametrize("name", sorted(VECTORS.queries))
def test_matches_sql(spark, sf, name):
    assert difference(VECTORS.queries[name](spark, sf), connect(sf), VECTORS.sql[name]) is None


def made(n=700, dim=12, seed=5):
    """Clustered vectors, a third of them one and the same, repeated rows, ties, and rows that take no part."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dim))
    rows = []
    for i in range(n):
        v = centres[i % 6] + rng.normal(scale=0.3, size=dim) if i % 3 else centres[0]
        rows.append((i, v.astype(np.float32).tolist(), int(rng.integers(4))))
    rows += [rows[5], rows[100], (-100, [-1.5] * dim, 2), (900, [1e-30] * dim, 1), (1000, [0.0] * dim, 0), (1001, [4096.0] * dim, 0)]
    odd = [(2000, None, 1), (2100, [], 1), (2200, [1.0, None] * (dim // 2), 1), (2300, [math.nan] * dim, 1),
           (2400, [math.inf] * dim, 1), (None, [1.0] * dim, 1), (2500, [1.0] * dim, None), (2600, [1.0] * 4, 1)]
    return rows, odd


def frame(spark, rows):
    """With columns whose names clash with those used inside."""
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def rows(spark):
    usual, odd = made()
    return usual, odd, frame(spark, usual + odd)


def test_neighbours_against_brute_force(rows):
    usual, odd, df = rows
    kept = [(i, np.array(v, np.float32).astype(np.float64)) for i, v, _ in usual + [odd[6], odd[7]] if any(v)]
    want = []
    for q in sorted({i for i, _ in kept if i % 100 == 0}):
        mine = min(tuple(v) for i, v in kept if i == q)
        near = sorted((math.sqrt(sum((a - b) * (a - b) for a, b in zip(mine, v))), i)
                      for i, v in kept if i != q and len(v) == len(mine))[:10]
        want += [(q, n + 1, i, s) for n, (s, i) in enumerate(near)]
    got = neighbours.nearest(df, df.filter("vec_id % 100 = 0"))
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == want


def test_neighbours_of_many_blocks(rows, monkeypatch):
    _, _, df = rows
    queries = df.filter("vec_id % 50 = 0")
    want = sorted(map(tuple, neighbours.nearest(df, queries).collect()))
    for name, value in (("QUERY_ROWS", 3), ("CANDIDATE_ROWS", 40), ("CHUNK", 2), ("PAIRS", 7), ("OPEN", 1), ("EXACT_TERMS", 5)):
        monkeypatch.setattr(neighbours, name, value)
    assert sorted(map(tuple, neighbours.nearest(df, queries).collect())) == want


def test_distance_bounds_hold():
    rng = np.random.default_rng(1)
    x = (rng.normal(size=(200, 9)) * 10.0 ** rng.integers(-6, 6, size=(200, 1))).astype(np.float64)
    q = neighbours.quantise(x)
    back = q["codes"] * q["scale"][:, None]
    assert (np.linalg.norm(x - back, axis=1) <= q["lost"] * (1 + 1e-9)).all()


def brute_negatives(rows, every=100):
    ints = [(i, np.floor(256 * np.array(v, np.float32).astype(np.float64)).astype(np.int64), l) for i, v, l in rows]
    want = []
    for a in sorted({i for i, _, _ in ints if i % every == 0}):
        _, vector, label = min(((tuple(float(x) for x in r[1]), r[2], r) for r in rows if r[0] == a), key=lambda t: t[:2])[2][0:3]
        vector = np.floor(256 * np.array(vector, np.float32).astype(np.float64)).astype(np.int64)
        scored = sorted(((-int(vector @ v), i, l) for i, v, l in ints if i != a and len(v) == len(vector)), key=lambda t: t[:2])
        for s, i, l in [x for x in scored if x[2] == label][:5]:
            found = [x for x in scored if x[2] != label and 80 * -s <= 100 * -x[0] <= 100 * -s][:5]
            want += [(a, i, n + 1, j, -s, -t) for n, (t, j, _) in enumerate(found)]
    return sorted(want)


def test_negatives_against_brute_force(rows, monkeypatch):
    usual, odd, df = rows
    anchors = df.filter("vec_id % 100 = 0")
    want = brute_negatives(usual + [odd[7]])
    assert len(want) > 50
    assert sorted(map(tuple, negatives.hard_negatives(df, anchors).collect())) == want
    for name, value in (("ANCHOR_ROWS", 2), ("CANDIDATE_ROWS", 50), ("PAGE", 4), ("REFERENCES", 3), ("CHUNK", 1), ("OPEN", 1)):
        monkeypatch.setattr(negatives, name, value)
    assert sorted(map(tuple, negatives.hard_negatives(df, anchors).collect())) == want


def test_score_bounds_hold_and_leave_pages_out():
    rng = np.random.default_rng(2)
    v = np.concatenate([rng.normal(c, 20, size=(60, 16)) for c in (-300, 300)]).astype(np.int64)
    v[7] = 0
    a = {"id": np.arange(120), "label": np.repeat([0, 1], 60), "vector": v / 256}
    block = negatives._candidate_block(5, 256)(a)
    units, size = negatives.directions(v), negatives.lengths(v)
    n = len(block["page_start"])
    low, high = negatives.score_bounds(units, size, block["references"], *(block[c].reshape(n, -1) for c in ("least_angle", "most_angle")),
                                       block["least_length"], block["most_length"])
    ends = np.append(block["page_start"][1:], 120)
    for page, (s, e) in enumerate(zip(block["page_start"], ends)):
        exact = v @ block["vector"][s:e].astype(np.int64).T
        assert (low[:, page, None] <= exact).all() and (exact <= high[:, page, None]).all()
    assert (high < 0).any()  # whole pages are known to be far


def brute_codes(rows, parts=4, entries=256, rounds=4):
    rows = sorted(rows, key=lambda r: (r[0], [np.float32(x) for x in r[1]]))
    v = np.floor(1024 * np.array([r[1] for r in rows], np.float32).astype(np.float64)).astype(np.int64)
    w = v.shape[1] // parts
    cut = [v[:, p * w:(p + 1) * w] for p in range(parts)]
    books = [c[:entries].copy() for c in cut]
    near = lambda x, b: np.square(x[:, None, :] - b).sum(axis=2)
    for _ in range(rounds):
        for p in range(parts):
            at = near(cut[p], books[p]).argmin(axis=1)
            for e in np.unique(at):
                books[p][e] = cut[p][at == e].sum(axis=0) // (at == e).sum()
    codes = [near(cut[p], books[p]).argmin(axis=1) for p in range(parts)]
    error = sum(near(cut[p], books[p]).min(axis=1) for p in range(parts))
    by_label: dict = {}
    for r, e in zip(rows, error.tolist()):
        by_label[r[2]] = by_label.get(r[2], 0) + e
    return [(r[0], "".join(f"{c[i]:02x}" for c in codes), int(error[i]), by_label[r[2]]) for i, r in enumerate(rows)], codebooks.digest(books)


def test_codes_against_brute_force(spark, rows, monkeypatch):
    usual, odd, df = rows
    kept, sha = brute_codes(usual + [odd[6]])
    for size in (codebooks.BLOCK_ROWS, 64):
        monkeypatch.setattr(codebooks, "BLOCK_ROWS", size)
        got = codebooks.compress(df).collect()
        assert sorted((r.vec_id, r.code, r.error, r.label_error) for r in got) == sorted(kept)
        assert {r.codebooks_sha256 for r in got} == {sha}
    few = usual[:20]
    kept, sha = brute_codes(few)
    got = codebooks.compress(frame(spark, few)).collect()
    assert sorted((r.vec_id, r.code, r.error, r.label_error) for r in got) == sorted(kept) and got[0].codebooks_sha256 == sha


def test_trees_assign_whole_subtrees():
    rng = np.random.default_rng(3)
    points = np.concatenate([rng.normal(c, 5, size=(200, 4)) for c in (0, 1000, 5000)]).astype(np.int64)
    tree = codebooks.CoverTree(codebooks.build_tree(points))
    assert sorted(tree.order.tolist()) == list(range(600))
    for node in range(len(tree.start)):
        mine = points[tree.order[tree.start[node]: tree.end[node]]]
        assert np.sqrt(np.square(mine - points[tree.centre[node]]).sum(axis=1)).max() <= tree.radius[node] + 1e-9
    entries = np.array([[0] * 4, [1000] * 4, [5000] * 4])
    ranges = list(codebooks.assign(points, tree, entries))
    assert sum(len(e) for e, _, _ in ranges) < 30  # three clusters need few nodes
    sums, counts = codebooks.sums_by_entry(points, tree, entries)
    assert counts.tolist() == [200, 200, 200] and (sums[1] == points[200:400].sum(axis=0)).all()


def test_large_components_are_exact():
    x = np.array([[1 << 25, -(1 << 25), 3], [0, 1, 2]])
    assert codebooks.squares(x, x).tolist() == [[0, (1 << 25) ** 2 + ((1 << 25) + 1) ** 2 + 1], [(1 << 25) ** 2 + ((1 << 25) + 1) ** 2 + 1, 0]]
    assert negatives.scores(x, x).tolist() == (x @ x.T).tolist()


def test_empty_tables(spark):
    none = frame(spark, [(1, None, 1)])
    for df in (none, none.limit(0)):
        assert neighbours.nearest(df, df).collect() == [] and negatives.hard_negatives(df, df).collect() == []
        assert codebooks.compress(df).collect() == []
    one = frame(spark, [(100, [1.0] * 8, 1)])
    assert neighbours.nearest(one, one).collect() == [] and negatives.hard_negatives(one, one).collect() == []
    assert [(r.code, r.error) for r in codebooks.compress(one).collect()] == [("00000000", 0)]


def test_double_vectors_keep_their_digits(spark):
    df = spark.createDataFrame([(0, [1.0, 1e-12]), (1, [1.0, 2e-12]), (2, [1.0, 3e-12])], "vec_id long, embedding array<double>")
    got = neighbours.nearest(df, df.filter("vec_id = 0")).collect()
    assert [(r.vec_id, r.score) for r in got] == [(1, 2e-12 - 1e-12), (2, 3e-12 - 1e-12)]
    assert df.filter(vectorblocks.usable()).count() == 3 and df.filter(F.size("embedding") == 2).count() == 3
