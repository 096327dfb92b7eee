"""Graph operators on small graphs, also with every vertex treated as a hub."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from flowlens.operators import graph


def edges_of(spark, pairs):
    return spark.createDataFrame([tuple(p) for p in pairs], "src string, dst string")


def components(pairs):
    """Brute force: least vertex reachable without direction."""
    around = {}
    for a, b in pairs:
        around.setdefault(a, set()).add(b)
        around.setdefault(b, set()).add(a)
    out = {}
    for v in around:
        seen, todo = {v}, [v]
        while todo:
            for n in around[todo.pop()] - seen:
                seen.add(n)
                todo.append(n)
        out[v] = min(seen)
    return out


CHAIN = [(f"v{i}", f"v{i + 1}") for i in range(9)]
CASES = {
    "chain": CHAIN,
    "loop and copies": [("a", "a"), ("b", "c"), ("b", "c"), ("c", "b")],
    "two parts": [("a", "b"), ("c", "d"), ("d", "e")],
    "hub": [("hub", f"x{i}") for i in range(40)] + [("y", "x3"), ("p", "q")],
    "ring": [(f"r{i}", f"r{(i + 1) % 12}") for i in range(12)],
}


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("rows_per_split", [1_000_000, 2])
def test_components(spark, name, rows_per_split):
    got = graph.connected_components(edges_of(spark, CASES[name]), rows_per_split=rows_per_split).collect()
    assert len(got) == len({r.id for r in got})
    assert {r.id: r.component for r in got} == components(CASES[name])


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 25), st.integers(0, 25)), min_size=1, max_size=25))
def test_components_of_random_graphs(spark, pairs):
    named = [(f"{a:02d}", f"{b:02d}") for a, b in pairs]
    got = graph.connected_components(edges_of(spark, named)).collect()
    assert {r.id: r.component for r in got} == components(named)


@pytest.mark.parametrize("rows_per_split", [1_000_000, 3])
def test_paths(spark, rows_per_split):
    pairs = CHAIN + [("v0", "v5"), ("z", "v1"), ("v4", "v4")]
    got = {r.id: (r.distance, r.via) for r in
           graph.shortest_paths(edges_of(spark, pairs), "v0", rows_per_split=rows_per_split).collect()}
    assert got["v0"] == (0, None) and got["v5"] == (1, "v0") and got["v9"] == (5, "v8") and "z" not in got
    both = {r.id: r.distance for r in
            graph.shortest_paths(edges_of(spark, pairs), "v0", directed=False, rows_per_split=rows_per_split).collect()}
    assert both["z"] == 2 and both["v4"] == 2
    near = graph.shortest_paths(edges_of(spark, pairs), "v0", max_depth=1)
    assert {r.id for r in near.collect()} == {"v0", "v1", "v5"}


def test_paths_have_no_hop_limit(spark):
    far = graph.shortest_paths(edges_of(spark, [(f"n{i:02}", f"n{i + 1:02}") for i in range(30)]), "n00")
    assert {r.id: r.distance for r in far.collect()} == {f"n{i:02}": i for i in range(31)}


def test_hub_join_equals_plain_join(spark):
    rows = spark.createDataFrame([("h", i) for i in range(50)] + [("x", 1), ("none", 2)], "k string, v int")
    table = spark.createDataFrame([("h", 50, "hot"), ("x", 1, "cold"), ("unused", 7, "")], "k string, n long, t string")
    joined = graph.join_on_hubs(rows, table, "k", "n", rows_per_split=4)
    assert sorted(tuple(r) for r in joined.select("k", "v", "t").collect()) == sorted(
        tuple(r) for r in rows.join(table, "k").select("k", "v", "t").collect())


def test_size_degrees_and_missing_ends(spark):
    flows = spark.createDataFrame([("a", "b", 1), ("a", "b", 0), ("a", None, 1), ("b", "b", 0)],
                                  "srcip string, dstip string, label int")
    assert tuple(graph.graph_size(flows).first()) == (2, 3)
    got = {r.id: (r.out_degree, r.in_degree, r.degree) for r in graph.degrees(graph.graph_edges(flows)).collect()}
    assert got == {"a": (2, 0, 2), "b": (1, 3, 4)}


@pytest.mark.parametrize("name", CASES)
def test_components_over_many_ranges(spark, name):
    """Every range of names holds about three pairs, so most components reach over several stars."""
    got = graph.connected_components(edges_of(spark, CASES[name]), rows_per_split=4, rows_per_task=3).collect()
    assert len(got) == len({r.id for r in got})
    assert {r.id: r.component for r in got} == components(CASES[name])


def test_components_inside_a_range_need_no_rounds(spark):
    chains = [(f"{day}/n{i:02}", f"{day}/n{i + 1:02}") for day in "abc" for i in range(30)]
    got = graph.connected_components(edges_of(spark, chains), max_rounds=0).collect()
    assert {r.id: r.component for r in got} == components(chains)
