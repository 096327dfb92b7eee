"""A batch of edges leaves its vertices and links behind and nothing else."""

from flowlens.operators import growing_graph
from flowlens.runtime import path_names, scratch_home, scratch_path


def test_tables_of_a_batch_are_deleted(spark):
    path, home = scratch_path(spark, "graph-under-test"), scratch_home(spark)
    before = set(path_names(spark, home))
    batches = [[("b", "c"), ("e", "f"), (None, "x"), ("e", "f")], [("a", "c"), ("g", "g"), ("h", "i")], [("c", "f"), ("i", "j"), ("b", "a")]]
    wanted = [{"b": "b", "c": "b", "e": "e", "f": "e"},
              {"a": "a", "b": "a", "c": "a", "e": "e", "f": "e", "g": "g", "h": "h", "i": "h"},
              {"a": "a", "b": "a", "c": "a", "e": "a", "f": "a", "g": "g", "h": "h", "i": "h", "j": "h"}]
    for i, (batch, want) in enumerate(zip(batches, wanted), 1):
        assert growing_graph.add_edges(spark.createDataFrame(batch, "src string, dst string"), path) == i
        left = set(path_names(spark, home)) - before
        scopes = {n for n in left if n.startswith("scope-")}
        assert left - scopes == {path.rsplit("/", 1)[1]} and not any(path_names(spark, f"{home}/{s}") for s in scopes)
        rows = growing_graph.components(spark, path).collect()
        assert len(rows) == len(want) and {r.id: r.component for r in rows} == want
