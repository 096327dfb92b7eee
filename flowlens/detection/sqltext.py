"""A fitted detector as SQL text: the same classes and probabilities from any engine that knows CASE.

Every tree is a nested CASE whose conditions are ``column <= number`` or ``column IN (categories)``; a missing value meets no condition and goes right, as
in the model.  Category columns become the numbers the model's indexers gave them, an unseen one the number behind the
last.  A forest's leaf is a list of class shares, a boosted tree's leaf a number.  The text grows with the number of nodes, so
it suits forests and small boosted models; ``score_sql`` refuses more than ``MOST_NODES`` splits.

A select over rows with the detector's input columns gives ``attack_probability`` (two stages), the class the second stage
would name, and the class of both, like ``Detector.score``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.feature import StringIndexerModel, VectorAssembler
from pyspark.sql import SparkSession

from flowlens.detection.boosting import SoftmaxBoosterModel
from flowlens.detection.detector import Detector
from flowlens.runtime import scratch_path
from flowlens.schema import NORMAL

MOST_NODES = 20_000


@dataclass(frozen=True)
class Node:
    """A split (feature, cut or the categories that go left, left, right) or a leaf (value)."""

    feature: int = -1
    cut: float = 0.0
    categories: tuple[float, ...] | None = None
    left: int = -1
    right: int = -1
    value: tuple[float, ...] = ()


Trees = list[dict[int, Node]]


def number(x: float) -> str:
    """A double as SQL text that reads back as the same double."""
    if np.isinf(x):
        return f"CAST('{'' if x > 0 else '-'}Infinity' AS DOUBLE)"
    return f"CAST('{x!r}' AS DOUBLE)"


def text(value: str) -> str:
    """A string as SQL text; backslashes and quotes mean different things to different engines, so they are made from codes."""
    parts = ["chr(92)" if p == "\\" else "chr(39)" if p == "'" else f"'{p}'" for p in re.split(r"([\\'])", value) if p]
    return parts[0] if len(parts) == 1 else f"concat({', '.join(parts)})" if parts else "''"


def name(column: str) -> str:
    return column if column.replace("_", "a").isalnum() else f'"{column}"'


def feature_columns(detector: Detector) -> list[str]:
    """An SQL expression for every place of the feature vector."""
    indexers: dict[str, tuple[str, list[str]]] = {}
    for stage in detector.pipeline.stages:
        if isinstance(stage, StringIndexerModel) and stage.isSet("inputCols"):
            for made, own, labels in zip(stage.getOutputCols(), stage.getInputCols(), stage.labelsArray):
                indexers[made] = own, list(labels)
    assembler = next(s for s in detector.pipeline.stages if isinstance(s, VectorAssembler))
    found = []
    for column in assembler.getInputCols():
        if column in indexers:
            own, labels = indexers[column]
            cases = " ".join(f"WHEN {text(v)} THEN {i}" for i, v in enumerate(labels))
            found.append(f"CASE {name(own)} {cases} ELSE {len(labels)} END" if labels else "0")
        else:
            found.append(f"CAST({name(column)} AS DOUBLE)")
    return found


def forest_trees(spark: SparkSession, model: RandomForestClassificationModel) -> Trees:
    """The trees of a forest, read from its saved form; a leaf holds the shares of the classes."""
    path = scratch_path(spark, "forest")
    model.write().overwrite().save(path)
    trees: dict[int, dict[int, Node]] = {}
    # as many rows as the model has nodes
    for r in spark.read.parquet(f"{path}/data").collect():
        n = r["nodeData"]
        split = n["split"]
        if n["leftChild"] >= 0:
            left = split["leftCategoriesOrThreshold"]
            ordered = split["numCategories"] == -1
            node = Node(split["featureIndex"], float(left[0]) if ordered else 0.0, None if ordered else tuple(left),
                        n["leftChild"], n["rightChild"])
        else:
            total = sum(n["impurityStats"])
            node = Node(value=tuple(x / total if total else 0.0 for x in n["impurityStats"]))
        trees.setdefault(r["treeID"], {})[n["id"]] = node
    return [trees[t] for t in sorted(trees)]


def booster_trees(model: SoftmaxBoosterModel) -> list[tuple[int, dict[int, Node]]]:
    """(class, tree) in the order of the rounds."""
    found = []
    for _, t in model.nodes.sort_values(["tree", "node"]).groupby("tree", sort=True):
        nodes = {int(r.node): Node(int(r.feature), float(r.cut), None, int(r.left), int(r.right)) if r.feature >= 0
                 else Node(value=(float(r.value),)) for r in t.itertuples()}
        found.append((int(t["klass"].iloc[0]), nodes))
    return found


def tree_sql(tree: dict[int, Node], leaf, at: int = 0) -> str:
    node = tree[at]
    if node.feature < 0:
        return leaf(node.value)
    goes_left = f"<= {number(node.cut)}" if node.categories is None else f"IN ({', '.join(f'{c:.0f}' for c in sorted(node.categories))})"
    return (f"CASE WHEN f{node.feature} {goes_left} THEN {tree_sql(tree, leaf, node.left)}"
            f" ELSE {tree_sql(tree, leaf, node.right)} END")


def _splits(trees: Trees) -> int:
    return sum(n.feature >= 0 for t in trees for n in t.values())


@dataclass(frozen=True)
class Stage:
    """Columns to compute from the features, one step after the other, and the list of probabilities they end in."""

    steps: list[list[str]]
    probability: list[str]
    splits: int


def stage_sql(spark: SparkSession, model, prefix: str) -> Stage:
    if isinstance(model, SoftmaxBoosterModel):
        pairs = booster_trees(model)
        margin = [" + ".join(["CAST('0.0' AS DOUBLE)"] + [tree_sql(t, lambda v: number(v[0])) for k, t in pairs if k == m])
                  for m in range(model.margins)]
        first = [f"{sql} AS {prefix}m{m}" for m, sql in enumerate(margin)]
        if model.margins == 1:
            return Stage([first, [f"1 / (1 + exp(-{prefix}m0)) AS {prefix}p1"], [f"1 - {prefix}p1 AS {prefix}p0"]],
                         [f"{prefix}p0", f"{prefix}p1"], _splits([t for _, t in pairs]))
        top = f"greatest({', '.join(f'{prefix}m{m}' for m in range(model.margins))})"
        exps = [f"exp({prefix}m{m} - {prefix}top) AS {prefix}e{m}" for m in range(model.margins)]
        total = " + ".join(f"{prefix}e{m}" for m in range(model.margins))
        return Stage([first, [f"{top} AS {prefix}top"], exps, [f"{total} AS {prefix}sum"],
                      [f"{prefix}e{m} / {prefix}sum AS {prefix}p{m}" for m in range(model.margins)]],
                     [f"{prefix}p{m}" for m in range(model.margins)], _splits([t for _, t in pairs]))
    if not isinstance(model, RandomForestClassificationModel):
        raise ValueError(f"{type(model).__name__} cannot be written as SQL")
    trees = forest_trees(spark, model)
    # the leaf's number first, so that a tree's conditions are written once and not once per class
    steps: list[list[str]] = [[], []]
    classes = model.numClasses
    terms: list[list[str]] = [[] for _ in range(classes)]
    for i, tree in enumerate(trees):
        leaves = [n.value for n in tree.values() if n.feature < 0]
        places = {v: j for j, v in enumerate(dict.fromkeys(leaves))}
        steps[0].append(f"{tree_sql(tree, lambda v: str(places[v]))} AS {prefix}t{i}")
        for c in range(classes):
            cases = " ".join(f"WHEN {j} THEN {number(v[c])}" for v, j in places.items() if v[c])
            terms[c].append(f"CASE {prefix}t{i} {cases} ELSE CAST('0.0' AS DOUBLE) END" if cases else "CAST('0.0' AS DOUBLE)")
    steps[1] = [f"({' + '.join(t)}) / {len(trees)} AS {prefix}p{c}" for c, t in enumerate(terms)]
    return Stage(steps, [f"{prefix}p{c}" for c in range(classes)], _splits(trees))


def score_sql(detector: Detector, spark: SparkSession, source: str, keep: list[str]) -> str:
    """A SELECT over ``source`` (a table or a query in brackets): ``keep`` columns and the scores."""
    models = {s.getPredictionCol(): s for s in detector.pipeline.stages if s.hasParam("probabilityCol") and s.hasParam("predictionCol")}
    if not set(models) <= {"pred_stage1", "pred_stage2"} or "pred_stage2" not in models:
        raise ValueError("only detectors with one model per stage can be written as SQL")
    stages = [stage_sql(spark, models[c], f"s{c[-1]}_") for c in sorted(models)]
    if (total := sum(s.splits for s in stages)) > MOST_NODES:
        raise ValueError(f"{total} splits are too many for one statement")
    columns = [f"{sql} AS f{i}" for i, sql in enumerate(feature_columns(detector))]
    query = f"SELECT {', '.join([*map(name, keep), *columns])} FROM {source}"
    for stage in stages:
        for step in stage.steps:
            query = f"SELECT *, {', '.join(step)} FROM ({query})"
    p2 = stages[-1].probability
    best = f"greatest({', '.join(p2)})"
    classes = detector.classes
    # the first of equal probabilities; a class beyond the labels cannot be named
    named = " ".join(f"WHEN {c} = s2_best THEN {text(classes[i])}" for i, c in enumerate(p2) if i < len(classes))
    query = f"SELECT *, {best} AS s2_best FROM ({query})"
    query = f"SELECT *, CASE {named} END AS stage2_class FROM ({query})"
    kept = ", ".join(map(name, keep))
    if not detector.two_stages:
        return f"SELECT {kept}, stage2_class AS predicted_class FROM ({query})"
    p1 = stages[0].probability[1]
    return (f"SELECT {kept}, {p1} AS attack_probability, stage2_class,"
            f" CASE WHEN {p1} >= 0.5 THEN stage2_class ELSE {text(NORMAL)} END AS predicted_class FROM ({query})")
