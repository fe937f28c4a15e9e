"""Tree ensembles as node tables: partial dependence by walking each row through the trees once."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassificationModel, RandomForestClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lossloom.session import scratch_path

# Nodes that are sent to the tasks, about 60 bytes each.
NODE_LIMIT = 1_000_000


@dataclass
class Tree:
    """Arrays by node number: split component (-1 for a leaf), threshold, children, leaf value; sets of left categories."""

    weight: float
    component: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    categories: dict[int, np.ndarray]

    def depth(self) -> int:
        level, at = 0, [0]
        while at := [c for n in at if self.component[n] >= 0 for c in (self.left[n], self.right[n])]:
            level += 1
        return level


def node_tables(spark, model) -> list[Tree] | None:
    """Trees of a binary boosted or forest model from its saved node table; None for other models and beyond NODE_LIMIT nodes."""
    boosted = isinstance(model, GBTClassificationModel)
    if not boosted and not (isinstance(model, RandomForestClassificationModel) and model.numClasses == 2):
        return None
    if model.totalNumNodes > NODE_LIMIT:
        return None
    path = scratch_path(spark, "trees")
    model.write().save(path)
    rows = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").orderBy("treeID", "id").collect()
    trees: dict[int, list] = {}
    for r in rows:
        trees.setdefault(r["treeID"], []).append(r)
    found = []
    for number, nodes in sorted(trees.items()):
        inner = [r["leftChild"] >= 0 for r in nodes]
        shares = [r["prediction"] if boosted else r["impurityStats"][1] / max(sum(r["impurityStats"]), 1e-300) for r in nodes]
        split = [r["split"] for r in nodes]
        found.append(Tree(
            float(model.treeWeights[number]),
            np.array([s["featureIndex"] if i else -1 for i, s in zip(inner, split)]),
            np.array([s["leftCategoriesOrThreshold"][0] if i and s["numCategories"] < 0 else np.inf for i, s in zip(inner, split)]),
            np.array([r["leftChild"] for r in nodes]), np.array([r["rightChild"] for r in nodes]), np.array(shares),
            {k: np.array(s["leftCategoriesOrThreshold"]) for k, (i, s) in enumerate(zip(inner, split)) if i and s["numCategories"] >= 0}))
    return found


def leaves(tree: Tree, depth: int, rows: np.ndarray, place: dict[int, int], fixed: int = -1, interval: int = 0,
           cuts: np.ndarray | None = None) -> np.ndarray:
    """Leaf value of each row. At splits of the component `fixed` all rows go as a value in the given interval between its cuts goes."""
    at = np.zeros(len(rows), np.int64)
    columns = np.array([place.get(c, 0) for c in tree.component.tolist()])
    every = np.arange(len(rows))
    for _ in range(depth):
        component = tree.component[at]
        go_left = rows[every, columns[at]] <= tree.threshold[at]
        for node, chosen in tree.categories.items():
            here = at == node
            go_left[here] = np.isin(rows[here, columns[node]], chosen)
        if cuts is not None:
            here = component == fixed
            go_left[here] = np.searchsorted(cuts, tree.threshold[at[here]]) >= interval
        at = np.where(component < 0, at, np.where(go_left, tree.left[at], tree.right[at]))
    return tree.value[at]


def walked_dependence(encoded: DataFrame, features: str, model, component: int, grid: Sequence[float]) -> DataFrame | None:
    """(value, mean_probability) over the grid; None if the model has no node table.

    A tree that does not split on the component gives a row one value for the whole grid, another one as many as it has intervals there. So
    a row is walked once a tree, not once a tree and grid point, and nothing is exploded; tasks return sums.
    """
    spark = encoded.sparkSession
    trees = node_tables(spark, model)
    if trees is None:
        return None
    boosted = isinstance(model, GBTClassificationModel)
    used = sorted({int(c) for t in trees for c in t.component if c >= 0}) or [component]
    place = {c: k for k, c in enumerate(used)}
    points = np.array(grid, np.float64)
    depths = [t.depth() for t in trees]
    total = sum(t.weight for t in trees)

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums, count = np.zeros(len(points)), 0
        for batch in batches:
            if not len(batch):
                continue
            rows = np.array(batch["x"].tolist(), np.float64)
            same, margin = np.zeros(len(rows)), np.zeros((len(rows), len(points)))
            for tree, depth in zip(trees, depths):
                cuts = np.unique(tree.threshold[tree.component == component])
                if not len(cuts):
                    same += tree.weight * leaves(tree, depth, rows, place)
                    continue
                interval = np.searchsorted(cuts, points)
                for k in np.unique(interval):
                    margin[:, interval == k] += (tree.weight * leaves(tree, depth, rows, place, component, int(k), cuts))[:, None]
            margin += same[:, None]
            sums += (1 / (1 + np.exp(-2 * margin)) if boosted else margin / total).sum(0)
            count += len(rows)
        yield pd.DataFrame({"value": points, "total": sums, "n": count})

    array = vector_to_array(features)
    picked = encoded.select(F.array(*[array[c] for c in used]).alias("x"))
    parts = picked.mapInPandas(walk, "value double, total double, n long")
    return parts.groupBy("value").agg((F.sum("total") / F.sum("n")).alias("mean_probability"))
