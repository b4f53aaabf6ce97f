"""What one fitted tree or boosted ensemble says about smaller ones, and rows walked through a table of nodes.

Spark grows a tree level by level, and boosting adds tree after tree. So the tree of a smaller depth is the deep tree cut
off at that depth, and an ensemble of fewer trees is the beginning of a longer one; neither needs a fit of its own.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import quoted
from millrace.operators.evaluate import roc_auc
from millrace.operators.models import node_rows

LEAF, ROWS = "leaf_", "rows_"


class Tree(NamedTuple):
    """Nodes in the order of their ids, parents first. ``left`` is -1 for leaves; ``stats`` are the rows per class."""

    left: np.ndarray
    right: np.ndarray
    depth: np.ndarray
    prediction: np.ndarray
    stats: np.ndarray

    @property
    def leaves(self) -> np.ndarray:
        """Ids of the leaves, in the order in which Spark numbers leaves."""
        return np.flatnonzero(self.left < 0)


def read_trees(model: Model) -> list[Tree]:
    """The nodes of a fitted tree, or of each tree of an ensemble: as large as the model, which the driver holds too."""
    by_tree: dict[int, list] = {}
    for r in node_rows(model).select("tree", "id", "prediction", "impurityStats", "leftChild", "rightChild").collect():
        by_tree.setdefault(r["tree"], []).append(r)
    out = []
    for _, rows in sorted(by_tree.items()):
        rows.sort(key=lambda r: r["id"])
        left, right = (np.array([r[c] for r in rows], np.int64) for c in ("leftChild", "rightChild"))
        depth = np.zeros(len(rows), np.int64)
        for i in np.flatnonzero(left >= 0):
            depth[[left[i], right[i]]] = depth[i] + 1
        out.append(Tree(left, right, depth, np.array([r["prediction"] for r in rows]), np.array([r["impurityStats"] for r in rows])))
    return out


# ---- trees of smaller depth ----------------------------------------------------------------------------


def cut_leaves(tree: Tree, depth: int) -> np.ndarray:
    """For each leaf of a classification tree, the node that is its leaf in the tree of a smaller depth.

    Below the depth nothing is left; above it, sister leaves of one class become one, as Spark joins them after a fit.
    """
    leaf = (tree.left < 0) | (tree.depth >= depth)
    for i in np.flatnonzero(~leaf)[::-1]:  # children have larger ids
        a, b = tree.left[i], tree.right[i]
        leaf[i] = leaf[a] and leaf[b] and tree.prediction[a] == tree.prediction[b]
    stands = np.arange(len(leaf))
    for i in np.flatnonzero(tree.left >= 0):  # parents first
        if leaf[i]:
            stands[[tree.left[i], tree.right[i]]] = stands[i]
            leaf[[tree.left[i], tree.right[i]]] = True
    return stands[tree.leaves]


def leaf_counts(model: Model, df: DataFrame, label: str = "label") -> DataFrame:
    """Rows per leaf and label, the leaf as its number: one pass, and no more rows than the tree has leaves and classes."""
    routed = model.copy().setLeafCol(LEAF).transform(df.select(quoted(label).alias("label"), "features"))
    return routed.groupBy("label", F.col(LEAF).cast("int").alias(LEAF)).agg(F.count(F.lit(1)).cast("double").alias(ROWS))


def scored_at_depths(model: Model, df: DataFrame, depths: Sequence[int]) -> dict[int, DataFrame]:
    """What the trees of some depths predict for the rows of ``df``, from one deeper tree: for each depth a small table of
    ``label, rawPrediction, probability, prediction`` and the number of rows that it stands for (``rows_``)."""
    (tree,) = read_trees(model)
    counts = leaf_counts(model, df).collect()
    out = {}
    for depth in depths:
        node = cut_leaves(tree, depth)
        total: dict[tuple, float] = {}
        for r in counts:
            place = (r["label"], int(node[r[LEAF]]))
            total[place] = total.get(place, 0.0) + r[ROWS]
        rows = []
        for (label, at), n in sorted(total.items()):
            stats = tree.stats[at]
            share = stats / stats.sum() if stats.sum() else stats
            rows.append((label, Vectors.dense(stats), Vectors.dense(share), float(np.argmax(stats)), n))
        out[depth] = df.sparkSession.createDataFrame(rows, ["label", "rawPrediction", "probability", "prediction", ROWS])
    return out


# ---- ensembles of fewer trees --------------------------------------------------------------------------


def _number_lists(values: Sequence[Sequence[float]], kind: str) -> Column:
    """Lists of numbers as one literal."""
    return F.from_json(F.lit(json.dumps([list(v) for v in values])), f"array<array<{kind}>>")


def staged_margins(model: Model, df: DataFrame, counts: Sequence[int], keep: Sequence[str] = ()) -> DataFrame:
    """``*keep, n_trees, margin``: what the first ``n_trees`` boosted trees add up to, for each of the counts.

    A margin orders rows as the probability of class 1 does. Every row is routed through all trees once.
    """
    trees = read_trees(model)
    if not counts or min(counts) < 1 or max(counts) > len(trees):
        raise ValueError(f"counts must lie between 1 and {len(trees)}")
    weighted = [w * t.prediction[t.leaves] for w, t in zip(model.treeWeights, trees)]
    routed = model.copy().setLeafCol(LEAF).transform(df)
    added = F.zip_with(vector_to_array(LEAF), _number_lists(weighted, "double"), lambda leaf, values: F.get(values, leaf.cast("int")))
    rows = routed.select(*[quoted(c) for c in keep], added.alias("added_"))
    wanted = F.from_json(F.lit(json.dumps(sorted(set(counts)))), "array<int>")
    stages = F.transform(wanted, lambda n: F.struct(n.alias("n"), F.aggregate(F.slice("added_", F.lit(1), n), F.lit(0.0), lambda a, x: a + x).alias("sum")))
    rows = rows.select(*[quoted(c) for c in keep], F.explode(stages).alias("stage_"))
    return rows.select(*[quoted(c) for c in keep], F.col("stage_.n").alias("n_trees"), F.col("stage_.sum").alias("margin"))


def staged_auc(model: Model, df: DataFrame, counts: Sequence[int], label: str = "label") -> DataFrame:
    """``n_trees, roc_auc``: the exact area under the curve after each of the counts of boosted trees, from one pass."""
    return roc_auc(staged_margins(model, df, counts, [label]), "margin", label, by=["n_trees"])


# ---- rows walked through a table of nodes ----------------------------------------------------------------


def walk(df: DataFrame, nodes: DataFrame, features: str = "features", column: str = "node", tree: int = 0) -> DataFrame:
    """The rows with the leaf that each reaches in a node table (``models.tree_nodes``), level by level.

    Needs no model: the table becomes five lists, and one expression steps from a node to its child as often as the tree
    is deep. The table of one tree is as large as its model.
    """
    rows = sorted(nodes.filter(F.col("tree") == tree).collect(), key=lambda r: r["node"])
    left = [-1 if r["left_child"] is None else r["left_child"] for r in rows]
    right = [-1 if r["right_child"] is None else r["right_child"] for r in rows]
    depth = [0] * len(rows)
    for i, (a, b) in enumerate(zip(left, right)):
        for child in (a, b):
            if child >= 0:
                depth[child] = depth[i] + 1
    literal = lambda values, kind: F.from_json(F.lit(json.dumps(values)), f"array<{kind}>")
    lefts, rights = literal(left, "int"), literal(right, "int")
    feature = literal([-1 if r["feature"] is None else r["feature"] for r in rows], "int")
    splits = literal([list(r["left_categories_or_threshold"] or []) for r in rows], "array<double>")
    kinds = literal([r["n_categories"] if r["n_categories"] is not None else -1 for r in rows], "int")
    x = vector_to_array(quoted(features))

    def step(node: Column, _: Column) -> Column:
        value, split = F.get(x, F.get(feature, node)), F.get(splits, node)
        to_left = F.when(F.get(kinds, node) < 0, value <= F.get(split, F.lit(0))).otherwise(F.array_contains(split, value))
        return F.when(F.get(lefts, node) < 0, node).when(to_left, F.get(lefts, node)).otherwise(F.get(rights, node))

    levels = max(depth, default=0)
    reached = F.aggregate(F.sequence(F.lit(1), F.lit(levels)), F.lit(0), step) if levels else F.lit(0)
    return df.withColumn(column, reached)
