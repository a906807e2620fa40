"""One tree for all depths (G1, G5): a tree is grown greedily level by level, so the tree of a
smaller depth is the deeper one cut at that level.

A fitted tree is read back as its node table (the format Spark ML saves trees in), one
row per node in preorder.  Cutting turns the nodes of a level into leaves and merges
sibling leaves that predict the same, as the learner does itself.  Rows are scored by
the deepest tree once: its leaf gives the prediction at every depth.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orchard.operators.common import lit_array
from orchard.operators.trees import TreeModel, vectorize
from orchard.session import ensure_checkpoint_dir


@dataclass
class NodeTable:
    """Nodes in preorder; children are -1 for a leaf."""

    prediction: np.ndarray
    left: np.ndarray
    right: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray

    def __len__(self) -> int:
        return len(self.prediction)

    def levels(self) -> np.ndarray:
        level = np.zeros(len(self), np.int64)
        for i in np.flatnonzero(self.left >= 0):        # parents come before children
            level[self.left[i]] = level[self.right[i]] = level[i] + 1
        return level

    @property
    def depth(self) -> int:
        return int(self.levels().max(initial=0))

    def cut(self, depth: int) -> NodeTable:
        """The tree that a fit of this depth gives."""
        leaf = (self.left < 0) | (self.levels() >= depth)
        stays = np.zeros(len(self), bool)
        for i in range(len(self) - 1, -1, -1):          # children come before parents
            a, b = self.left[i], self.right[i]
            if not leaf[i] and leaf[a] and leaf[b] and self.prediction[a] == self.prediction[b]:
                leaf[i] = True
        stays[:1] = True
        for i in range(len(self)):
            if stays[i] and not leaf[i]:
                stays[[self.left[i], self.right[i]]] = True
        number = np.cumsum(stays) - 1
        at = np.flatnonzero(stays)
        inner = ~leaf[at]

        def renumbered(child):
            return np.where(inner, number[np.maximum(child[at], 0)], -1)

        return NodeTable(self.prediction[at], renumbered(self.left), renumbered(self.right),
                         np.where(inner, self.feature[at], -1), np.where(inner, self.threshold[at], 0.0))

    def leaf_predictions(self, depth: int) -> np.ndarray:
        """What the tree cut at ``depth`` predicts for each leaf of this one (leaves in preorder)."""
        level, value = self.levels(), self.prediction.copy()
        for i in np.flatnonzero(self.left >= 0):
            if level[i] >= depth:
                value[self.left[i]] = value[self.right[i]] = value[i]
        return value[self.left < 0]


def node_table(tree: TreeModel, spark) -> NodeTable:
    """The nodes of a fitted tree (which is on the driver already)."""
    path = f"{ensure_checkpoint_dir(spark)}/tree-{uuid.uuid4().hex}"
    tree.model.write().save(path)
    try:
        rows = spark.read.parquet(f"{path}/data").select(
            "id", "prediction", "leftChild", "rightChild", F.col("split.featureIndex").alias("feature"),
            F.get("split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold")).orderBy("id").toPandas()
    finally:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    return NodeTable(rows["prediction"].to_numpy(float), rows["leftChild"].to_numpy(int),
                     rows["rightChild"].to_numpy(int), rows["feature"].to_numpy(int),
                     rows["threshold"].fillna(0.0).to_numpy(float))


@dataclass
class CutTree:
    """A tree of one depth, read off a deeper one."""

    deep: TreeModel
    nodes: NodeTable            # of the deep tree
    max_depth: int

    @property
    def fit_ms(self) -> float:
        return self.deep.fit_ms

    @property
    def shape(self) -> NodeTable:
        return self.nodes.cut(self.max_depth)

    def predict_col(self, leaf: Column) -> Column:
        """Prediction from the deep tree's leaf number."""
        return F.element_at(lit_array(self.nodes.leaf_predictions(self.max_depth)), leaf.cast("int") + 1)

    def transform(self, df: DataFrame, out: str = "prediction", features: str = "features") -> DataFrame:
        scored = with_leaves(df, {"__leaf": self.deep}, features)
        return scored.withColumn(out, self.predict_col(F.col("__leaf"))).select(*df.columns, out)


def leaf_table(nodes: NodeTable, leaf: str, depths: dict[str, int]) -> pa.Table:
    """What the tree predicts for each leaf (numbered in preorder, as doubles), cut at each of ``depths``."""
    guesses = {name: nodes.leaf_predictions(depth) for name, depth in depths.items()}
    n = int((nodes.left < 0).sum())
    return pa.table({leaf: np.arange(n, dtype=np.float64), **guesses})


def with_leaves(df: DataFrame, trees: dict[str, TreeModel], features: str = "features") -> DataFrame:
    """``df`` with a leaf number per tree (all found in the same scan)."""
    out = vectorize(df, features)
    for i, (name, tree) in enumerate(trees.items()):
        m = tree.model.copy()
        m.setFeaturesCol("fvec").setPredictionCol(f"__tree{i}").setLeafCol(name)
        if tree.kind == "class":
            m.setRawPredictionCol("").setProbabilityCol("")
        out = m.transform(out).drop(f"__tree{i}")
    return out.drop("fvec")
