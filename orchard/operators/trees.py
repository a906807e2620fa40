"""Decision trees through Spark ML's distributed learner.

Features stay an ``array<double>`` in our frames, or a sparse vector where a category
column has many values (``sparse.SparsePages.vectors``); the learner gets a vector
view.  All features are treated as continuous (one-hot slots too).
"""

from __future__ import annotations

import time
from dataclasses import dataclass
from typing import Sequence

from pyspark import StorageLevel
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orchard.operators import grow
from orchard.session import ensure_checkpoint_dir

MAX_DEPTH_LIMIT = 30
TREE_SEED = 11


def vectorize(df: DataFrame, features: str = "features", out: str = "fvec") -> DataFrame:
    if isinstance(df.schema[features].dataType, VectorUDT):
        return df.withColumn(out, F.col(features))
    return df.withColumn(out, array_to_vector(F.col(features)))


def stable_input(df: DataFrame, key: Sequence[str] | None = None,
                 partitions: int | None = None) -> DataFrame:
    """Hash-partition by ``key`` (all columns if not given) and sort within partitions by
    all columns, so that a fit does not depend on how the input happened to be split
    (one shuffle).  Rows equal in all columns are interchangeable.  The number of
    partitions is the session's shuffle setting unless given."""
    key = list(key) if key else [c for c in df.columns if c != "fvec"]
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cols = key + [c for c in df.columns if c not in key and c != "fvec"]
    return df.repartition(n, *key).sortWithinPartitions(*cols)


@dataclass
class TreeModel:
    model: object
    kind: str
    fit_ms: float

    def transform(self, df: DataFrame, out: str = "prediction",
                  features: str = "features") -> DataFrame:
        m = self.model.copy()
        m.setFeaturesCol("fvec").setPredictionCol(out)
        if self.kind == "class":
            m.setRawPredictionCol("").setProbabilityCol("")
        cols = df.columns
        return m.transform(vectorize(df, features)).select(*cols, out)

    @property
    def depth(self) -> int:
        return self.model.depth

    @property
    def num_nodes(self) -> int:
        return self.model.numNodes


def fit_tree(df: DataFrame, kind: str = "class", impurity: str = "gini",
             max_depth: int = 5, max_bins: int = 32, features: str = "features",
             label: str = "label", seed: int = TREE_SEED, cache: bool = True,
             stable: bool = True) -> TreeModel:
    """Fit a class tree (gini / entropy) or a value tree (variance).

    ``stable=True`` puts the rows into an order of their own first
    (``stable_input``): the learner samples its split candidates by row order, so
    the tree would otherwise move with the partitioning of the input.  Vectors have no
    order; rows that hold vectors are put into one before (``fit_sparse_tree``).

    Class trees over arrays are grown by ``grow``: the learner's tree at a cost that follows the rows.

    The learner makes several preparatory passes (class count, row count,
    split candidates, binning) before it caches its own binned rows; with
    ``cache=True`` the (vector, label) input is persisted for the fit so those
    passes do not each recompute the upstream joins.  Pass ``cache=False``
    when the input is already cached.
    """
    if not 0 <= max_depth <= MAX_DEPTH_LIMIT:
        raise ValueError(f"maxDepth must be in [0, {MAX_DEPTH_LIMIT}], got {max_depth}")
    if max_bins < 2:
        raise ValueError("maxBins must be >= 2")
    ensure_checkpoint_dir(df.sparkSession)
    data = df.select(F.col(features).alias("features"), F.col(label).cast("double").alias("label"))
    if stable and not isinstance(data.schema["features"].dataType, VectorUDT):
        data = stable_input(data)
    params = dict(featuresCol="fvec", labelCol="label", maxDepth=max_depth, maxBins=max_bins,
                  impurity=impurity, seed=seed, cacheNodeIds=True, checkpointInterval=10)
    if kind == "class":
        est = DecisionTreeClassifier(**params)
    elif kind == "value":
        est = DecisionTreeRegressor(**params)
    else:
        raise ValueError(kind)
    t0 = time.perf_counter()
    arrays = kind == "class" and not isinstance(data.schema["features"].dataType, VectorUDT)
    if not arrays:
        data = vectorize(data).select("fvec", "label")
    if cache:
        data = data.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        seen = grow.shape(data) if arrays else None
        if seen:
            model = grow.class_tree(data, *seen, params)
        else:
            model = est.fit(vectorize(data).select("fvec", "label") if arrays else data)
    finally:
        if cache:
            data.unpersist()
    return TreeModel(model, kind, (time.perf_counter() - t0) * 1000.0)


@dataclass
class SparseTreeModel:
    """A tree over ``pages.vectors``: transforms frames with the category and number columns."""

    tree: TreeModel
    pages: object               # sparse.SparsePages

    def transform(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        return self.tree.transform(self.pages.vectors(df, out="__vec"), out, "__vec").drop("__vec")


def fit_sparse_tree(df: DataFrame, pages, kind: str = "class", impurity: str = "gini", max_depth: int = 5,
                    max_bins: int = 32, label: str = "label", seed: int = TREE_SEED) -> SparseTreeModel:
    """A tree over a category column of any size and numbers, as sparse vectors (M1): no row holds a
    number per category.  ``pages`` (``sparse.fit_sparse_pages``) has the categories' slots."""
    rows = stable_input(df.select("category", *pages.numeric, F.col(label).cast("double").alias("label")))
    tree = fit_tree(pages.vectors(rows, out="features"), kind, impurity, max_depth, max_bins, seed=seed, stable=False)
    return SparseTreeModel(tree, pages)


def predict_many(df: DataFrame, models: dict[str, TreeModel],
                 features: str = "features") -> tuple[DataFrame, dict[str, Column]]:
    """Add one prediction column per model (all evaluated in the same scan)."""
    out = vectorize(df, features)
    cols = {}
    for i, (name, tm) in enumerate(models.items()):
        m = tm.model.copy()
        c = f"__p{i}"
        m.setFeaturesCol("fvec").setPredictionCol(c)
        if tm.kind == "class":
            m.setRawPredictionCol("").setProbabilityCol("")
        out = m.transform(out)
        cols[name] = F.col(c)
    return out, cols
