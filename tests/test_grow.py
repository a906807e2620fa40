import pytest
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.sql import functions as F

from orchard.operators import grow, trees


def _rows(spark, n, dim, classes):
    x = F.array(*[F.round(F.pmod(F.xxhash64("id", F.lit(j)), F.lit(997)) / 7.0, 1 + j % 2) if j % 3 else
                  F.pmod(F.hash("id", F.lit(j)), F.lit(3)).cast("double") for j in range(dim)])
    y = F.pmod(F.floor(x[1] / 40 + x[2] / 60) + F.when(F.pmod(F.xxhash64("id", F.lit("y")), F.lit(5)) == 0, 1).otherwise(0), classes)
    return spark.range(0, n, 1, 4).select(x.alias("features"), y.cast("double").alias("label"))


@pytest.mark.parametrize("kind,depth,bins,classes,local", [
    ("gini", 12, 20, 2, 500), ("entropy", 20, 100, 4, 500), ("entropy", 6, 5, 2, 10 ** 6), ("gini", 25, 200, 3, 3000)])
def test_grown_tree_is_the_learners(spark, monkeypatch, kind, depth, bins, classes, local):
    """Same nodes, thresholds and counts, with large nodes split by counts and small ones in tasks."""
    monkeypatch.setattr(grow, "LOCAL_ROWS", local)
    rows = trees.stable_input(_rows(spark, 12_000, 5, classes), partitions=4).cache()
    ours = trees.fit_tree(rows, "class", kind, depth, bins, cache=False, stable=False)
    ml = DecisionTreeClassifier(featuresCol="fvec", labelCol="label", maxDepth=depth, maxBins=bins, impurity=kind,
                                seed=trees.TREE_SEED).fit(trees.vectorize(rows).select("fvec", "label"))
    assert ours.model.toDebugString.split("\n")[1:] == ml.toDebugString.split("\n")[1:]
    assert (ours.depth, ours.num_nodes) == (ml.depth, ml.numNodes) and ml.numNodes > 20


def test_deep_tree_moves_no_counts_per_node(spark, monkeypatch):
    """The rows are handed to the grower, which counts for large nodes only; the learner is not run."""
    monkeypatch.setattr(trees.DecisionTreeClassifier, "fit", lambda *a, **k: pytest.fail("dense counts per node"))
    assert trees.fit_tree(_rows(spark, 2_000, 4, 2), "class", "gini", 20, 50).num_nodes > 50
