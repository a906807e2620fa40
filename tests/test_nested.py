"""Trees of smaller depths are cut from the deepest one: the same trees as separate fits."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from orchard.operators import nested, trees, tune
from orchard.plans import prepared as P

CASES = {"binary": ("class", "entropy", [1, 3, 5, 10], 10), "multi": ("class", "gini", [0, 2, 6, 12], 30),
         "hourly": ("value", "variance", [1, 3, 7], 32)}


def part(spark, name):
    prep = P.binary(spark, SF_SMALL, scale=False) if name == "binary" else getattr(P, name)(spark, SF_SMALL)
    return prep.part("train").select("features", "label"), prep.part("validation").select("features", "label")


@pytest.mark.parametrize("name", CASES)
def test_cut_trees_equal_separate_fits_node_by_node(spark, name):
    kind, impurity, depths, bins = CASES[name]
    train, valid = part(spark, name)
    rows = trees.stable_input(train).persist()
    deep = trees.fit_tree(rows, kind, impurity, max(depths) + 3, bins, cache=False, stable=False)
    table = nested.node_table(deep, spark)
    for d in depths:
        alone = trees.fit_tree(rows, kind, impurity, d, bins, cache=False, stable=False)
        a, b = table.cut(d), nested.node_table(alone, spark)
        for f in ("prediction", "left", "right", "feature", "threshold"):
            assert np.array_equal(getattr(a, f), getattr(b, f)), (d, f)
        assert a.depth == alone.depth and len(a) == alone.num_nodes
        got = nested.CutTree(deep, table, d).transform(valid).select("prediction").collect()
        assert got == alone.transform(valid).select("prediction").collect()
    rows.unpersist()


def test_tuning_fits_one_tree_for_all_depths(spark, monkeypatch):
    train, valid = part(spark, "binary")
    fits, real = [], trees.fit_tree
    monkeypatch.setattr(trees, "fit_tree", lambda *a, **k: fits.append(a[2:5]) or real(*a, **k))
    entries = tune.grid_entries([("impurity", ["gini", "entropy"]), ("max_depth", [2, 4, 3]), ("max_bins", [5, 10])])
    res, models = tune.tune_tree(train, valid, "class", entries, "auc_hard")
    assert sorted(fits) == [("entropy", 4, 5), ("entropy", 4, 10), ("gini", 4, 5), ("gini", 4, 10)]
    assert [r.position for r in res.orderBy("position").collect()] == list(range(12))
    assert {m.max_depth for m in models.values()} == {2, 3, 4} and all(m.shape.depth <= m.max_depth for m in models.values())
