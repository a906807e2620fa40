"""Exact-quantile bins: thresholds against numpy, and trees that no partitioning moves."""

import numpy as np
import pytest

from orchard.operators import binning, nested


def plain_thresholds(values, bins):
    v, n = np.unique(np.asarray(values)[~np.isnan(values)], return_counts=True)
    cum, total = np.cumsum(n), n.sum()
    if len(v) <= bins:
        return v[:-1].tolist()
    passed = np.minimum(cum * bins // total, bins - 1) > (cum - n) * bins // total
    return v[passed & (cum < total)].tolist()


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(6)
    x = np.stack([rng.normal(0, 1, 3000), rng.integers(0, 3, 3000), np.full(3000, 7.0), rng.zipf(1.5, 3000) % 50,
                  np.where(rng.random(3000) < 0.97, 0.0, 1.0)], axis=1).astype(float)
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] == 2)).astype(float)
    df = spark.createDataFrame([(v.tolist(), float(t)) for v, t in zip(x, y)], "features array<double>, label double")
    return x, y, df


@pytest.mark.parametrize("bins", [2, 5, 32])
def test_thresholds_equal_exact_quantiles(rows, bins):
    x, _, df = rows
    got = binning.quantile_thresholds(df.repartition(7), bins)
    for j in range(x.shape[1]):
        assert got.get(j, []) == plain_thresholds(x[:, j], bins), j
        assert len(got.get(j, [])) < bins
    assert 2 not in got                                     # a constant feature
    per_bin = np.bincount(np.searchsorted(got[0], x[:, 0], "left"))
    assert per_bin.max() - per_bin.min() <= 2               # equal shares where all values differ


def test_trees_do_not_move_with_partitioning_and_see_every_threshold(spark, rows):
    x, y, df = rows
    trees = [binning.fit_binned_tree(df.repartition(n), 5, "class", "entropy", 4, 8) for n in (1, 5)]
    a, b = (nested.node_table(t.tree, spark) for t in trees)
    assert all(np.array_equal(getattr(a, f), getattr(b, f)) for f in ("prediction", "left", "feature", "threshold"))
    got = trees[0].transform(df).select("prediction", "label").toPandas()
    assert (got["prediction"] == got["label"]).mean() > 0.9 and trees[0].depth <= 4 and trees[0].fit_ms > 0


def test_empty_and_null_features(spark):
    df = spark.createDataFrame([([1.0, None],), ([2.0, None],), (None,)], "features array<double>")
    assert binning.quantile_thresholds(df, 4) == {0: [1.0]}
    assert binning.quantile_thresholds(df.limit(0), 4) == {}
    with pytest.raises(ValueError):
        binning.quantile_thresholds(df, 1)
