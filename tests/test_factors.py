"""Factorisation of very many ratings: the steps of ALS with the ratings on disk."""

import numpy as np
import pytest

from orchard.operators import factors as X
from orchard.operators import recommend as R


@pytest.fixture()
def small(monkeypatch):
    """Many blocks, groups and ranges for few ids."""
    for name, value in (("GROUP", 7), ("RANGE", 4), ("PACK", 50), ("BLOCKS", 3), ("BATCH_BYTES", 2_000), ("DENSE", 100)):
        monkeypatch.setattr(X, name, value)


def _ratings(users, items, seed=3):
    rng = np.random.default_rng(seed)
    rows = [(int(u), int(i), float(rng.integers(1, 6))) for u in users for i in items if rng.random() < 0.4]
    return rows + rows[:5] + [(int(users[0]), int(i), 4.0) for i in items]         # repeated ratings and a busy user


def _by_hand(rows, start, rank, reg, iterations):
    user, item = dict(start), {}

    def solve(own, other):
        out = {}
        for k in {r[own] for r in rows}:
            mine = [r for r in rows if r[own] == k]
            y, r = np.array([other[m[1 - own]] for m in mine], np.float64), np.array([m[2] for m in mine])
            out[k] = np.linalg.solve(y.T @ y + reg * len(mine) * np.eye(rank), y.T @ r).astype(np.float32)
        return out

    for _ in range(iterations):
        item = solve(1, user)
        user = solve(0, item)
    return user, item


def test_steps_equal_least_squares_by_hand(spark, small):
    rows = _ratings(range(41), range(2, 60, 3))
    df = spark.createDataFrame(rows, "user_id int, item_id int, rating double").repartition(5)
    side = X._Side(40, 3)
    start = {}
    for r in X._start(spark, side, 3, 42).collect():
        vec = np.frombuffer(r.vec, np.float32).reshape(-1, 3)
        start |= {(r.g % side.groups * X.GROUP + k) * 3 + r.g // side.groups: v for k, v in enumerate(vec)}
    assert all(abs(np.linalg.norm(v) - 1) < 1e-5 for v in start.values())
    before = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.enabled", "spark.sql.execution.arrow.maxBytesPerBatch",
                                             "spark.sql.requireAllClusterKeysForCoPartition")}
    got = X.factorise(df, 3, 3, 0.1, 42)
    assert before == {c: spark.conf.get(c) for c in before}
    for have, want in zip(got, _by_hand(rows, start, 3, 0.1, 3)):
        have = {r.id: r.features for r in have.collect()}
        assert have.keys() == want.keys()
        for k in want:
            assert have[k] == pytest.approx(want[k].tolist(), rel=1e-3, abs=1e-4)


def test_many_ratings_leave_sparks_learner(spark, small, monkeypatch):
    def refused(**kw):
        raise AssertionError("a block of ratings would be held")

    monkeypatch.setattr(R, "ALS", refused)
    monkeypatch.setattr(R, "MANY_RATINGS", 100)
    rows = [(u, i, float(1 + (u + 20) % 5)) for u in range(-7, 23) for i in range(0, 2_000_000_000, 100_000_000)]
    df = spark.createDataFrame(rows, "user_id int, item_id int, rating double")      # ids that are numbered first
    m = R.fit_als(df, rank=3, max_iter=5)
    assert m.rank == 3 and m.userFactors.count() == 30 and m.itemFactors.count() == 20
    assert R.predict_pairs(m, df).where("abs(prediction - rating) > 0.5").count() == 0
    unknown = spark.createDataFrame([(1, 5), (999, 0)], "user_id int, item_id int")
    assert R.predict_pairs(m, unknown, "drop").count() == 0
    top = R.items_for_users(m, spark.createDataFrame([(1,), (999,)], "user_id int"), 4).collect()
    assert sorted((r.user_id, r["rank"]) for r in top) == [(1, 1), (1, 2), (1, 3), (1, 4)]


def test_fit_does_not_vary_with_the_order_of_the_ratings(spark, small):
    rows = _ratings(range(20), range(15))
    fits = []
    for given, parts in ((rows, 1), (rows[::-1], 6)):
        df = spark.createDataFrame(given, "user_id int, item_id int, rating double").repartition(parts)
        fits.append({r.id: r.features for r in X.factorise(df, 2, 4, 0.1, 7)[0].collect()})
    assert fits[0].keys() == fits[1].keys()
    for k, v in fits[0].items():
        assert fits[1][k] == pytest.approx(v, rel=1e-4, abs=1e-5)


@pytest.mark.parametrize("row", [(None, 1, 1.0), (1, None, 1.0), (1, 1, None), (1, 1, float("nan"))])
def test_null_ids_and_ratings_are_refused(spark, row):
    df = spark.createDataFrame([(1, 1, 2.0), row], "user_id int, item_id int, rating double")
    with pytest.raises(ValueError):
        X.factorise(df, 2, 1, 0.1, 1)
