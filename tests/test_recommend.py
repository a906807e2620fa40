import pytest
from pyspark.sql import functions as F

from orchard.operators import recommend as R


def test_topk_per_key_bounded_and_ordered(spark):
    rows = [(u, i, float((u * 7 + i * 3) % 5)) for u in range(5) for i in range(30)]
    df = spark.createDataFrame(rows, "user_id int, item_id int, rating double")
    top = R.top_k_per_key(df, ["user_id"], [F.desc("rating"), F.asc("item_id")], 10).collect()
    by = {}
    for r in top:
        by.setdefault(r.user_id, []).append((r.rank, r.rating))
    for u, lst in by.items():
        lst.sort()
        assert len(lst) == 10
        assert all(a[1] >= b[1] for a, b in zip(lst, lst[1:]))


def test_als_scores_are_factor_dot_products_and_unknown_user(spark):
    rows = [(u, i, float(1 + (u + i) % 5)) for u in range(30) for i in range(20) if (u * i) % 3 != 1]
    df = spark.createDataFrame(rows, "user_id int, item_id int, rating double")
    m = R.fit_als(df, rank=3, max_iter=5)
    recs = R.items_for_users(m, spark.createDataFrame([(1,), (999999,)], "user_id int"), 5)
    got = recs.collect()
    assert {r.user_id for r in got} == {1}
    assert [r.rank for r in sorted(got, key=lambda r: r.rank)] == [1, 2, 3, 4, 5]
    uf = {r.id: r.features for r in m.userFactors.collect()}
    itf = {r.id: r.features for r in m.itemFactors.collect()}
    for r in got:
        dot = sum(a * b for a, b in zip(uf[1], itf[r.item_id]))
        assert r.score == pytest.approx(dot, rel=1e-5)
    scores = [r.score for r in sorted(got, key=lambda r: r.rank)]
    assert scores == sorted(scores, reverse=True)
    users = R.users_for_items(m, spark.createDataFrame([(2,)], "item_id int"), 4).collect()
    assert len(users) == 4


@pytest.mark.parametrize("block", [4096, 16])
def test_norm_bounded_topk_equals_all_products(spark, monkeypatch, block):
    import numpy as np
    from orchard.operators import topk
    rng = np.random.default_rng(4)
    size = rng.gamma(0.7, 2.0, (300, 1)) + 0.01                       # norms that differ much
    items = (rng.normal(0, 1, (300, 4)) * size).astype(np.float32)
    items[50:60] = items[50]                                          # ties
    users = rng.normal(0, 1, (40, 4)).astype(np.float32)
    users[7] = 0.0
    frame = lambda m: spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "id int, features array<float>")
    seen, real = [], topk._scored

    def counted(groups, blocks, n):
        asked = F.size(F.filter("last", lambda x: x > F.col("b")))
        seen.append(groups.agg(F.sum(asked)).first()[0] or 0)
        return real(groups, blocks, n)

    monkeypatch.setattr(topk, "_scored", counted)
    got = topk.top_products(frame(users), frame(items), 10, block).collect()
    score = users.astype(float) @ items.astype(float).T
    for u in range(40):
        want = sorted(range(300), key=lambda i: (-score[u, i], i))[:10]
        assert [r.id for r in sorted((r for r in got if r.rid == u), key=lambda r: r.rank)] == want
    assert len(got) == 400
    if block == 16:                                                   # most (user, block) pairs are never scored
        assert sum(seen) < 0.6 * 40 * 19
    assert topk.top_products(frame(users[:0]), frame(items), 10, block).count() == 0
    assert topk.top_products(frame(users), frame(items[:3]), 10, block).count() == 120


def test_many_ratings_take_few_factor_blocks(spark, monkeypatch):
    assert R.factor_blocks(600_000, 12) == 12 and R.factor_blocks(600_000, 4) == 10
    assert R.factor_blocks(36_000_000, 12) == 4
    assert R.factor_blocks(216_000_000, 12) * R.BLOCK_RATINGS >= 216_000_000
    made, real = [], R.ALS

    def als(**kw):
        made.append((kw["numUserBlocks"], kw["numItemBlocks"]))
        return real(**kw)

    monkeypatch.setattr(R, "ALS", als)
    monkeypatch.setattr(R, "FEW_RATINGS", 100)
    rows = [(u, i, float(1 + u % 5)) for u in range(30) for i in range(20)]
    df = spark.createDataFrame(rows, "user_id int, item_id int, rating double")
    m = R.fit_als(df, rank=3, max_iter=5)
    assert made == [(R.MIN_BLOCKS, R.MIN_BLOCKS)]
    assert m.userFactors.count() == 30 and m.itemFactors.count() == 20
    assert R.predict_pairs(m, df).where("abs(prediction - rating) > 0.5").count() == 0


def test_pair_checks_drop_no_rating_and_read_them_once(spark, tmp_path, monkeypatch):
    from orchard.plans import q_trees_als as Q
    orders = [(o, o % 7) for o in range(60)]
    lines = [(o, (o * k) % 11, float(1 + (o + k) % 50)) for o in range(60) for k in range(1, 4)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_quantity double").write.parquet(f"{tmp_path}/lineitem.parquet")
    monkeypatch.setattr(Q, "ALS_PARAMS", dict(rank=3, max_iter=3, reg_param=0.1))
    got = Q.q_als_predict_pair_checks(spark, str(tmp_path))
    assert not any("orders.parquet" in f for f in got.inputFiles())     # neither joined anew nor aggregated
    rows = got.collect()
    assert sorted((r.user_id, r.item_id) for r in rows) == sorted({(o % 7, p) for o, p, _ in lines})
    assert all(r.is_product for r in rows)


def test_topk_leaves_most_blocks_out_when_norms_are_equal(spark, monkeypatch):
    import numpy as np
    from orchard.operators import topk
    rng = np.random.default_rng(11)
    items = rng.normal(0, 1, (640, 3))
    items = (items / np.linalg.norm(items, axis=1)[:, None]).astype(np.float32)     # no norm bound can tell them apart
    users = rng.normal(0, 1, (30, 3)).astype(np.float32)
    frame = lambda m: spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "id int, features array<float>")
    seen, real = [], topk._scored

    def counted(groups, blocks, n):
        asked = F.size(F.filter("last", lambda x: x > F.col("b")))
        seen.append(groups.agg(F.sum(asked)).first()[0] or 0)
        return real(groups, blocks, n)

    monkeypatch.setattr(topk, "_scored", counted)
    got = topk.top_products(frame(users), frame(items), 5, 16).collect()
    score = users.astype(float) @ items.astype(float).T
    for u in range(30):
        want = sorted(range(640), key=lambda i: (-score[u, i], i))[:5]
        assert [r.id for r in sorted((r for r in got if r.rid == u), key=lambda r: r.rank)] == want
    assert sum(seen) < 0.5 * 30 * 40
    assert topk.top_products(frame(users), frame(items[:0]), 5, 16).count() == 0
