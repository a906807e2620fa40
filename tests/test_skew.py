"""A key holding a third of all rows must not change results (skew safety)."""

from pyspark.sql import functions as F

from orchard.operators import bayes, recommend as R, split as SP


def _skewed(spark, n=3000):
    rows = []
    for i in range(n):
        user = 0 if i % 3 == 0 else i          # user 0 holds a third of the rows
        rows.append((user, i % 97, float((i * 7) % 5 + 1), [float(i % 4), float(i % 5)],
                     1.0 if i % 3 == 0 else float(i % 2)))
    return spark.createDataFrame(rows, "user_id int, item_id int, rating double, "
                                       "features array<double>, label double")


def test_topk_hot_key_matches_brute_force(spark):
    df = _skewed(spark)
    top = R.top_k_per_key(df, ["user_id"], [F.desc("rating"), F.asc("item_id")], 10)
    got = [(r.rank, r.item_id, r.rating) for r in top.where("user_id = 0").orderBy("rank").collect()]
    hot = sorted(((r.rating, r.item_id) for r in df.where("user_id = 0").collect()),
                 key=lambda t: (-t[0], t[1]))[:10]
    assert [(g[1], g[2]) for g in got] == [(i, r) for r, i in hot]
    assert [g[0] for g in got] == list(range(1, 11))


def test_class_stats_with_dominant_class(spark):
    df = _skewed(spark).repartition(7)
    stats = {lab: (n, sums) for lab, n, sums in bayes.fit_stats(df, 2)}
    rows = df.collect()
    for lab, (n, sums) in stats.items():
        sel = [r for r in rows if r.label == lab]
        assert n == len(sel)
        assert sums == [sum(r.features[j] for r in sel) for j in range(2)]


def test_split_counts_hot_bucket(spark):
    df = _skewed(spark)
    counts = {r.split: r.n for r in SP.split_counts(SP.assign_split(df, F.col("user_id"))).collect()}
    assert sum(counts.values()) == 3000     # the hot user's 1000 rows all land in one split
