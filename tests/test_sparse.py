"""Category columns of any size: the same results as the dense form, and 200,000 categories."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from orchard.operators import bayes, features as FT, linear, nested, sparse, trees


@pytest.fixture(scope="module")
def pages(spark):
    rng = np.random.default_rng(0)
    rows = [(i, f'"c{rng.integers(0, 9)}"' if i % 17 else None, float(rng.normal()), float(rng.integers(0, 5)) - 1,
             int(rng.random() < 0.5), float(rng.random())) for i in range(600)]
    return spark.createDataFrame(rows, "k long, category string, f0 double, f1 double, label int, u double")


def test_linear_models_equal_the_dense_form(spark, pages):
    fit = F.col("k") % 5 != 0
    dense = FT.fit_page_features(pages, ["f0", "f1"], fit_on=fit, on_unknown="zero")
    sp = sparse.fit_sparse_pages(pages, ["f0", "f1"], fit_on=fit)
    assert sp.dim == dense.dim
    a, b = dense.transform(pages), sp.transform(pages)
    for kind, args in (("logistic", (5, 3.0, 0.0, 0.5)), ("hinge", (6, 1.0, 0.01, 1.0))):
        m = linear.fit_sgd(a.where(fit), kind, dense.dim, *args)
        s = sparse.fit_sparse_sgd(b.where(fit), sp, kind, *args)
        w = {r.category: r.w for r in s.weights.collect()}
        got = [w[c] for c in dense.index.categories] + s.numeric
        assert got == pytest.approx(m.weights, rel=1e-8, abs=1e-11)
        p = {r.k: r.prediction for r in m.transform(a).collect()}
        assert {r.k: r.prediction for r in s.transform(b).collect()} == p


def test_naive_bayes_equals_the_dense_form(spark, pages):
    pf, model = bayes.fit_page_naive_bayes(pages, ["f0", "f1"], 2.0, on_unknown="zero")
    sp = sparse.fit_sparse_pages(pages, ["f0", "f1"], centred=False, clamp=True)
    s = sparse.fit_sparse_naive_bayes(sp.transform(pages), sp, 2.0)
    assert s.log_prior == pytest.approx(model.log_prior)
    theta = {r.category: r.theta for r in s.table.collect()}
    for i, th in enumerate(model.log_theta):
        assert [theta[c][i] for c in pf.index.categories] + s.numeric[i] == pytest.approx(th, rel=1e-9)
    p = {r.k: r.prediction for r in model.transform(pf.transform(pages)).collect()}
    assert {r.k: r.prediction for r in s.transform(sp.transform(pages)).collect()} == p


def test_two_hundred_thousand_categories(spark):
    df = spark.range(400_000).select(F.concat(F.lit("c"), F.col("id") % 200_000).alias("category"),
                                     (F.col("id") % 7).cast("double").alias("f0"),
                                     ((F.col("id") % 200_000) % 2).cast("int").alias("label"))
    sp = sparse.fit_sparse_pages(df, ["f0"])
    assert sp.size == 200_000
    rows = sp.transform(df)
    m = sparse.fit_sparse_sgd(rows, sp, "logistic", 2, 50.0)
    nb_pages = sparse.fit_sparse_pages(df, ["f0"], centred=False, clamp=True)
    nb = sparse.fit_sparse_naive_bayes(nb_pages.transform(df), nb_pages, 1.0)
    for scored in (m.transform(rows), nb.transform(nb_pages.transform(df))):
        ok = scored.agg(F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("a")).first()["a"]
        assert ok > 0.99


def test_many_dense_slots_are_one_expression(spark, monkeypatch):
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([(i, f"c{i % 300:03d}", float(rng.normal())) for i in range(900)],
                               "k long, category string, f0 double")
    wide = {r.k: r.features for r in FT.fit_page_features(df, ["f0"]).transform(df).collect()}
    monkeypatch.setattr(FT, "INLINE_LOOKUP_MAX", 1000)
    slots = {r.k: r.features for r in FT.fit_page_features(df, ["f0"]).transform(df).collect()}
    assert all(wide[k] == pytest.approx(slots[k], rel=1e-12) for k in slots) and len(wide[0]) == 301


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_and_categories_meet_where_they_lie(spark, pages):
    """A step's join and its sums need no exchange and no sort; hot categories are split over parts."""
    hot = pages.unionByName(pages.withColumn("category", F.lit("hot")))
    sp = sparse.fit_sparse_pages(hot, ["f0"], partitions=8)
    rows = sp.lay_out(sp.transform(hot).select("slot", "z", "label"))
    joined = rows.join(sp.table, ["slot", "part"], "left")
    plan = _plan(joined.groupBy("slot", "part").agg(F.count("idx")))
    assert "Exchange" not in plan and "Sort [" not in plan
    parts = {r.slot: r.parts for r in sp.hot.collect()}
    assert parts["hot"] >= sp.partitions // 2 and len(parts) < sp.partitions
    by_part = {r.part: r["count"] for r in rows.where("slot = 'hot'").groupBy("part").count().collect()}
    assert len(by_part) == parts["hot"] and max(by_part.values()) <= 2 * min(by_part.values())
    assert joined.where("slot is not null and idx is null").count() == 0


def test_many_configurations_advance_together(spark, pages):
    fit = F.col("k") % 5 != 0
    sp = sparse.fit_sparse_pages(pages, ["f0", "f1"], fit_on=fit, partitions=4)
    rows = sp.transform(pages)
    cfgs = [linear.SgdConfig("hinge", 1.0, 0.01), linear.SgdConfig("hinge", 5.0, 0.1), linear.SgdConfig("hinge", 1.0, 0.01, 0.5)]
    many, took = sparse.fit_sparse_sgd_many(rows.where(fit), sp, cfgs, [2, 5])
    assert set(took) == {2, 5} and len(many) == 6
    for (cfg, t), m in many.items():
        alone = sparse.fit_sparse_sgd(rows.where(fit), sp, cfg.kind, t, cfg.step_size, cfg.reg_param, cfg.mini_batch_fraction)
        assert m.numeric == pytest.approx(alone.numeric, rel=1e-9)
        w = {r.category: r.w for r in alone.weights.collect()}
        assert {r.category: r.w for r in m.weights.collect()} == pytest.approx(w, rel=1e-9, abs=1e-12)
    scored, cols = sparse.predict_sparse_many(rows, sp, {str(i): m for i, m in enumerate(many.values())})
    got = scored.select("k", *[c.alias(f"p{n}") for n, c in cols.items()]).toPandas().set_index("k").sort_index()
    for i, m in enumerate(many.values()):
        want = m.transform(rows).select("k", "prediction").toPandas().set_index("k").sort_index()["prediction"]
        assert (got[f"p{i}"] == want).all()


def test_sparse_trees_equal_dense_trees(spark):
    rng = np.random.default_rng(3)
    df = spark.createDataFrame([(i, f"c{rng.integers(0, 100):02d}" if i % 9 else None, float(rng.normal()), int(rng.integers(0, 4)))
                                for i in range(1500)], "k long, category string, f0 double, f1 int")
    df = df.withColumn("label", ((F.xxhash64("category") % 3 == 0) | (F.col("f0") > 1)).cast("double")).fillna({"label": 0.0})
    dense = FT.fit_page_features(df, ["f0", "f1"], scale=False, on_unknown="zero")
    sp = sparse.fit_sparse_pages(df, ["f0", "f1"])
    rows = trees.stable_input(df.select("category", "f0", "f1", "label"))
    a = trees.fit_tree(dense.transform(rows), "class", "gini", 6, 16, stable=False)
    b = trees.fit_sparse_tree(df, sp, "class", "gini", 6, 16)
    x, y = nested.node_table(a, spark), nested.node_table(b.tree, spark)
    assert all(np.array_equal(getattr(x, f), getattr(y, f)) for f in ("prediction", "left", "feature", "threshold"))
    new = df.withColumn("category", F.when(F.col("k") % 2 == 0, "unknown").otherwise(F.col("category")))
    want = {r.k: r.prediction for r in a.transform(dense.transform(new)).collect()}
    assert {r.k: r.prediction for r in b.transform(new).collect()} == want


def test_a_tree_on_fifty_thousand_categories(spark):
    df = spark.range(50_000).select(F.concat(F.lit("c"), F.col("id")).alias("category"), F.rand(1).alias("f0"))
    sp = sparse.fit_sparse_pages(df, ["f0"])
    few = df.limit(300).withColumn("label", (F.col("f0") > 0.5).cast("double"))
    m = trees.fit_sparse_tree(few, sp, "class", "gini", 2, 8)
    got = m.transform(few).agg(F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("a")).first()
    assert sp.dim == 50_001 and got["a"] > 0.85 and m.tree.depth >= 1


def test_two_hundred_thousand_categories_through_the_page_program(spark, tmp_path):
    from orchard.plans import programs
    n = 200_000
    row = F.concat_ws("\t", F.concat(F.lit("http://p"), "id"), F.lit("1"), F.lit("x"),
                      F.concat(F.lit("c"), F.col("id") % n), (F.col("id") % 7).cast("string"))
    labelled = F.concat_ws("\t", row, ((F.col("id") % n) % 2).cast("string"))
    head = "url\tid\tbody\tcategory\tf0"
    for name, rows, line, header in (("train", 2 * n, labelled, head + "\tlabel"), ("score", 50, row, head)):
        lines = spark.range(rows).select(line.alias("value")).unionByName(spark.range(1).select(F.lit("short\tline").alias("value")))
        lines.withColumnRenamed("value", header).write.option("header", True).option("quote", "").option(
            "sep", "￿").csv(f"{tmp_path}/{name}")
    out = programs.page_classifier(spark, f"{tmp_path}/train", f"{tmp_path}/score", "naive_bayes")
    ev = {r.split: r.auc_hard for r in out["evaluation"].collect()}
    # a category has two rows: for one in five the other row is no training row either, a coin flip
    assert ev["validation"] > 0.88 and ev["test"] > 0.88
    assert out["predictions"].count() == 10 and out["rejects"].count() == 2
