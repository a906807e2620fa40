import math

import numpy as np
import pytest
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from orchard.operators import bayes, evaluate, linear, split as SP, trees, tune


def _toy(spark, n=400, d=3):
    rows = []
    for i in range(n):
        x = [((i * 37 + j * 11) % 17) / 4.0 for j in range(d)]
        y = 1.0 if x[0] + 0.5 * x[1] - x[2] * 0.3 > 2.2 else 0.0
        rows.append((i, y, x))
    df = spark.createDataFrame(rows, "k long, label double, features array<double>")
    return SP.with_unit(df, F.col("k"))


def test_naive_bayes_matches_spark_ml(spark):
    df = _toy(spark)
    for lam in (1.0, 5.0):
        ours = bayes.fit_naive_bayes(df, 3, lam)
        v = df.withColumn("v", array_to_vector("features"))
        ml = NaiveBayes(featuresCol="v", smoothing=lam, modelType="multinomial").fit(v)
        assert ours.log_prior == pytest.approx(list(ml.pi), rel=1e-12)
        theta = ml.theta.toArray().tolist()
        for a, b in zip(ours.log_theta, theta):
            assert a == pytest.approx(b, rel=1e-12)
        p1 = [r.prediction for r in ours.transform(df).orderBy("k").collect()]
        p2 = [r.prediction for r in ml.transform(v).orderBy("k").collect()]
        assert p1 == p2


def test_naive_bayes_refuses_negative(spark):
    df = spark.createDataFrame([(1.0, [-1.0, 2.0])], "label double, features array<double>")
    with pytest.raises(ValueError):
        bayes.fit_naive_bayes(df, 2)


def test_sgd_matches_mllib_full_batch(spark):
    from pyspark.mllib.classification import LogisticRegressionWithSGD, SVMWithSGD
    from pyspark.mllib.regression import LabeledPoint
    df = _toy(spark)
    rdd = df.rdd.map(lambda r: LabeledPoint(r.label, r.features))
    lr = LogisticRegressionWithSGD.train(rdd, iterations=12, step=1.0, miniBatchFraction=1.0,
                                         regParam=0.0, intercept=False)
    ours = linear.fit_sgd(df, "logistic", 3, 12, 1.0, 0.0, 1.0)
    assert ours.weights == pytest.approx(list(lr.weights), rel=1e-9, abs=1e-12)
    svm = SVMWithSGD.train(rdd, iterations=15, step=1.0, regParam=0.01, miniBatchFraction=1.0)
    ours = linear.fit_sgd(df, "hinge", 3, 15, 1.0, 0.01, 1.0)
    assert ours.weights == pytest.approx(list(svm.weights), rel=1e-9, abs=1e-12)


def test_batched_grid_equals_separate_fits(spark):
    df = _toy(spark)
    cfgs = [linear.SgdConfig("logistic", 1.0, 0.0, 0.5), linear.SgdConfig("hinge", 0.5, 0.1, 1.0)]
    many, _ = linear.fit_sgd_many(df, cfgs, 3, [3, 8])
    for c in cfgs:
        for t in (3, 8):
            one = linear.fit_sgd(df, c.kind, 3, t, c.step_size, c.reg_param, c.mini_batch_fraction)
            assert many[(c, t)].weights == pytest.approx(one.weights, rel=1e-12, abs=1e-15)


def test_auc_hard_matches_evaluator_and_one_class(spark):
    rows = [(float(i % 2), float((i // 3) % 2)) for i in range(60)]
    df = spark.createDataFrame(rows, "prediction double, label double")
    ours = evaluate.auc_hard(df).first().auc_hard
    ev = BinaryClassificationEvaluator(rawPredictionCol="prediction", labelCol="label")
    assert ours == pytest.approx(ev.evaluate(df), abs=1e-15)
    one = spark.createDataFrame([(1.0, 1.0), (0.0, 1.0)], "prediction double, label double")
    assert evaluate.auc_hard(one).first().auc_hard is None


def test_rmse_accuracy(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (0.0, 4.0)], "prediction double, label double")
    ours = evaluate.rmse(df).first().rmse
    assert ours == pytest.approx(RegressionEvaluator(metricName="rmse").evaluate(df), rel=1e-12)
    assert evaluate.accuracy(df).first().accuracy == pytest.approx(1 / 3)


def test_pick_best_tie_rules(spark):
    rows = [("grid", 0, 0.7, 1.0), ("grid", 1, 0.9, 2.0), ("grid", 2, 0.9, 3.0)]
    auc = spark.createDataFrame(rows, "sweep string, position int, auc_hard double, v double")
    assert tune.pick_best(auc, "auc_hard").first().position == 2
    rm = spark.createDataFrame(rows, "sweep string, position int, rmse double, v double")
    assert tune.pick_best(rm, "rmse").first().position == 0


def test_tree_depth_limit_and_training_error(spark):
    df = _toy(spark)
    with pytest.raises(ValueError):
        trees.fit_tree(df, max_depth=31)
    errs = []
    for depth in (1, 3, 6):
        m = trees.fit_tree(df, "class", "gini", depth, 16)
        errs.append(1 - evaluate.accuracy(m.transform(df)).first().accuracy)
    assert errs[0] >= errs[1] >= errs[2]


def test_tree_stable_under_repartition(spark):
    df = _toy(spark, n=600)
    preds = []
    for n in (1, 3, 13):
        stable = trees.stable_input(df.repartition(n), ["k"], 4)
        m = trees.fit_tree(stable, "class", "entropy", 4, 5)
        preds.append([r.prediction for r in m.transform(df).orderBy("k").collect()])
    assert preds[0] == preds[1] == preds[2]


def test_models_do_not_depend_on_partitioning(spark):
    df = _toy(spark, n=500)
    base_nb = bayes.fit_naive_bayes(df, 3, 5.0)
    base_lr = linear.fit_sgd(df, "logistic", 3, 6, 1.0, 0.0, 0.5)
    for n in (1, 4, 13):
        d = df.repartition(n)
        nb = bayes.fit_naive_bayes(d, 3, 5.0)
        assert nb.log_prior == pytest.approx(base_nb.log_prior, rel=1e-12)
        for a, b in zip(nb.log_theta, base_nb.log_theta):
            assert a == pytest.approx(b, rel=1e-12)
        lr = linear.fit_sgd(d, "logistic", 3, 6, 1.0, 0.0, 0.5)   # same mini-batches too
        assert lr.weights == pytest.approx(base_lr.weights, rel=1e-9)


def test_empty_frame_fit_errors(spark):
    empty = spark.createDataFrame([], "label double, features array<double>")
    with pytest.raises(ValueError):
        bayes.fit_naive_bayes(empty, 2)


def test_fused_page_naive_bayes_equals_modular(spark):
    from orchard.operators import features as FT
    rows = [(i, ["x", "y", "z"][i % 3], float(i % 7) - 2.0, float(i * 3 % 11), float(i % 2),
             "train" if i % 5 else "test") for i in range(400)]
    df = spark.createDataFrame(rows, "k int, category string, f0 double, f1 double, label double, split string")
    fit = F.col("split") == "train"
    pf, m = bayes.fit_page_naive_bayes(df, ["f0", "f1"], 3.0, fit_on=fit)
    pf2 = FT.fit_page_features(df, ["f0", "f1"], with_mean=False, clamp=True, fit_on=fit)
    assert pf.scaler.std == pytest.approx(pf2.scaler.std, rel=1e-12)
    m2 = bayes.fit_naive_bayes(pf2.transform(df.where(fit)), pf2.dim, 3.0)
    assert m.log_prior == pytest.approx(m2.log_prior, rel=1e-12)
    for a, b in zip(m.log_theta, m2.log_theta):
        assert a == pytest.approx(b, rel=1e-12)


def test_wide_paths_equal_narrow(spark, monkeypatch):
    from orchard.operators import common, features as FT
    df = _toy(spark, n=300)
    nb = bayes.fit_naive_bayes(df, 3, 2.0)
    sc = FT.fit_scaler(df, 3)
    lr = linear.fit_sgd(df, "logistic", 3, 5, 1.0, 0.0, 0.5)
    sv = linear.fit_sgd(df, "hinge", 3, 5, 1.0, 0.1, 1.0)
    pred = [r.prediction for r in lr.transform(df).orderBy("k").collect()]
    monkeypatch.setattr(common, "WIDE_DIM", 2)
    nb2 = bayes.fit_naive_bayes(df, 3, 2.0)
    assert nb2.log_prior == pytest.approx(nb.log_prior, rel=1e-12)
    for a, b in zip(nb2.log_theta, nb.log_theta):
        assert a == pytest.approx(b, rel=1e-12)
    sc2 = FT.fit_scaler(df, 3)
    assert sc2.mean == pytest.approx(sc.mean, rel=1e-12)
    assert sc2.std == pytest.approx(sc.std, rel=1e-12)
    assert linear.fit_sgd(df, "logistic", 3, 5, 1.0, 0.0, 0.5).weights == pytest.approx(lr.weights, rel=1e-9)
    assert linear.fit_sgd(df, "hinge", 3, 5, 1.0, 0.1, 1.0).weights == pytest.approx(sv.weights, rel=1e-9)
    assert [r.prediction for r in lr.transform(df).orderBy("k").collect()] == pred


def test_checkpointed_long_run_equals_cached(spark):
    df = _toy(spark, n=200)
    a = linear.fit_sgd_many(df, [linear.SgdConfig("logistic", 1.0, 0.0, 0.8)], 3, [4],
                            checkpoint=False)[0]
    b = linear.fit_sgd_many(df, [linear.SgdConfig("logistic", 1.0, 0.0, 0.8)], 3, [4],
                            checkpoint=True)[0]
    assert list(a.values())[0].weights == pytest.approx(list(b.values())[0].weights, rel=1e-12)


def test_best_row_of_a_grid_is_its_maximum(spark):
    df = _toy(spark, n=300)
    tr, va = df.where("k % 5 != 0"), df.where("k % 5 = 0")
    res, _ = tune.tune_naive_bayes(tr, va, 3, [0.5, 1.0, 5.0, 50.0])
    best = tune.pick_best(res, "auc_hard").first()
    assert best.auc_hard == max(r.auc_hard for r in res.collect())
    res2, _ = tune.tune_linear(tr, va, "logistic", 3, tune.grid_entries(
        [("num_iterations", [1, 4]), ("step_size", [0.5, 2.0])]))
    assert tune.pick_best(res2, "auc_hard").first().auc_hard == max(r.auc_hard for r in res2.collect())


def test_five_thousand_features_match_mllib(spark):
    import numpy as np
    from pyspark.mllib.classification import LogisticRegressionWithSGD, SVMWithSGD
    from pyspark.mllib.regression import LabeledPoint
    rng = np.random.default_rng(0)
    x = rng.normal(size=(80, 5000)) * 0.05
    y = (x[:, :40].sum(axis=1) > 0).astype(float)
    df = spark.createDataFrame([(i, [float(v) for v in r], float(t)) for i, (r, t) in enumerate(zip(x, y))],
                               "k long, features array<double>, label double")
    odd = spark.createDataFrame([(99, None, 1.0), (98, [1.0], 0.0), (97, [0.0] * 5000, None)], df.schema)
    points = spark.sparkContext.parallelize([LabeledPoint(t, r) for r, t in zip(x, y)], 3)
    for kind, ref in (("logistic", LogisticRegressionWithSGD.train(points, iterations=4, step=2.0, regParam=0.01,
                                                                   regType="l2", validateData=False)),
                      ("hinge", SVMWithSGD.train(points, iterations=4, step=2.0, regParam=0.01, validateData=False))):
        m = linear.fit_sgd(df.unionByName(odd).repartition(5), kind, 5000, 4, 2.0, 0.01)
        assert np.allclose(m.weights, ref.weights.toArray(), atol=1e-9) and np.abs(m.weights).max() > 1e-3
        got = {r.k: r.prediction for r in m.transform(df).collect()}
        assert [got[i] for i in range(80)] == [float(ref.predict(r)) for r in x]
    batch = linear.fit_sgd(df.withColumn("u", (df.k % 10) / 10.0), "logistic", 5000, 3, 1.0, 0.0, 0.5)
    assert np.abs(batch.weights).max() > 0


def test_naive_bayes_with_one_feature_and_null_vectors(spark, monkeypatch):
    from orchard.operators import common
    rows = [([1.0], 0.0), ([3.0], 1.0), ([5.0], 1.0), (None, 0.0), ([1.0, 2.0], 1.0), ([2.0], None)]
    df = spark.createDataFrame(rows, "features array<double>, label double")
    narrow = bayes.fit_stats(df, 1)
    assert narrow == [(0.0, 1, [1.0]), (1.0, 2, [8.0])]
    bayes.fit_naive_bayes(df, 1, 1.0)
    monkeypatch.setattr(common, "WIDE_DIM", 0)
    assert bayes.fit_stats(df, 1) == narrow


@pytest.mark.parametrize("key", ["predict_tree_class", "predict_tree_value"])
def test_registered_trees_do_not_move_with_partitioning(spark, monkeypatch, key):
    from conftest import SF_SMALL
    from orchard.plans.registry import QUERIES
    from orchard.sources import views as V
    name = "binary_big" if key == "predict_tree_class" else "hourly"
    real, seen = getattr(V, name), set()
    for n in (1, 3, 13):
        monkeypatch.setattr(V, name, lambda s, d, n=n: real(s, d).repartition(n))
        rows = QUERIES[key](spark, SF_SMALL).collect()
        seen.add(hash(tuple(sorted(map(str, rows)))))
    assert len(seen) == 1


def test_report_is_written_and_read_back(spark, tmp_path):
    from orchard.sources.sink import write_report
    df = spark.createDataFrame([(1, "url: a ==> evergreen"), (2, "url: b ==> ephemeral")], "doc_id long, line string")
    write_report(df, f"{tmp_path}/report")
    assert sorted(map(tuple, spark.read.parquet(f"{tmp_path}/report").collect())) == sorted(map(tuple, df.collect()))


def test_steps_read_blocks_of_rows_with_every_value_as_it_was(spark):
    """A step scans one row per block, not one per data row; columns of few values are codes."""
    rows = [([float(i % 3), i * 0.1, -0.0, 1.0 / 3], float(i % 2), i / 700) for i in range(600)]
    df = spark.createDataFrame(rows, "features array<double>, label double, u double").coalesce(2)
    blocks = linear._packed(df, 4, "features", "label", "u").collect()
    assert len(blocks) <= 2 and sum(b["n"] for b in blocks) == 600
    got = []
    for b in blocks:
        cols = []
        for held, codes in zip(b["x"], b["codes"]):
            values = np.frombuffer(held)
            cols.append(values[np.frombuffer(codes, np.uint8)] if codes else values)
        got += list(zip(np.stack(cols, 1).tolist(), np.frombuffer(b["y"]).tolist(), np.frombuffer(b["u"], np.int64).tolist()))
    assert any(b["codes"][0] for b in blocks) and not any(b["codes"][1] for b in blocks)
    assert repr(sorted(got)) == repr(sorted((x, y, int(u * 4294967296.0)) for x, y, u in rows))
