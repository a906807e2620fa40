"""Registered queries: linear SGD models, naive Bayes tuning, choosing and refitting."""

from __future__ import annotations

from pyspark.sql import functions as F

from orchard.operators import bayes, evaluate, linear, tune
from orchard.plans import prepared as P
from orchard.plans.q_bayes import r6
from orchard.plans.settings import (LOGISTIC_DEFAULT, LOGISTIC_GRID, LOGISTIC_SWEEP_FIXED,
                                    LOGISTIC_SWEEPS, NB_LAMBDAS, SVM_DEFAULT, SVM_GRID, SVM_HISTORIC,
                                    SVM_SWEEP_FIXED, SVM_SWEEPS)

TUNE_COLS = ["sweep", "position", "num_iterations", "step_size", "reg_param",
             "mini_batch_fraction"]


def _binary(spark, sf):
    # several passes follow (fit, then scoring): the joined view is written once
    return P.binary(spark, sf, nb=False, reuse=True)


def _fit_linear(spark, sf, kind):
    prep = _binary(spark, sf)
    train = prep.part("train")
    p = LOGISTIC_DEFAULT if kind == "logistic" else SVM_DEFAULT
    m = linear.fit_sgd(train, kind, prep.dim, p["num_iterations"], p["step_size"],
                       p.get("reg_param", 0.0), p.get("mini_batch_fraction", 1.0))
    return prep, m


def _weights_frame(spark, m):
    df = spark.createDataFrame([(j, float(w)) for j, w in enumerate(m.weights)],
                               "j int, weight double")
    return df.select("j", r6("weight").alias("weight"))


def q_fit_logistic_sgd(spark, sf):
    return _weights_frame(spark, _fit_linear(spark, sf, "logistic")[1])


def q_fit_svm_sgd(spark, sf):
    return _weights_frame(spark, _fit_linear(spark, sf, "hinge")[1])


def q_fit_svm_historic(spark, sf):
    """Three steps with the historic step and regularisation (which diverge when run on)."""
    prep = _binary(spark, sf)
    p = dict(SVM_HISTORIC, num_iterations=3)
    return _weights_frame(spark, linear.fit_sgd(prep.part("train"), "hinge", prep.dim, p["num_iterations"],
                                                p["step_size"], p["reg_param"]))


def _default_run(spark, sf, kind):
    prep, m = _fit_linear(spark, sf, kind)
    rest = prep.frame.where(F.col("split").isin("validation", "test"))
    return evaluate.auc_hard_by(m.transform(rest), "split").select("split", "n", r6("auc_hard").alias("auc_hard"))


def q_eval_default_logistic(spark, sf):
    return _default_run(spark, sf, "logistic")


def q_eval_default_svm(spark, sf):
    return _default_run(spark, sf, "hinge")


def _refit(spark, sf, kind, grid):
    """Best of a grid on validation, refitted on train and validation, measured on test."""
    prep = _binary(spark, sf)
    res, _ = tune.tune_linear(prep.part("train"), prep.part("validation"), kind, prep.dim, tune.grid_entries(grid))
    best = tune.pick_best(res, "auc_hard").first()
    m = linear.fit_sgd(prep.train_validation(), kind, prep.dim, best["num_iterations"], best["step_size"],
                       best["reg_param"], best["mini_batch_fraction"])
    auc = evaluate.auc_hard(m.transform(prep.part("test")))
    return auc.select(*[F.lit(best[c]).alias(c) for c in TUNE_COLS[2:]], "n", r6("auc_hard").alias("auc_hard"))


def q_tune_refit_logistic(spark, sf):
    return _refit(spark, sf, "logistic", LOGISTIC_GRID)


def q_tune_refit_svm(spark, sf):
    return _refit(spark, sf, "hinge", SVM_GRID)


def q_predict_logistic(spark, sf):
    prep, m = _fit_linear(spark, sf, "logistic")
    return m.transform(prep.frame).select(*prep.key, "split", "label", "prediction")


def q_predict_svm(spark, sf):
    prep, m = _fit_linear(spark, sf, "hinge")
    return m.transform(prep.frame).select(*prep.key, "split", "label", "prediction")


def _tune_linear(spark, sf, kind, entries):
    prep = _binary(spark, sf)
    train, valid = prep.part("train"), prep.part("validation")
    res, _ = tune.tune_linear(train, valid, kind, prep.dim, entries)
    return res.select(*TUNE_COLS, r6("auc_hard").alias("auc_hard"))


def q_tune_sweep_logistic(spark, sf):
    return _tune_linear(spark, sf, "logistic",
                        tune.sweep_entries(LOGISTIC_SWEEP_FIXED, LOGISTIC_SWEEPS))


def q_tune_grid_logistic(spark, sf):
    return _tune_linear(spark, sf, "logistic", tune.grid_entries(LOGISTIC_GRID))


def q_tune_sweep_svm(spark, sf):
    return _tune_linear(spark, sf, "hinge", tune.sweep_entries(SVM_SWEEP_FIXED, SVM_SWEEPS))


def q_tune_grid_svm(spark, sf):
    return _tune_linear(spark, sf, "hinge", tune.grid_entries(SVM_GRID))


def _nb_results(spark, sf, sweep):
    """Fused one-scan fit of dictionary, scaler and class statistics, then all
    smoothing values scored on the validation split in a second scan."""
    from orchard.operators.split import assign_split
    from orchard.sources import views as V
    bb = assign_split(V.binary_big(spark, sf), V.binary_key())
    pf, stats = bayes.fit_page_stats(bb, V.BINARY_NUMERIC, fit_on=F.col("split") == "train")
    feats = pf.transform(bb).withColumn("label", F.col("label").cast("double"))
    prep = P.Prepared(feats.select(*V.BINARY_KEY, "label", "features", "split"), pf, pf.dim,
                      list(V.BINARY_KEY))
    res, models = tune.tune_naive_bayes(None, prep.part("validation"), prep.dim, NB_LAMBDAS,
                                        sweep, stats=stats)
    return prep, res, models


def q_tune_sweep_nb(spark, sf):
    _, res, _ = _nb_results(spark, sf, "lambda")
    return res.select("sweep", "position", "smoothing", r6("auc_hard").alias("auc_hard"))


def q_tune_grid_nb(spark, sf):
    _, res, _ = _nb_results(spark, sf, "grid")
    return res.select("sweep", "position", "smoothing", r6("auc_hard").alias("auc_hard"))


def q_tune_pick_best(spark, sf):
    _, res, _ = _nb_results(spark, sf, "grid")
    return tune.pick_best(res, "auc_hard").select("position", "smoothing",
                                                  r6("auc_hard").alias("auc_hard"))


def q_sort_by_metric(spark, sf):
    _, res, _ = _nb_results(spark, sf, "grid")
    return tune.sort_by_metric(res, "auc_hard").select("rank", "position", "smoothing",
                                                       r6("auc_hard").alias("auc_hard"))


def q_tune_refit_best(spark, sf):
    """Best lambda on validation, refit on train + validation, AUC on test."""
    prep, res, _ = _nb_results(spark, sf, "grid")
    best = tune.pick_best(res, "auc_hard").first()
    m = bayes.fit_naive_bayes(prep.train_validation(), prep.dim, best["smoothing"])
    auc = evaluate.auc_hard(m.transform(prep.part("test")))
    return auc.select(F.lit(float(best["smoothing"])).alias("smoothing"), "n",
                      r6("auc_hard").alias("auc_hard"))


LINEAR_QUERIES = {k[2:]: v for k, v in globals().items() if k.startswith("q_")}
