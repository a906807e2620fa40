"""Registered queries: trees, recommender and scoring reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from orchard.operators import binning, evaluate, recommend as R, score as S, sparse, trees as TR, tune
from orchard.operators.common import stored
from orchard.operators.split import sample_fraction, split_column
from orchard.plans import prepared as P
from orchard.plans.q_bayes import r6
from orchard.plans.settings import (ALS_PARAMS, LOGISTIC_DEFAULT, NB_LAMBDA, SVM_DEFAULT, TOP_N, TREE_BINARY, TREE_GRID, TREE_MULTI, TREE_REFIT_GRID,
                                    TREE_REG_GRID, TREE_REG_SWEEP_FIXED, TREE_REG_SWEEPS, TREE_REGRESSION,
                                    TREE_SWEEP_FIXED, TREE_SWEEPS)
from orchard.sources import views as V

# A one-split regression tree: few distinct values per hourly feature, so its
# candidate thresholds are all midpoints and SQL can reproduce the fit.
TREE_STUMP = dict(impurity="variance", max_depth=1, max_bins=32)


def _tree(prep, kind, p):
    train = prep.part("train")
    return TR.fit_tree(train, kind, p["impurity"], p["max_depth"], p["max_bins"])


def _binned_tree(rows, dim, p):
    return binning.fit_binned_tree(rows, dim, "class", p["impurity"], p["max_depth"], p["max_bins"])


def _binary_tree(spark, sf):
    """The default class tree over exact-quantile bins."""
    prep = P.binary(spark, sf, scale=False, reuse=True)
    return prep, _binned_tree(prep.part("train"), prep.dim, TREE_BINARY)


def _summary(prep, tm, p, metric):
    valid = tm.transform(prep.part("validation"))
    if metric == "auc_hard":
        m = evaluate.auc_hard(valid)
    elif metric == "accuracy":
        m = evaluate.accuracy(valid)
    else:
        m = evaluate.rmse(valid)
    return m.select(F.lit(p["impurity"]).alias("impurity"),
                    F.lit(p["max_depth"]).alias("max_depth"), F.lit(p["max_bins"]).alias("max_bins"),
                    F.lit(tm.depth).alias("depth"), F.lit(tm.num_nodes).alias("num_nodes"),
                    "n", r6(metric).alias(metric))


def _metric_by_split(prep, tm, metric):
    s = tm.transform(prep.frame.where(F.col("split").isin("validation", "test")))
    by = {"auc_hard": evaluate.auc_hard_by, "accuracy": evaluate.accuracy_by, "rmse": evaluate.rmse_by}[metric]
    return by(s, "split").select("split", "n", r6(metric).alias(metric))


def q_eval_default_tree_binary(spark, sf):
    return _metric_by_split(*_binary_tree(spark, sf), "auc_hard")


def q_eval_default_tree_multi(spark, sf):
    prep = P.multi(spark, sf)
    return _metric_by_split(prep, _tree(prep, "class", TREE_MULTI), "accuracy")


def q_eval_default_tree_value(spark, sf):
    prep = P.hourly(spark, sf)
    return _metric_by_split(prep, _tree(prep, "value", TREE_REGRESSION), "rmse")


def q_fit_tree_binary(spark, sf):
    return _summary(*_binary_tree(spark, sf), TREE_BINARY, "auc_hard")


def q_fit_tree_multi(spark, sf):
    prep = P.multi(spark, sf)
    return _summary(prep, _tree(prep, "class", TREE_MULTI), TREE_MULTI, "accuracy")


def q_fit_tree_regression(spark, sf):
    prep = P.hourly(spark, sf)
    return _summary(prep, _tree(prep, "value", TREE_REGRESSION), TREE_REGRESSION, "rmse")


def q_predict_tree_class(spark, sf):
    prep, tm = _binary_tree(spark, sf)
    return tm.transform(prep.frame).select(*prep.key, "split", "label", "prediction")


def q_predict_tree_value(spark, sf):
    prep = P.hourly(spark, sf)
    tm = _tree(prep, "value", TREE_REGRESSION)
    return tm.transform(prep.frame).select(
        F.date_format("h", "yyyy-MM-dd HH:mm:ss").alias("h"), "split", "label",
        r6("prediction").alias("prediction"))


def q_eval_rmse(spark, sf):
    """RMSE per split of a one-split regression tree on the hourly counts."""
    prep = P.hourly(spark, sf)
    tm = _tree(prep, "value", TREE_STUMP)
    s = tm.transform(prep.frame)
    return evaluate.rmse_by(s, "split").select("split", "n", r6("rmse").alias("rmse"))


def q_eval_abs_error(spark, sf):
    """|label - prediction| per hour for the one-split regression tree (E5)."""
    prep = P.hourly(spark, sf)
    tm = _tree(prep, "value", TREE_STUMP)
    return tm.transform(prep.frame).select(
        F.date_format("h", "yyyy-MM-dd HH:mm:ss").alias("h"), "label",
        r6("prediction").alias("prediction"), r6(evaluate.abs_error()).alias("abs_error"))


def _tree_tune(spark, sf, entries):
    prep = P.binary(spark, sf, scale=False, reuse=True)
    return _tune_columns(_tune_any(prep, "class", entries, "auc_hard"), "auc_hard")


def q_tune_sweep_tree(spark, sf):
    return _tree_tune(spark, sf, tune.sweep_entries(TREE_SWEEP_FIXED, TREE_SWEEPS))


def q_tune_grid_tree(spark, sf):
    return _tree_tune(spark, sf, tune.grid_entries(TREE_GRID))


def _tune_any(prep, kind, entries, metric):
    res, _ = tune.tune_tree(prep.part("train"), prep.part("validation"), kind, entries, metric)
    return res


def _tune_columns(res, metric):
    return res.select("sweep", "position", "impurity", "max_depth", "max_bins", r6(metric).alias(metric))


def q_tune_sweep_tree_multi(spark, sf):
    entries = tune.sweep_entries(TREE_SWEEP_FIXED, TREE_SWEEPS)
    return _tune_columns(_tune_any(P.multi(spark, sf), "class", entries, "accuracy"), "accuracy")


def q_tune_grid_tree_multi(spark, sf):
    return _tune_columns(_tune_any(P.multi(spark, sf), "class", tune.grid_entries(TREE_GRID), "accuracy"), "accuracy")


def q_tune_sweep_tree_value(spark, sf):
    entries = tune.sweep_entries(TREE_REG_SWEEP_FIXED, TREE_REG_SWEEPS)
    return _tune_columns(_tune_any(P.hourly(spark, sf), "value", entries, "rmse"), "rmse")


def q_tune_grid_tree_value(spark, sf):
    return _tune_columns(_tune_any(P.hourly(spark, sf), "value", tune.grid_entries(TREE_REG_GRID), "rmse"), "rmse")


def q_tune_pick_best_rmse(spark, sf):
    """One-split trees that differ in max_bins only are equal: the first of them wins."""
    entries = [dict(TREE_STUMP, max_bins=b, sweep="max_bins") for b in (32, 50, 100)]
    best = tune.pick_best(_tune_any(P.hourly(spark, sf), "value", entries, "rmse"), "rmse")
    return best.select("position", "max_depth", "max_bins", r6("rmse").alias("rmse"))


def q_tune_refit_tree_value(spark, sf):
    """Best one-split tree, refitted on train and validation, RMSE on test."""
    prep = P.hourly(spark, sf)
    entries = [dict(TREE_STUMP, max_bins=b, sweep="max_bins") for b in (32, 50, 100)]
    best = tune.pick_best(_tune_any(prep, "value", entries, "rmse"), "rmse").first()
    tm = TR.fit_tree(prep.train_validation(), "value", best["impurity"], best["max_depth"], best["max_bins"])
    return evaluate.rmse(tm.transform(prep.part("test"))).select(
        F.lit(best["max_bins"]).alias("max_bins"), "n", r6("rmse").alias("rmse"))


def q_tune_refit_tree_binary(spark, sf):
    """Best class tree of a small grid, refitted on train and validation, AUC on test."""
    prep = P.binary(spark, sf, scale=False, reuse=True)
    entries, bins = tune.grid_entries(TREE_REFIT_GRID), TREE_BINARY["max_bins"]
    thresholds = binning.quantile_thresholds(prep.part("train"), bins)
    binned = prep.frame.withColumn("features", binning.bin_col("features", thresholds, prep.dim))
    res, _ = tune.tune_tree(binned.where("split = 'train'"), binned.where("split = 'validation'"), "class", entries, "auc_hard")
    best = tune.pick_best(res, "auc_hard").first()
    tm = _binned_tree(prep.train_validation(), prep.dim, best)
    return evaluate.auc_hard(tm.transform(prep.part("test"))).select(
        *[F.lit(best[c]).alias(c) for c in ("position", "impurity", "max_depth")], "n", r6("auc_hard").alias("auc_hard"))


def q_score_land_sample(spark, sf):
    prep = P.multi(spark, sf)
    tm = _tree(prep, "class", TREE_MULTI)
    sample = sample_fraction(V.multi(spark, sf), F.col("vec_id"), 0.1)
    return S.land_report(tm.transform(sample), 20)


def q_score_hourly_report(spark, sf):
    prep = P.hourly(spark, sf)
    tm = _tree(prep, "value", TREE_REGRESSION)
    return S.hourly_report(tm.transform(prep.frame), 200)


def q_score_new_pages(spark, sf):
    ids = V.first_ids(V.unlabelled_ids(spark, sf), 10)
    prep, m = P.page_naive_bayes(spark, sf, NB_LAMBDA, score_ids=ids)
    return S.score_new_pages(m.transform(prep.score), 10)


def _score_new_with(spark, sf, kind):
    ids = V.first_ids(V.unlabelled_ids(spark, sf), 10)
    prep = P.pages(spark, sf, nb=False, score_ids=ids)
    p = LOGISTIC_DEFAULT if kind == "logistic" else SVM_DEFAULT
    m = sparse.fit_sparse_sgd(prep.part("train"), prep.features, kind, p["num_iterations"], p["step_size"],
                              p.get("reg_param", 0.0), p.get("mini_batch_fraction", 1.0))
    return S.score_new_pages(m.transform(prep.score), 10)


def q_score_new_pages_logistic(spark, sf):
    return _score_new_with(spark, sf, "logistic")


def q_score_new_pages_svm(spark, sf):
    return _score_new_with(spark, sf, "hinge")


def q_score_new_pages_tree(spark, sf):
    ids = V.first_ids(V.unlabelled_ids(spark, sf), 20)
    prep = P.pages(spark, sf, nb=False, score_ids=ids)
    p = TREE_BINARY
    m = TR.fit_sparse_tree(prep.part("train"), prep.features, "class", p["impurity"], p["max_depth"], p["max_bins"])
    return S.score_new_pages(m.transform(prep.score), 20)


def q_report_labelled_topn(spark, sf):
    ids = V.first_ids(V.labelled_ids(spark, sf).where(split_column(F.col("doc_id")) == "test"), 50)
    prep, m = P.page_naive_bayes(spark, sf, NB_LAMBDA)
    return S.labelled_report(m.transform(prep.part("test").join(F.broadcast(ids), "doc_id", "left_semi")),
                             ["doc_id"], 50)


def q_report_labelled_values(spark, sf):
    """First 50 hours with features, truth, prediction and absolute error (X9 for values)."""
    prep = P.hourly(spark, sf)
    s = S.labelled_report(_tree(prep, "value", TREE_STUMP).transform(prep.frame), ["h"], 50,
                          [F.array_join(F.transform("features", lambda v: F.round(v, 3).cast("string")), " ").alias("shown"),
                           r6(evaluate.abs_error()).alias("abs_error")])
    return s.select(F.date_format("h", "yyyy-MM-dd HH:mm:ss").alias("h"), "shown", "label",
                    r6("prediction").alias("prediction"), "abs_error")


# ---- recommender ------------------------------------------------------------------------

def _als(spark, sf):
    ratings = stored(V.ratings(spark, sf))          # the fit, requests and predictions all read them
    return ratings, R.fit_als(ratings, **ALS_PARAMS)


def q_fit_als(spark, sf):
    ratings, model = _als(spark, sf)
    pred = R.predict_pairs(model, ratings)
    e = F.col("prediction") - F.col("rating")
    fit = pred.agg(F.count(F.lit(1)).alias("n_ratings"), r6(F.sqrt(F.avg(e * e))).alias("train_rmse"))
    return fit.select(F.lit(model.rank).alias("rank"),
                      F.lit(model.userFactors.count()).alias("n_user_factors"),
                      F.lit(model.itemFactors.count()).alias("n_item_factors"),
                      "n_ratings", "train_rmse")


def q_als_predict_pair(spark, sf):
    ratings, model = _als(spark, sf)
    return R.predict_pairs(model, ratings).select("user_id", "item_id", "rating",
                                                  r6("prediction").alias("prediction"))


def _requests(ratings, key):
    """The ids asked for: those divisible by 20, against all of the other side."""
    return ratings.where(F.col(key) % 20 == 0).select(key).distinct()


def _items_for_users(spark, sf):
    ratings, model = _als(spark, sf)
    return model, R.items_for_users(model, _requests(ratings, "user_id"), TOP_N)


def _users_for_items(spark, sf):
    ratings, model = _als(spark, sf)
    return model, R.users_for_items(model, _requests(ratings, "item_id"), TOP_N)


def q_rec_items_for_user(spark, sf):
    recs = R.with_titles(_items_for_users(spark, sf)[1], V.titles(spark, sf))
    return recs.select("user_id", "rank", "item_id", "title", r6("score").alias("score"))


def q_rec_users_for_item(spark, sf):
    recs = R.with_titles(_users_for_items(spark, sf)[1], V.titles(spark, sf))
    return recs.select("item_id", "title", "rank", "user_id", r6("score").alias("score"))


def q_rec_items_for_user_checks(spark, sf):
    model, recs = _items_for_users(spark, sf)
    return R.check_recommendations(recs, model, "user_id", TOP_N)


def q_rec_users_for_item_checks(spark, sf):
    model, recs = _users_for_items(spark, sf)
    return R.check_recommendations(recs, model, "item_id", TOP_N)


def q_fit_als_checks(spark, sf):
    """Rank, one factor vector per user and item seen, finite predictions on the ratings."""
    ratings, model = _als(spark, sf)
    pred = R.predict_pairs(model, ratings)
    ok = ~F.isnan("prediction") & (F.abs("prediction") < float("inf"))
    sized = lambda f: f.agg(F.count(F.lit(1)).alias("n"), F.min(F.size("features")).alias("lo"),
                            F.max(F.size("features")).alias("hi")).first()
    u, i = sized(model.userFactors), sized(model.itemFactors)
    return pred.agg(F.count(F.lit(1)).alias("n_ratings"), F.count_if(ok).alias("n_finite")).select(
        F.lit(u["n"]).cast("long").alias("n_users"), F.lit(i["n"]).cast("long").alias("n_items"), "n_ratings", "n_finite",
        *[F.lit(v).alias(c) for c, v in (("user_rank_min", u["lo"]), ("user_rank_max", u["hi"]),
                                         ("item_rank_min", i["lo"]), ("item_rank_max", i["hi"]))])


def q_als_predict_pair_checks(spark, sf):
    """Every rating's prediction against the product of its two factor vectors."""
    ratings, model = _als(spark, sf)
    u = model.userFactors.select(F.col("id").alias("user_id"), F.col("features").alias("uf"))
    i = model.itemFactors.select(F.col("id").alias("item_id"), F.col("features").alias("vf"))
    # in the order of the predictions' own joins, so that the ratings move once for each side
    pred = R.predict_pairs(model, ratings.join(u, "user_id")).withColumn("score", F.col("prediction"))
    dot = F.aggregate(F.zip_with("uf", "vf", lambda a, b: a.cast("double") * b.cast("double")), F.lit(0.0),
                      lambda acc, v: acc + v)
    return pred.join(i, "item_id").select(
        "user_id", "item_id", "rating", (F.abs(dot - F.col("score")) < 1e-4).alias("is_product"))


TREE_ALS_QUERIES = {k[2:]: v for k, v in globals().items() if k.startswith("q_")}
