"""The seven workflows as functions over their input files.

Each returns a dict of DataFrames instead of printing: split counts, the
validation / test metric, the tuning table (when ``tune=True``) and the
scoring report.  Everything underneath is the library's operators, so the
same code runs on a laptop file or a cluster-sized folder of files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orchard.functions.hashing import md5_unit
from orchard.operators import evaluate, recommend as R, score as S, sparse, trees, tune
from orchard.operators.common import persisted
from orchard.operators.split import assign_split, sample_fraction, split_counts
from orchard.plans import settings as P
from orchard.sources import text as TX

def _named_numbers(df: DataFrame, n: int) -> DataFrame:
    return df.select(*[c for c in df.columns if c != "numeric"],
                     *[F.col("numeric").getItem(j).alias(f"n{j}") for j in range(n)])


def _metric_rows(scored: DataFrame, metric: str) -> DataFrame:
    fn = {"auc_hard": evaluate.auc_hard, "accuracy": evaluate.accuracy, "rmse": evaluate.rmse}[metric]
    parts = [fn(scored.where(F.col("split") == s)).select(F.lit(s).alias("split"), "*")
             for s in ("validation", "test")]
    return parts[0].unionByName(parts[1])


def page_classifier(spark: SparkSession, train_path: str, score_path: str,
                    model: str = "naive_bayes", tune_params: bool = False,
                    n_show: int | None = None) -> dict[str, DataFrame]:
    """Evergreen / ephemeral pages: naive Bayes, logistic SGD, SVM SGD or a tree.

    The category column may have any number of values (``orchard.operators.sparse``).  Lines that
    are no page, or hold another number of values than most, are in ``rejects`` with the reason.
    """
    if model not in ("naive_bayes", "logistic", "svm", "tree"):
        raise ValueError(f"unknown model {model!r}")
    lines = TX.read_delimited_with_header(spark, train_path, TX.TAB)
    n = TX.usual_numbers(TX.parse_pages(lines, mode="permissive"), "numeric")
    lab, rejects, _ = TX.split_rejects(TX.check_pages(lines, True, numbers=n))
    new, new_rejects, _ = TX.split_rejects(TX.check_pages(
        TX.read_delimited_with_header(spark, score_path, TX.TAB), False, numbers=n))
    lab = assign_split(_named_numbers(lab, n), F.col("url"))
    lab = lab.withColumn("u", md5_unit(F.col("url")))
    new = _named_numbers(new, n)
    fit = F.col("split") == "train"
    nb = model == "naive_bayes"
    pages = sparse.fit_sparse_pages(lab, [f"n{j}" for j in range(n)], fit_on=fit, centred=not nb, clamp=nb)
    feats = pages.transform(lab).withColumn("label", F.col("label").cast("double"))
    tr, va = feats.where(fit), feats.where(F.col("split") == "validation")
    both = feats.where(F.col("split").isin("train", "validation"))
    tuning = sweeps = None
    if nb:
        stats = sparse.fit_sparse_stats(tr, pages)
        m = stats.model(P.NB_LAMBDA)
        if tune_params:
            sweeps, _ = tune.tune_sparse_naive_bayes(stats, va, P.NB_LAMBDAS, "lambda")
            tuning, _ = tune.tune_sparse_naive_bayes(stats, va, P.NB_LAMBDAS, "grid")
            best = tune.pick_best(tuning, "auc_hard").first()
            m = sparse.fit_sparse_naive_bayes(both, pages, best["smoothing"])
    elif model == "tree":
        p = P.TREE_BINARY
        if tune_params:
            rows, check = pages.vectors(trees.stable_input(tr), out="features"), pages.vectors(va, out="features")
            sweeps, _ = tune.tune_tree(rows, check, "class", tune.sweep_entries(
                P.TREE_SWEEP_FIXED, P.TREE_SWEEPS), "auc_hard")
            tuning, _ = tune.tune_tree(rows, check, "class", tune.grid_entries(P.TREE_GRID), "auc_hard")
            p, tr = tune.pick_best(tuning, "auc_hard").first().asDict(), both
        m = trees.fit_sparse_tree(tr, pages, "class", p["impurity"], int(p["max_depth"]), int(p["max_bins"]))
    else:
        kind = "logistic" if model == "logistic" else "hinge"
        p = P.LOGISTIC_DEFAULT if model == "logistic" else P.SVM_DEFAULT
        if tune_params:
            grid = P.LOGISTIC_GRID if model == "logistic" else P.SVM_GRID
            fixed, lists = ((P.LOGISTIC_SWEEP_FIXED, P.LOGISTIC_SWEEPS) if model == "logistic"
                            else (P.SVM_SWEEP_FIXED, P.SVM_SWEEPS))
            sweeps, _ = tune.tune_sparse_linear(tr, va, pages, kind, tune.sweep_entries(fixed, lists))
            tuning, _ = tune.tune_sparse_linear(tr, va, pages, kind, tune.grid_entries(grid))
            p, tr = tune.pick_best(tuning, "auc_hard").first().asDict(), both
        m = sparse.fit_sparse_sgd(tr, pages, kind, int(p["num_iterations"]), p["step_size"],
                                  p.get("reg_param", 0.0), p.get("mini_batch_fraction", 1.0))
    return {
        "counts": split_counts(lab),
        "evaluation": _metric_rows(m.transform(feats), "auc_hard"),
        "sweeps": sweeps,
        "tuning": tuning,
        "predictions": S.score_new_pages(m.transform(pages.transform(new)),
                                         n_show or (20 if model == "tree" else 10), key="url"),
        "rejects": rejects.unionByName(new_rejects),
    }


def land_cover(spark: SparkSession, path: str, tune_params: bool = False) -> dict[str, DataFrame]:
    """Seven land-cover classes from all-numeric comma lines, with a tree."""
    lines = TX.read_lines(spark, path)
    n = TX.usual_numbers(TX.parse_numeric(lines, mode="permissive"), "features")
    raw, rejects, _ = TX.split_rejects(TX.check_numeric(lines, keep=("value",), numbers=n))
    data = assign_split(raw.withColumn("vec_id", F.xxhash64("value")), F.col("value"))
    tr, va = data.where(F.col("split") == "train"), data.where(F.col("split") == "validation")
    p, tuning, sweeps = P.TREE_MULTI, None, None
    with persisted(tr, va):
        if tune_params:
            sweeps, _ = tune.tune_tree(tr, va, "class", tune.sweep_entries(
                P.TREE_SWEEP_FIXED, P.TREE_SWEEPS), "accuracy")
            tuning, _ = tune.tune_tree(tr, va, "class", tune.grid_entries(P.TREE_GRID),
                                       "accuracy")
            p = tune.pick_best(tuning, "accuracy").first().asDict()
            tr = data.where(F.col("split").isin("train", "validation"))
        m = trees.fit_tree(tr, "class", p["impurity"], int(p["max_depth"]), int(p["max_bins"]))
    sample = sample_fraction(data, F.col("value"), 0.1)
    return {"counts": split_counts(data), "evaluation": _metric_rows(m.transform(data), "accuracy"),
            "sweeps": sweeps, "tuning": tuning, "predictions": S.land_report(m.transform(sample), 20),
            "rejects": rejects}


def hourly_rentals(spark: SparkSession, path: str, tune_params: bool = False) -> dict[str, DataFrame]:
    """Hourly counts with a regression tree; report decodes each hour's fields."""
    from orchard.sources.views import HOURLY_FEATURES
    lines = TX.read_delimited_with_header(spark, path, ",")
    f = F.split("value", ",", -1)
    parsed, rejects, _ = TX.split_rejects(TX.check_hourly(lines, keep=(
        f.getItem(0).cast("long").alias("instant"), f.getItem(1).alias("day"))))
    parsed = parsed.select("*", *[F.col("features").getItem(i).alias(c)
                                  for i, c in enumerate(HOURLY_FEATURES)])
    data = assign_split(parsed, F.col("instant"))
    tr, va = data.where(F.col("split") == "train"), data.where(F.col("split") == "validation")
    p, tuning, sweeps = P.TREE_REGRESSION, None, None
    with persisted(tr, va):
        if tune_params:
            sweeps, _ = tune.tune_tree(tr, va, "value", tune.sweep_entries(
                P.TREE_REG_SWEEP_FIXED, P.TREE_REG_SWEEPS), "rmse")
            tuning, _ = tune.tune_tree(tr, va, "value", tune.grid_entries(P.TREE_REG_GRID), "rmse")
            p = tune.pick_best(tuning, "rmse").first().asDict()
            tr = data.where(F.col("split").isin("train", "validation"))
        m = trees.fit_tree(tr, "value", p["impurity"], int(p["max_depth"]), int(p["max_bins"]))
    scored = m.transform(data).withColumn("h", F.to_timestamp(
        F.concat(F.col("day"), F.lit(" "), F.lpad(F.col("hr").cast("int").cast("string"), 2, "0")),
        "yyyy-MM-dd HH"))
    return {"counts": split_counts(data), "evaluation": _metric_rows(m.transform(data), "rmse"),
            "sweeps": sweeps, "tuning": tuning, "predictions": S.hourly_report(scored, 200), "rejects": rejects}


def recommender(spark: SparkSession, ratings_path: str, titles_path: str,
                users: DataFrame | None = None, items: DataFrame | None = None,
                n: int = 10) -> dict[str, DataFrame]:
    """Rating statistics, ALS (rank 5, 20 iterations, reg 0.1) and top-n lists."""
    ratings, rejects, _ = TX.split_rejects(TX.check_ratings(TX.read_lines(spark, ratings_path)))
    titles = TX.read_titles(spark, titles_path)
    model = R.fit_als(ratings, rank=5, max_iter=20, reg_param=0.1)
    return {"stats": R.rating_stats(ratings),
            "items_for_users": R.items_for_users(model, users, n, titles),
            "users_for_items": R.users_for_items(model, items, n, titles), "rejects": rejects}
