"""Parameter sweeps and grids.

Results are DataFrames with one row per configuration, in the order the
configurations were listed (``position``).  Linear models of a whole grid
are trained together (one scan per step for all configs) and every model of
a grid is scored on the validation rows in one scan.  Naive Bayes computes
its statistics once for all smoothing values.  Trees of all depths are cut from
the deepest one; those that differ in impurity or bins are fitted concurrently on one cached
frame.
"""

from __future__ import annotations

import itertools
from concurrent.futures import ThreadPoolExecutor
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orchard.operators import bayes, evaluate, linear, nested, trees
from orchard.operators.common import join_small, persisted

HIGHER_IS_BETTER = {"auc_hard": True, "accuracy": True, "rmse": False}


# ---- what to run ---------------------------------------------------------------

def sweep_entries(fixed: dict, sweeps: Sequence[tuple[str, Sequence]]) -> list[dict]:
    """One entry per value of each swept parameter, the others at ``fixed``."""
    out = []
    for name, values in sweeps:
        for v in values:
            e = dict(fixed)
            e[name] = v
            e["sweep"] = name
            out.append(e)
    return out


def grid_entries(grid: Sequence[tuple[str, Sequence]]) -> list[dict]:
    """Full product, first parameter outermost (the listing order)."""
    names = [n for n, _ in grid]
    return [dict(zip(names, combo), sweep="grid")
            for combo in itertools.product(*[v for _, v in grid])]


def _result_frame(spark: SparkSession, entries: list[dict], metric: str,
                  values: list, fit_ms: list, columns: Sequence[tuple[str, str]]) -> DataFrame:
    rows = []
    for pos, (e, m, ms) in enumerate(zip(entries, values, fit_ms)):
        rows.append((e["sweep"], pos, *[e[c] for c, _ in columns],
                     None if m is None else float(m), float(ms)))
    schema = ", ".join(["sweep string", "position int"] + [f"{c} {t}" for c, t in columns]
                       + [f"{metric} double", "fit_ms double"])
    return spark.createDataFrame(rows, schema)


# ---- linear (SGD) ---------------------------------------------------------------

LINEAR_COLUMNS = [("num_iterations", "int"), ("step_size", "double"), ("reg_param", "double"),
                  ("mini_batch_fraction", "double")]


def _cfg(kind: str, e: dict) -> linear.SgdConfig:
    return linear.SgdConfig(kind, float(e["step_size"]), float(e.get("reg_param", 0.0)),
                            float(e.get("mini_batch_fraction", 1.0)))


def tune_linear(train: DataFrame, valid: DataFrame, kind: str, dim: int,
                entries: list[dict]) -> tuple[DataFrame, dict]:
    """Fit every entry (batched), score all on ``valid`` in one scan."""
    for e in entries:
        e.setdefault("reg_param", 0.0)
        e.setdefault("mini_batch_fraction", 1.0)
    cfgs = list(dict.fromkeys(_cfg(kind, e) for e in entries))
    marks = sorted({int(e["num_iterations"]) for e in entries})
    models, took = linear.fit_sgd_many(train, cfgs, dim, marks)
    keyed = {i: models[(_cfg(kind, e), int(e["num_iterations"]))] for i, e in enumerate(entries)}
    preds = {str(i): m.predict_col("features") for i, m in keyed.items()}
    metric = evaluate.metric_many(valid, preds, "auc_hard")
    values = [metric[str(i)] for i in range(len(entries))]
    spark = train.sparkSession
    # configurations run side by side: a row's time is that until its last step
    ms = [took[int(e["num_iterations"])] for e in entries]
    return _result_frame(spark, entries, "auc_hard", values, ms, LINEAR_COLUMNS), keyed


# ---- naive Bayes -------------------------------------------------------------------

def tune_naive_bayes(train: DataFrame | None, valid: DataFrame, dim: int,
                     lambdas: Sequence[float], sweep: str = "lambda",
                     stats: list | None = None) -> tuple[DataFrame, dict]:
    """Statistics once (or given), one model per lambda, all scored in one scan."""
    import time
    t0 = time.perf_counter()
    if stats is None:
        stats = bayes.fit_stats(train, dim)
    shared, models, ms = (time.perf_counter() - t0) * 1000.0, {}, []
    for i, lam in enumerate(lambdas):       # the statistics' time, then each model's own
        t0 = time.perf_counter()
        models[i] = bayes.model_from_stats(stats, lam)
        ms.append(shared + (time.perf_counter() - t0) * 1000.0)
    metric = evaluate.metric_many(valid, {str(i): m.predict_col() for i, m in models.items()},
                                  "auc_hard")
    entries = [{"sweep": sweep, "smoothing": float(lam)} for lam in lambdas]
    return (_result_frame(valid.sparkSession, entries, "auc_hard",
                          [metric[str(i)] for i in range(len(lambdas))], ms,
                          [("smoothing", "double")]), models)


# ---- page models, categories as a table -------------------------------------------------

def tune_sparse_linear(train: DataFrame, valid: DataFrame, pages, kind: str,
                       entries: list[dict]) -> tuple[DataFrame, dict]:
    """``tune_linear`` over transformed rows of a ``sparse.SparsePages``."""
    from orchard.operators import sparse
    for e in entries:
        e.setdefault("reg_param", 0.0)
        e.setdefault("mini_batch_fraction", 1.0)
    cfgs = list(dict.fromkeys(_cfg(kind, e) for e in entries))
    marks = sorted({int(e["num_iterations"]) for e in entries})
    models, took = sparse.fit_sparse_sgd_many(train, pages, cfgs, marks)
    keyed = {i: models[(_cfg(kind, e), int(e["num_iterations"]))] for i, e in enumerate(entries)}
    scored, preds = sparse.predict_sparse_many(valid.select("slot", "z", "label"), pages,
                                               {str(i): m for i, m in keyed.items()})
    metric = evaluate.metric_many(scored, preds, "auc_hard")
    values = [metric[str(i)] for i in range(len(entries))]
    ms = [took[int(e["num_iterations"])] for e in entries]
    return _result_frame(train.sparkSession, entries, "auc_hard", values, ms, LINEAR_COLUMNS), keyed


def tune_sparse_naive_bayes(stats, valid: DataFrame, lambdas: Sequence[float],
                            sweep: str = "lambda") -> tuple[DataFrame, dict]:
    """One model per lambda from ``sparse.fit_sparse_stats``, all scored in one scan of ``valid``."""
    import time
    models, ms = {}, []
    for i, lam in enumerate(lambdas):
        t0 = time.perf_counter()
        models[i] = stats.model(lam)
        ms.append((time.perf_counter() - t0) * 1000.0)
    preds = {str(i): m.predict_col(F.col("__s"), F.col("__c")) for i, m in models.items()}
    metric = evaluate.metric_many(models[0].attach(valid), preds, "auc_hard")
    entries = [{"sweep": sweep, "smoothing": float(lam)} for lam in lambdas]
    return (_result_frame(valid.sparkSession, entries, "auc_hard", [metric[str(i)] for i in range(len(lambdas))], ms,
                          [("smoothing", "double")]), models)


# ---- trees ----------------------------------------------------------------------------

TREE_COLUMNS = [("impurity", "string"), ("max_depth", "int"), ("max_bins", "int")]


def tune_tree(train: DataFrame, valid: DataFrame, kind: str, entries: list[dict],
              metric: str, parallelism: int | None = None) -> tuple[DataFrame, dict]:
    """One fit for each impurity and bin count, at the largest depth asked for; smaller depths are
    cut from it (G1, G5).  The fits run concurrently, as many as a quarter of the cluster's
    cores (at least four) unless given; one scan scores all entries.  ``fit_ms`` is the
    time of the fit that an entry is cut from."""
    if isinstance(train.schema["features"].dataType, trees.VectorUDT):
        rows = train.select("features", F.col("label").cast("double").alias("label"))
    else:           # one order of the rows for all fits, kept while they run
        rows = trees.stable_input(train.select("features", F.col("label").cast("double").alias("label")))
    deepest: dict[tuple[str, int], int] = {}
    for e in entries:
        key = (e["impurity"], int(e["max_bins"]))
        deepest[key] = max(deepest.get(key, 0), int(e["max_depth"]))

    def fit(item):
        (impurity, bins), depth = item
        return trees.fit_tree(rows, kind, impurity, depth, bins, cache=False, stable=False)
    n = parallelism or max(4, train.sparkSession.sparkContext.defaultParallelism // 4)
    with persisted(rows), ThreadPoolExecutor(max_workers=n) as pool:
        fitted = dict(zip(deepest, pool.map(fit, deepest.items())))
    tables = {key: nested.node_table(m, train.sparkSession) for key, m in fitted.items()}
    leaf = {key: f"__leaf{i}" for i, key in enumerate(fitted)}
    scored = nested.with_leaves(valid, {leaf[key]: m for key, m in fitted.items()})
    models, cols = {}, {}
    for i, e in enumerate(entries):
        key = (e["impurity"], int(e["max_bins"]))
        models[str(i)] = nested.CutTree(fitted[key], tables[key], int(e["max_depth"]))
    for key, name in leaf.items():      # a table of all depths' predictions: a literal per entry takes a call per leaf
        mine = [i for i, e in enumerate(entries) if (e["impurity"], int(e["max_bins"])) == key]
        guesses = nested.leaf_table(tables[key], name, {f"__p{i}": int(entries[i]["max_depth"]) for i in mine})
        small = train.sparkSession.createDataFrame(guesses)
        scored = join_small(scored, small, name, "left", small_rows=guesses.num_rows)
        cols.update((str(i), F.col(f"__p{i}")) for i in mine)
    cols = {str(i): cols[str(i)] for i in range(len(entries))}
    vals = evaluate.metric_many(scored, cols, metric)
    return (_result_frame(train.sparkSession, entries, metric,
                          [vals[str(i)] for i in range(len(entries))],
                          [models[str(i)].fit_ms for i in range(len(entries))], TREE_COLUMNS), models)


# ---- choosing ---------------------------------------------------------------------------

def pick_best(results: DataFrame, metric: str) -> DataFrame:
    """Best row (G9).  Higher-is-better metrics: the LAST of equal best rows
    wins; RMSE: the FIRST (smallest position) wins."""
    if HIGHER_IS_BETTER[metric]:
        order = [F.desc_nulls_last(metric), F.desc("position")]
    else:
        order = [F.asc_nulls_last(metric), F.asc("position")]
    return results.orderBy(*order).limit(1)


def sort_by_metric(results: DataFrame, metric: str) -> DataFrame:
    """Rows ranked best first, ties as in ``pick_best`` (T4)."""
    from pyspark.sql import Window
    if HIGHER_IS_BETTER[metric]:
        order = [F.desc_nulls_last(metric), F.desc("position")]
    else:
        order = [F.asc_nulls_last(metric), F.asc("position")]
    # the tuning frame has one row per configuration (tens of rows): a global
    # ordering window over it is cheap.
    return results.withColumn("rank", F.row_number().over(Window.orderBy(*order)))
