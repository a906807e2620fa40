"""DuckDB oracle SQL, one statement per query key (same column names)."""

from __future__ import annotations

from orchard.plans import sqlgen as G

D_BIN = G.K_PRIORITY + 4
NB_LAMBDA = 5.0


def _nb_base() -> str:
    return f"""WITH {G.binary_view()},
{G.features_cte('bb', G.K_PRIORITY, nb=True)},
{G.nb_model_cte('feat', D_BIN, NB_LAMBDA)},
c0 AS (SELECT * FROM nbm WHERE label = 0), c1 AS (SELECT * FROM nbm WHERE label = 1)"""


def nb_sufficient_stats() -> str:
    arr = ", ".join(f"s{j}" for j in range(D_BIN))
    return f"""WITH {G.binary_view()},
{G.features_cte('bb', G.K_PRIORITY, nb=True)},
{G.nb_model_cte('feat', D_BIN, NB_LAMBDA)}
SELECT label, n, CAST(j AS INTEGER) AS j, round(sum_x, 3) AS sum_x, round(sum_x / n, 6) AS mean_x FROM (
  SELECT label, n, unnest(range({D_BIN})) AS j, unnest([{arr}]) AS sum_x FROM nbm_s)"""


def fit_naive_bayes() -> str:
    arr = ", ".join(f"t{j}" for j in range(D_BIN))
    return f"""{_nb_base()}
SELECT label, round(pi, 6) AS log_prior, CAST(j AS INTEGER) AS j, round(t, 6) AS log_theta FROM (
  SELECT label, pi, unnest(range({D_BIN})) AS j, unnest([{arr}]) AS t FROM nbm)"""


def predict_naive_bayes() -> str:
    return f"""{_nb_base()}
SELECT l_orderkey, l_linenumber, split, CAST(feat.label AS DOUBLE) AS label,
       {G.nb_predict_expr(D_BIN)} AS prediction
FROM feat, c0, c1"""


def eval_train_validate_test() -> str:
    return f"""{_nb_base()},
pr AS (SELECT split, feat.label AS label, {G.nb_predict_expr(D_BIN)} AS prediction FROM feat, c0, c1
       WHERE split IN ('validation', 'test'))
SELECT split, {G.auc_select()} FROM pr GROUP BY split"""


BAYES_SQL = {
    "nb_sufficient_stats": nb_sufficient_stats(),
    "fit_naive_bayes": fit_naive_bayes(),
    "predict_naive_bayes": predict_naive_bayes(),
    "eval_train_validate_test": eval_train_validate_test(),
}
