"""DuckDB oracle SQL for the linear SGD and tuning keys."""

from __future__ import annotations

from orchard.operators import tune
from orchard.plans import settings as Q
from orchard.plans import sqlgen as G

D_BIN = G.K_PRIORITY + 4


def _base(nb: bool) -> str:
    return f"""WITH RECURSIVE {G.binary_view()},
{G.features_cte('bb', G.K_PRIORITY, nb=nb)},
trn AS (SELECT * FROM feat WHERE split = 'train'),
val AS (SELECT * FROM feat WHERE split = 'validation')"""


def _single(kind: str, p: dict) -> str:
    cfg = [(0, p["step_size"], p.get("reg_param", 0.0), p.get("mini_batch_fraction", 1.0))]
    return f"""{_base(False)},
{G.sgd_recursive('trn', D_BIN, kind, cfg, p['num_iterations'])},
m AS (SELECT * FROM sgd WHERE t = {p['num_iterations']})"""


def _weights(kind, p):
    arr = ", ".join(f"w{j}" for j in range(D_BIN))
    return f"""{_single(kind, p)}
SELECT CAST(j AS INTEGER) AS j, round(w, 6) AS weight FROM (
  SELECT unnest(range({D_BIN})) AS j, unnest([{arr}]) AS w FROM m)"""


def _predict(kind, p):
    return f"""{_single(kind, p)}
SELECT l_orderkey, l_linenumber, split, CAST(label AS DOUBLE) AS label,
       {G.linear_predict(kind, D_BIN)} AS prediction FROM feat, m"""


def _tune(kind: str, entries: list[dict]) -> str:
    cfgs, cid = {}, []
    for e in entries:
        k = (float(e["step_size"]), float(e.get("reg_param", 0.0)),
             float(e.get("mini_batch_fraction", 1.0)))
        cfgs.setdefault(k, len(cfgs))
        cid.append(cfgs[k])
    t_max = max(int(e["num_iterations"]) for e in entries)
    ent = ", ".join(
        f"('{e['sweep']}', {i}, {int(e['num_iterations'])}, CAST({float(e['step_size'])!r} AS DOUBLE), "
        f"CAST({float(e.get('reg_param', 0.0))!r} AS DOUBLE), "
        f"CAST({float(e.get('mini_batch_fraction', 1.0))!r} AS DOUBLE), {c})"
        for i, (e, c) in enumerate(zip(entries, cid)))
    conf = [(c, s, r, f) for (s, r, f), c in cfgs.items()]
    return f"""{_base(False)},
{G.sgd_recursive('trn', D_BIN, kind, conf, t_max)},
ent AS (SELECT * FROM (VALUES {ent}) v(sweep, position, num_iterations, step_size, reg_param,
        mini_batch_fraction, cid)),
m AS (SELECT ent.sweep, ent.position, ent.num_iterations, ent.step_size, ent.reg_param,
             ent.mini_batch_fraction, sgd.* EXCLUDE (cid, step, reg, frac, t, nupd, done)
      FROM ent JOIN sgd ON sgd.cid = ent.cid AND sgd.t = ent.num_iterations),
pr AS (SELECT m.sweep, m.position, m.num_iterations, m.step_size, m.reg_param, m.mini_batch_fraction,
              val.label, {G.linear_predict(kind, D_BIN)} AS prediction FROM val, m)
SELECT sweep, CAST(position AS INTEGER) AS position, CAST(num_iterations AS INTEGER) AS num_iterations,
       step_size, reg_param, mini_batch_fraction, {G.auc_select().split(', ', 1)[1]}
FROM pr GROUP BY ALL"""


def _nb_tune(sweep: str) -> str:
    parts = []
    for i, lam in enumerate(Q.NB_LAMBDAS):
        parts.append(f"""{G.nb_model_cte('trn', D_BIN, lam, where='true', name=f'nb{i}')},
a{i} AS (SELECT * FROM nb{i} WHERE label = 0), b{i} AS (SELECT * FROM nb{i} WHERE label = 1),
p{i} AS (SELECT '{sweep}' AS sweep, CAST({i} AS INTEGER) AS position, CAST({lam!r} AS DOUBLE) AS smoothing,
         val.label, {G.nb_predict_expr(D_BIN, f'a{i}', f'b{i}')} AS prediction FROM val, a{i}, b{i})""")
    union = " UNION ALL ".join(f"SELECT * FROM p{i}" for i in range(len(Q.NB_LAMBDAS)))
    return f"""{_base(True)},
{",".join(parts)},
pr AS ({union}),
res AS (SELECT sweep, position, smoothing, {G.auc_select().split(', ', 1)[1]} FROM pr GROUP BY ALL)"""


def _default_run(kind: str, p: dict) -> str:
    return f"""SELECT split, {G.auc_select()} FROM ({_predict(kind, p)})
WHERE split IN ('validation', 'test') GROUP BY split"""


def _refit(kind: str, grid) -> str:
    """Grid, best row (the last of equal ones), the same steps on train and validation, test AUC."""
    entries = tune.grid_entries(grid)
    t_max = max(int(e["num_iterations"]) for e in entries)
    again = G.sgd_recursive("trv", D_BIN, kind, [(0, 1.0, 0.0, 1.0)], t_max)
    again = again.split("\n", 1)[1].replace("sgd AS (", "sgd2 AS (").replace("FROM sgd p", "FROM sgd2 p").replace(
        "FROM cfg", "FROM cfg2")
    return f"""SELECT num_iterations, step_size, reg_param, mini_batch_fraction, n, auc_hard FROM (
{_tune(kind, entries).replace("SELECT sweep, CAST(position", "res AS (SELECT sweep, CAST(position").replace(
    "trn AS (", "trv AS (SELECT * FROM feat WHERE split IN ('train', 'validation')), trn AS (", 1).replace(
    "), res AS", "), res AS").rsplit("FROM pr GROUP BY ALL", 1)[0].replace(
    "AS prediction FROM val, m)" + chr(10) + "res AS", "AS prediction FROM val, m)," + chr(10) + "res AS")}FROM pr GROUP BY ALL),
best AS (SELECT * FROM res ORDER BY auc_hard DESC NULLS LAST, position DESC LIMIT 1),
cfg2 AS (SELECT 0 AS cid, step_size AS step, reg_param AS reg, mini_batch_fraction AS frac FROM best),
{again},
m2 AS (SELECT sgd2.* FROM sgd2, best WHERE sgd2.t = best.num_iterations),
pr2 AS (SELECT f.label, {G.linear_predict(kind, D_BIN, w="m2")} AS prediction
        FROM (SELECT * FROM feat WHERE split = 'test') f, m2),
ev AS (SELECT {G.auc_select()} FROM pr2)
SELECT best.num_iterations, best.step_size, best.reg_param, best.mini_batch_fraction, ev.n, ev.auc_hard
FROM best, ev)"""


LINEAR_SQL = {
    "fit_svm_historic": _weights("hinge", dict(Q.SVM_HISTORIC, num_iterations=3)),
    "eval_default_logistic": _default_run("logistic", Q.LOGISTIC_DEFAULT),
    "eval_default_svm": _default_run("hinge", Q.SVM_DEFAULT),
    "tune_refit_logistic": _refit("logistic", Q.LOGISTIC_GRID),
    "tune_refit_svm": _refit("hinge", Q.SVM_GRID),
    "fit_logistic_sgd": _weights("logistic", Q.LOGISTIC_DEFAULT),
    "fit_svm_sgd": _weights("hinge", Q.SVM_DEFAULT),
    "predict_logistic": _predict("logistic", Q.LOGISTIC_DEFAULT),
    "predict_svm": _predict("hinge", Q.SVM_DEFAULT),
    "tune_sweep_logistic": _tune("logistic", tune.sweep_entries(Q.LOGISTIC_SWEEP_FIXED,
                                                                 Q.LOGISTIC_SWEEPS)),
    "tune_grid_logistic": _tune("logistic", tune.grid_entries(Q.LOGISTIC_GRID)),
    "tune_sweep_svm": _tune("hinge", tune.sweep_entries(Q.SVM_SWEEP_FIXED, Q.SVM_SWEEPS)),
    "tune_grid_svm": _tune("hinge", tune.grid_entries(Q.SVM_GRID)),
    "tune_sweep_nb": _nb_tune("lambda") + "\nSELECT * FROM res",
    "tune_grid_nb": _nb_tune("grid") + "\nSELECT * FROM res",
    "tune_pick_best": _nb_tune("grid") + """
SELECT position, smoothing, auc_hard FROM res ORDER BY auc_hard DESC NULLS LAST, position DESC LIMIT 1""",
    "tune_refit_best": _nb_tune("grid") + f""",
best AS (SELECT smoothing FROM res ORDER BY auc_hard DESC NULLS LAST, position DESC LIMIT 1),
{G.nb_model_cte('feat', D_BIN, '(SELECT smoothing FROM best)', where="split IN ('train', 'validation')", name='rf')},
ra AS (SELECT * FROM rf WHERE label = 0), rb AS (SELECT * FROM rf WHERE label = 1),
rp AS (SELECT feat.label, {G.nb_predict_expr(D_BIN, 'ra', 'rb')} AS prediction
       FROM feat, ra, rb WHERE split = 'test')
SELECT (SELECT smoothing FROM best) AS smoothing, {G.auc_select()} FROM rp""",
    "sort_by_metric": _nb_tune("grid") + """
SELECT CAST(row_number() OVER (ORDER BY auc_hard DESC NULLS LAST, position DESC) AS INTEGER) AS rank,
       position, smoothing, auc_hard FROM res""",
}
