"""DuckDB oracle SQL for the source / prep / feature / split / metric keys."""

from __future__ import annotations

from orchard.functions import decode as D
from orchard.functions.hashing import step_unit_sql
from orchard.operators.tune import grid_entries
from orchard.plans import settings as Q
from orchard.plans import sqlgen as G

K_PAGE = 4           # distinct languages in page_train
D_PAGE = K_PAGE + 4
D_BIN = G.K_PRIORITY + 4
NB_LAMBDA = 5.0
W = "WITH "


def _pages_nb(nb: bool) -> str:
    return f"""{W}{G.page_view()},
{G.features_cte('pt', K_PAGE, nb=nb, extra_src='ps')}"""


CORE_SQL = {}

CORE_SQL["src_ratings_tsv"] = f"{W}{G.RATINGS} SELECT user_id, item_id, rating FROM ratings"
CORE_SQL["src_titles_pipe"] = f"{W}{G.TITLES} SELECT item_id, title FROM titles"
_X = "f0 AS x0, f1 AS x1, coalesce(f2, 0.0) AS x2, f3 AS x3"
CORE_SQL["src_pages_train_tsv"] = f"""{W}{G.page_view()}
SELECT url, category, CAST(4 AS INTEGER) AS n_numeric, {_X}, CAST(label AS INTEGER) AS label FROM pt"""
CORE_SQL["src_pages_score_tsv"] = f"""{W}{G.page_view()}
SELECT url, category, CAST(4 AS INTEGER) AS n_numeric, {_X} FROM ps"""
CORE_SQL["src_numeric_csv"] = """SELECT vec_id, label, CAST(j AS INTEGER) AS j, round(v, 6) AS value FROM (
  SELECT vec_id, CAST(label AS DOUBLE) AS label, unnest(range(64)) AS j,
         unnest(CAST(embedding AS DOUBLE[])) AS v FROM embeddings)"""
_HF = "season, mnth, hr, holiday, weekday, workingday, weathersit, temp, atemp, hum, windspeed"
CORE_SQL["src_hourly_csv"] = f"""{W}{G.HOURLY}
SELECT hs AS h, CAST(label AS INTEGER) AS label, CAST(j AS INTEGER) AS j, round(v, 6) AS value FROM (
  SELECT hs, label, unnest(range(11)) AS j,
         unnest([{", ".join(f"CAST({c} AS DOUBLE)" for c in _HF.split(", "))}]) AS v FROM hourly)"""
CORE_SQL["src_ratings_files"] = CORE_SQL["src_ratings_tsv"]
CORE_SQL["src_pages_files"] = CORE_SQL["src_pages_train_tsv"]
CORE_SQL["src_hourly_files"] = f"""{W}{G.HOURLY}
SELECT label, j, value, count(*) AS n FROM (
  SELECT CAST(label AS INTEGER) AS label, CAST(j AS INTEGER) AS j, round(v, 6) AS value FROM (
    SELECT label, unnest(range(11)) AS j,
           unnest([{", ".join(f"CAST({c} AS DOUBLE)" for c in _HF.split(", "))}]) AS v FROM hourly)) GROUP BY ALL"""
# ratings and titles take any number of further fields; every other line with one too many is ragged
_LAYOUTS = [("ratings", "ratings"), ("titles", "titles"), ("pages", "pt"), ("numeric", "embeddings"), ("hourly", "hourly")]
CORE_SQL["src_rejects"] = f"""{W}{G.RATINGS}, {G.TITLES}, {G.page_view()}, {G.HOURLY},
sizes AS ({" UNION ALL ".join(f"SELECT '{name}' AS layout, count(*) AS c FROM {view}" for name, view in _LAYOUTS)}),
forms AS (SELECT layout, unnest(['row', 'blank', 'short',
                 CASE WHEN layout IN ('ratings', 'titles') THEN 'row' ELSE 'ragged' END]) AS reason, c FROM sizes)
SELECT layout, reason, CAST(sum(c) AS BIGINT) AS n FROM forms GROUP BY layout, reason"""
# each of the ten files keeps the data line that reads like its header
CORE_SQL["src_drop_header"] = f"""{W}{G.page_view()},
{G.PAGE_LINE},
filed AS (SELECT CAST(doc_id % 10 AS INTEGER) AS file, value FROM page_line)
SELECT file, value FROM filed
UNION ALL
SELECT DISTINCT file, concat_ws(chr(9), 'url', 'id', 'x', 'category', 'f0', 'f1', 'f2', 'f3', 'label') FROM filed"""
CORE_SQL["sink_report"] = f"""{_pages_nb(True)},
{G.nb_model_cte('feat', D_PAGE, NB_LAMBDA)},
c0 AS (SELECT * FROM nbm WHERE label = 0), c1 AS (SELECT * FROM nbm WHERE label = 1),
pr AS (SELECT doc_id, url, {G.nb_predict_expr(D_PAGE)} AS prediction FROM feat2, c0, c1)
SELECT doc_id, concat('url: ', url, ' ==> ',
       {G.case_map('CAST(prediction AS INTEGER)', D.PAGE_CLASS)}) AS line FROM pr"""

CORE_SQL["prep_split_take"] = f"""{W}{G.RATINGS}
SELECT CAST(user_id AS VARCHAR) AS f0, CAST(item_id AS VARCHAR) AS f1, CAST(rating AS VARCHAR) AS f2,
       CAST(3 AS INTEGER) AS n FROM ratings"""
CORE_SQL["prep_strip_quotes"] = f"""{W}{G.page_view()}
SELECT url AS c0, CAST(doc_id AS VARCHAR) AS c1, 'x' AS c2, category AS c3,
  {", ".join(f"coalesce(CAST(CAST(f{j} AS BIGINT) AS VARCHAR), '?') AS c{4 + j}" for j in range(4))},
  CAST(label AS VARCHAR) AS c8 FROM pt"""
CORE_SQL["prep_missing_to_zero"] = f"{W}{G.page_view()} SELECT doc_id, coalesce(f2, 0.0) AS value FROM pt"
CORE_SQL["prep_clamp_nonneg"] = f"""{W}{G.page_view()}
SELECT doc_id, f1, greatest(f1, 0.0) AS f1_clamped FROM pt"""
CORE_SQL["prep_field_slice"] = f"""{W}{G.page_view()}
SELECT doc_id, CAST(4 AS INTEGER) AS n, CAST(CAST(f0 AS BIGINT) AS VARCHAR) AS first,
  CAST(1 AS INTEGER) AS n_inner, 'x' AS "inner" FROM pt"""
CORE_SQL["prep_label_last"] = f"{W}{G.page_view()} SELECT doc_id, CAST(label AS INTEGER) AS label FROM pt"
CORE_SQL["prep_label_zero_based"] = """SELECT vec_id, CAST(label AS DOUBLE) AS label,
  CAST(64 AS INTEGER) AS n_features FROM embeddings"""
CORE_SQL["prep_project_field"] = f"{W}{G.RATINGS} SELECT user_id FROM ratings"
CORE_SQL["feat_concat"] = f"""{W}{G.binary_view()},
{G.features_cte('bb', G.K_PRIORITY, nb=False)}
{G.explode_long('raw', 'l_orderkey, l_linenumber', 'x', D_BIN)}"""
CORE_SQL["feat_parse_all_double"] = """SELECT vec_id, CAST(j AS INTEGER) AS j, round(v, 6) AS value FROM (
  SELECT vec_id, unnest(range(65)) AS j,
         unnest(list_concat(CAST(embedding AS DOUBLE[]),
                            [CAST(label + 1 AS DOUBLE)])) AS v FROM embeddings)"""

CORE_SQL["join_category_index"] = f"""{_pages_nb(False)}
SELECT ps.doc_id, ps.category, dc.idx AS cat_idx FROM ps LEFT JOIN dc ON ps.category = dc.category"""
CORE_SQL["join_title"] = f"""{W}{G.RATINGS}, {G.TITLES}
SELECT r.user_id, r.item_id, t.title FROM ratings r LEFT JOIN titles t ON r.item_id = t.item_id"""

_VIEWS = [
    ("ratings", f"(WITH {G.RATINGS} SELECT * FROM ratings)"),
    ("titles", "part"),
    ("page_train", "(SELECT d.doc_id FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"),
    ("page_score", "(SELECT d.doc_id FROM documents d ANTI JOIN labels l ON d.doc_id = l.doc_id)"),
    ("binary_big", "(SELECT 1 FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"),
    ("multi", "embeddings"),
    ("hourly", f"(WITH {G.HOURLY} SELECT * FROM hourly)"),
]
CORE_SQL["agg_row_count"] = " UNION ALL ".join(
    f"SELECT '{n}' AS view, count(*) AS n FROM {src} t{i}" for i, (n, src) in enumerate(_VIEWS))
CORE_SQL["agg_rating_stats"] = f"""{W}{G.RATINGS}
SELECT count(*) AS n_ratings, count(DISTINCT user_id) AS n_users, count(DISTINCT item_id) AS n_items
FROM ratings"""
CORE_SQL["agg_split_counts"] = f"{W}{G.binary_view()} SELECT split, count(*) AS n FROM bb GROUP BY split"
CORE_SQL["feat_category_dict"] = f"""{W}{G.binary_view()},
{G.features_cte('bb', G.K_PRIORITY, nb=False)} SELECT category, idx FROM dc"""
_bin_center = f"{W}{G.binary_view()},\n{G.features_cte('bb', G.K_PRIORITY, nb=False)}"
CORE_SQL["feat_scaler_fit_center"] = _bin_center + "\nSELECT CAST(j AS INTEGER) AS j, round(m, 6) AS mean, round(s, 6) AS std FROM (SELECT unnest(range(%d)) AS j, unnest([%s]) AS m, unnest([%s]) AS s FROM st)" % (
    D_BIN, ", ".join(f"m{j}" for j in range(D_BIN)), ", ".join(f"s{j}" for j in range(D_BIN)))
_bin_nb = f"{W}{G.binary_view()},\n{G.features_cte('bb', G.K_PRIORITY, nb=True)}"
CORE_SQL["feat_scaler_fit_std"] = _bin_nb + "\nSELECT CAST(j AS INTEGER) AS j, round(s, 6) AS std FROM (SELECT unnest(range(%d)) AS j, unnest([%s]) AS s FROM st)" % (
    D_BIN, ", ".join(f"s{j}" for j in range(D_BIN)))

CORE_SQL["feat_one_hot"] = f"""{_pages_nb(False)}
{G.explode_long('raw', 'doc_id', 'x', K_PAGE)}"""
CORE_SQL["feat_standardize"] = f"""{_pages_nb(False)}
{G.explode_long('feat', 'doc_id', 'z', D_PAGE)}"""
CORE_SQL["feat_scale_only"] = f"""{_pages_nb(True)}
{G.explode_long('feat', 'doc_id', 'z', D_PAGE)}"""
CORE_SQL["feat_page_pipeline"] = f"""{_pages_nb(False)}
{G.explode_long('feat2', 'doc_id', 'z', D_PAGE)}"""

CORE_SQL["split_80_10_10"] = f"{W}{G.binary_view()} SELECT l_orderkey, l_linenumber, split FROM bb"
CORE_SQL["split_sample_10"] = f"""SELECT vec_id, CAST(label AS DOUBLE) AS label FROM embeddings
WHERE {G.md5_head("CAST(vec_id AS VARCHAR) || '#sample'")} / 4294967296.0 < 0.1"""
_steps = " UNION ALL ".join(
    f"SELECT CAST({t} AS INTEGER) AS step, CAST(sum(CASE WHEN {step_unit_sql('u', t)} < 0.5 THEN 1 ELSE 0 END) "
    f"AS BIGINT) AS n FROM bb "
    f"WHERE split = 'train'" for t in range(1, 6))
CORE_SQL["split_minibatch"] = f"{W}{G.binary_view()} {_steps}"
CORE_SQL["set_union_all"] = f"""{W}{G.binary_view()}
SELECT l_orderkey, l_linenumber, label FROM bb WHERE split IN ('train', 'validation')"""
CORE_SQL["set_distinct"] = f"{W}{G.RATINGS} SELECT DISTINCT item_id FROM ratings"

CORE_SQL["decode_page_class"] = f"""{W}{G.page_view()}
SELECT doc_id, label, {G.case_map('label', D.PAGE_CLASS)} AS class FROM pt"""
CORE_SQL["decode_season"] = f"""{W}{G.HOURLY}
SELECT hs AS h, season, {G.case_map('season', D.SEASON)} AS season_name FROM hourly"""
CORE_SQL["decode_calendar"] = f"""{W}{G.HOURLY}
SELECT hs AS h, mnth, hr, {G.case_map('holiday', D.HOLIDAY)} AS holiday_name,
       {G.case_map('weekday', D.WEEKDAY)} AS weekday_name,
       {G.case_map('workingday', D.WORKINGDAY)} AS workingday_name FROM hourly"""
CORE_SQL["decode_weather"] = f"""{W}{G.HOURLY}
SELECT hs AS h, weathersit, {G.case_map('weathersit', D.WEATHER)} AS weather_name FROM hourly"""


def _tr(c, k):
    return f"CAST(trunc({c} * {k}) AS INTEGER)"


CORE_SQL["decode_denormalize"] = f"""{W}{G.HOURLY}
SELECT hs AS h, {_tr('temp', D.TEMP_SCALE)} AS temp_c, {_tr('atemp', D.FEELS_SCALE)} AS feels_c,
       {_tr('hum', D.HUMIDITY_SCALE)} AS humidity, {_tr('windspeed', D.WIND_SCALE)} AS wind FROM hourly"""
CORE_SQL["fmt_description"] = f"""{W}{G.HOURLY}
SELECT hs AS h, concat_ws(',', {G.case_map('season', D.SEASON)}, CAST(mnth AS VARCHAR) || ' month',
  CAST(hr AS VARCHAR) || ' h', {G.case_map('holiday', D.HOLIDAY)}, {G.case_map('weekday', D.WEEKDAY)},
  {G.case_map('workingday', D.WORKINGDAY)}, {G.case_map('weathersit', D.WEATHER)},
  'temp ' || CAST({_tr('temp', D.TEMP_SCALE)} AS VARCHAR),
  'feels ' || CAST({_tr('atemp', D.FEELS_SCALE)} AS VARCHAR),
  'humidity ' || CAST({_tr('hum', D.HUMIDITY_SCALE)} AS VARCHAR),
  'wind ' || CAST({_tr('windspeed', D.WIND_SCALE)} AS VARCHAR)) AS description FROM hourly"""

_nb_bin = f"""{W}{G.binary_view()},
{G.features_cte('bb', G.K_PRIORITY, nb=True)},
{G.nb_model_cte('feat', D_BIN, NB_LAMBDA)},
c0 AS (SELECT * FROM nbm WHERE label = 0), c1 AS (SELECT * FROM nbm WHERE label = 1),
pr AS (SELECT l_orderkey, l_linenumber, split, CAST(feat.label AS DOUBLE) AS label,
       {G.nb_predict_expr(D_BIN)} AS prediction FROM feat, c0, c1)"""
CORE_SQL["eval_auc_hard"] = f"{_nb_bin}\nSELECT split, {G.auc_select()} FROM pr GROUP BY split"
CORE_SQL["eval_accuracy"] = f"""{_nb_bin}
SELECT split, count(*) AS n, round(avg(CASE WHEN prediction = label THEN 1.0 ELSE 0.0 END), 6) AS accuracy
FROM pr GROUP BY split"""
CORE_SQL["eval_correct_flag"] = f"""{_nb_bin}
SELECT l_orderkey, l_linenumber, split,
       CASE WHEN prediction = label THEN 'right' ELSE 'wrong' END AS result FROM pr"""
CORE_SQL["limit_take_n"] = f"""{W}{G.page_view()}
SELECT doc_id, url, label FROM pt ORDER BY doc_id LIMIT 20"""
CORE_SQL["limit_first"] = """SELECT l_orderkey, l_linenumber, o_orderpriority AS category, l_quantity AS f0,
  l_extendedprice AS f1, l_discount AS f2, l_tax AS f3,
  CASE WHEN l_extendedprice + o_totalprice / 10 > 75000 THEN 1 ELSE 0 END AS label
FROM lineitem JOIN orders ON l_orderkey = o_orderkey ORDER BY ALL LIMIT 1"""
CORE_SQL["topk_per_key"] = f"""{W}{G.RATINGS}
SELECT user_id, CAST(rn AS INTEGER) AS rank, item_id, rating FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY rating DESC, item_id ASC) AS rn
  FROM ratings) WHERE rn <= 10"""

_nb_page = f"""{_pages_nb(True)},
{G.nb_model_cte('feat', D_PAGE, NB_LAMBDA)},
c0 AS (SELECT * FROM nbm WHERE label = 0), c1 AS (SELECT * FROM nbm WHERE label = 1)"""
CORE_SQL["score_new_pages"] = f"""{_nb_page},
pr AS (SELECT doc_id, url, {G.nb_predict_expr(D_PAGE)} AS prediction FROM feat2, c0, c1)
SELECT doc_id, url, prediction, {G.case_map('CAST(prediction AS INTEGER)', D.PAGE_CLASS)} AS class
FROM pr ORDER BY doc_id LIMIT 10"""


def _score_new_linear(kind: str, p: dict) -> str:
    cfg = [(0, p["step_size"], p.get("reg_param", 0.0), p.get("mini_batch_fraction", 1.0))]
    steps = p["num_iterations"]
    return f"""{_pages_nb(False).replace(W, 'WITH RECURSIVE ', 1)},
trn AS (SELECT * FROM feat WHERE split = 'train'),
{G.sgd_recursive('trn', D_PAGE, kind, cfg, steps)},
m AS (SELECT * FROM sgd WHERE t = {steps}),
pr AS (SELECT doc_id, url, {G.linear_predict(kind, D_PAGE)} AS prediction FROM feat2, m)
SELECT doc_id, url, CAST(prediction AS DOUBLE) AS prediction,
       {G.case_map('CAST(prediction AS INTEGER)', D.PAGE_CLASS)} AS class
FROM pr ORDER BY doc_id LIMIT 10"""


CORE_SQL["score_new_pages_logistic"] = _score_new_linear("logistic", Q.LOGISTIC_DEFAULT)
CORE_SQL["score_new_pages_svm"] = _score_new_linear("hinge", Q.SVM_DEFAULT)
CORE_SQL["report_labelled_topn"] = f"""{_nb_page},
pr AS (SELECT doc_id, CAST(feat.label AS DOUBLE) AS label, {G.nb_predict_expr(D_PAGE)} AS prediction
       FROM feat, c0, c1 WHERE split = 'test')
SELECT doc_id, label, prediction, CASE WHEN prediction = label THEN 'right' ELSE 'wrong' END AS result
FROM pr ORDER BY doc_id LIMIT 50"""

_HFEAT = ["season", "mnth", "hr", "holiday", "weekday", "workingday", "weathersit",
          "temp", "atemp", "hum", "windspeed"]
_hkey = "strftime(h, '%Y-%m-%d %H:%M:%S')"
_HOURLY_SPLIT = f"""{W}{G.HOURLY},
hs2 AS (SELECT *, {G.split_case(G.md5_head(_hkey))} AS split FROM hourly),
{G.regression_stump('hs2', _HFEAT)},
pr AS (SELECT r.hs AS h, r.split, CAST(r.label AS DOUBLE) AS label, {G.stump_predict(_HFEAT)} AS prediction
       FROM hs2 r, stump st)"""
CORE_SQL["eval_rmse"] = f"""{_HOURLY_SPLIT}
SELECT split, count(*) AS n, round(sqrt(avg((prediction - label) * (prediction - label))), 6) AS rmse
FROM pr GROUP BY split"""
CORE_SQL["eval_abs_error"] = f"""{_HOURLY_SPLIT}
SELECT h, label, round(prediction, 6) AS prediction,
       round(abs(label - prediction), 6) AS abs_error FROM pr"""

_TREE_REG = f"""{W}{G.HOURLY},
hs2 AS (SELECT *, {G.split_case(G.md5_head(_hkey))} AS split FROM hourly),
{G.regression_tree('hs2', _HFEAT, 10)}"""
CORE_SQL["predict_tree_value"] = f"""{_TREE_REG}
SELECT r.hs AS h, r.split, CAST(r.label AS DOUBLE) AS label, round(p.prediction, 6) AS prediction
FROM hs2 r JOIN tree_pred p ON p.hs = r.hs"""
CORE_SQL["score_hourly_report"] = f"""{_TREE_REG}
SELECT r.hs AS h, concat_ws(',', {G.case_map('season', D.SEASON)}, CAST(mnth AS VARCHAR) || ' month',
  CAST(hr AS VARCHAR) || ' h', {G.case_map('holiday', D.HOLIDAY)}, {G.case_map('weekday', D.WEEKDAY)},
  {G.case_map('workingday', D.WORKINGDAY)}, {G.case_map('weathersit', D.WEATHER)},
  'temp ' || CAST({_tr('temp', D.TEMP_SCALE)} AS VARCHAR),
  'feels ' || CAST({_tr('atemp', D.FEELS_SCALE)} AS VARCHAR),
  'humidity ' || CAST({_tr('hum', D.HUMIDITY_SCALE)} AS VARCHAR),
  'wind ' || CAST({_tr('windspeed', D.WIND_SCALE)} AS VARCHAR)) AS description,
  CAST(trunc(p.prediction) AS INTEGER) AS prediction, CAST(r.label AS INTEGER) AS label,
  abs(CAST(r.label AS DOUBLE) - p.prediction) AS abs_error
FROM hs2 r JOIN tree_pred p ON p.hs = r.hs ORDER BY r.h LIMIT 200"""
CORE_SQL["fit_tree_regression"] = f"""{_TREE_REG},
{G.tree_shape(10)},
ev AS (SELECT count(*) AS n, round(sqrt(avg((p.prediction - CAST(r.label AS DOUBLE))
              * (p.prediction - CAST(r.label AS DOUBLE)))), 6) AS rmse
       FROM hs2 r JOIN tree_pred p ON p.hs = r.hs WHERE r.split = 'validation')
SELECT 'variance' AS impurity, CAST(10 AS INTEGER) AS max_depth, CAST(50 AS INTEGER) AS max_bins,
       shape.depth, shape.num_nodes, ev.n, ev.rmse FROM shape, ev"""

# class trees over exact-quantile bins of binary_big's features (operators.binning)
_BINS = [f"b{j}" for j in range(D_BIN)]


def _binned(bins: int, where: str = "split = 'train'") -> str:
    return f"""{W}{G.binary_view()},
{G.features_cte('bb', G.K_PRIORITY, nb=False)},
{G.quantile_bins('raw', D_BIN, bins, train_where=where)}"""


def _class_tree(p: dict, where: str = "split = 'train'") -> str:
    return G.regression_tree("binned", _BINS, p["max_depth"], "l_orderkey", where, p["impurity"])


_TREE_BIN = f"{_binned(Q.TREE_BINARY['max_bins'])},\n{_class_tree(Q.TREE_BINARY)}"
_NAMED = (f"'{Q.TREE_BINARY['impurity']}' AS impurity, CAST({Q.TREE_BINARY['max_depth']} AS INTEGER) AS max_depth, "
          f"CAST({Q.TREE_BINARY['max_bins']} AS INTEGER) AS max_bins")
CORE_SQL["fit_tree_binary"] = f"""{_TREE_BIN},
{G.tree_shape(Q.TREE_BINARY['max_depth'])},
ev AS (SELECT {G.auc_select()} FROM tree_rows WHERE split = 'validation')
SELECT {_NAMED}, shape.depth, shape.num_nodes, ev.n, ev.auc_hard FROM shape, ev"""
CORE_SQL["predict_tree_class"] = f"""{_TREE_BIN}
SELECT l_orderkey, l_linenumber, split, CAST(label AS DOUBLE) AS label, prediction FROM tree_rows"""
CORE_SQL["eval_default_tree_binary"] = f"""{_TREE_BIN}
SELECT split, {G.auc_select()} FROM tree_rows WHERE split IN ('validation', 'test') GROUP BY split"""


def _refit_tree(entries: list[dict], bins: int) -> str:
    """Best entry on validation (the last of equal ones), refitted on train and validation, AUC on test."""
    both = "split IN ('train', 'validation')"

    def measured(view: str, where: str, split: str) -> str:
        return " UNION ALL ".join(
            f"SELECT {i} AS position, t.* FROM (WITH {_class_tree(e, where)} "
            f"SELECT {G.auc_select()} FROM tree_rows WHERE split = '{split}') t" for i, e in enumerate(entries)).replace(
                "FROM binned", f"FROM {view}")
    named = " ".join(f"WHEN {i} THEN '{e['impurity']}'" for i, e in enumerate(entries))
    depth = " ".join(f"WHEN {i} THEN {e['max_depth']}" for i, e in enumerate(entries))
    again = G.quantile_bins("raw", D_BIN, bins, train_where=both).replace("binned AS", "rebinned AS")
    for j in range(D_BIN):
        again = again.replace(f"qc{j} ", f"rqc{j} ").replace(f"th{j} ", f"rth{j} ").replace(
            f"th{j}.t", f"rth{j}.t").replace(f"th{j},", f"rth{j},").replace(f"th{j})", f"rth{j})")
    return f"""{_binned(bins)},
{again},
tuned AS ({measured('binned', "split = 'train'", 'validation')}),
best AS (SELECT position FROM tuned ORDER BY auc_hard DESC NULLS LAST, position DESC LIMIT 1),
refit AS ({measured('rebinned', both, 'test')})
SELECT CAST(position AS INTEGER) AS position, CASE position {named} END AS impurity,
       CAST(CASE position {depth} END AS INTEGER) AS max_depth, n, auc_hard FROM refit JOIN best USING (position)"""


CORE_SQL["tune_refit_tree_binary"] = _refit_tree(grid_entries(Q.TREE_REFIT_GRID), Q.TREE_BINARY["max_bins"])
CORE_SQL["eval_default_tree_value"] = f"""{_TREE_REG}
SELECT r.split, count(*) AS n, round(sqrt(avg((p.prediction - CAST(r.label AS DOUBLE))
       * (p.prediction - CAST(r.label AS DOUBLE)))), 6) AS rmse
FROM hs2 r JOIN tree_pred p ON p.hs = r.hs WHERE r.split IN ('validation', 'test') GROUP BY r.split"""
CORE_SQL["tune_pick_best_rmse"] = f"""{_HOURLY_SPLIT}
SELECT CAST(0 AS INTEGER) AS position, CAST(1 AS INTEGER) AS max_depth, CAST(32 AS INTEGER) AS max_bins,
       round(sqrt(avg((prediction - label) * (prediction - label))), 6) AS rmse
FROM pr WHERE split = 'validation'"""
CORE_SQL["tune_refit_tree_value"] = f"""{_HOURLY_SPLIT.replace(
    G.regression_stump('hs2', _HFEAT),
    G.regression_stump('hs2', _HFEAT, "split IN ('train', 'validation')"))}
SELECT CAST(32 AS INTEGER) AS max_bins, count(*) AS n,
       round(sqrt(avg((prediction - label) * (prediction - label))), 6) AS rmse
FROM pr WHERE split = 'test'"""
_SHOWN = ", ".join(f"CAST(round(CAST({c} AS DOUBLE), 3) AS VARCHAR)" for c in _HFEAT)
CORE_SQL["report_labelled_values"] = f"""{_HOURLY_SPLIT},
fr AS (SELECT hs AS h, concat_ws(' ', {_SHOWN}) AS shown FROM hs2)
SELECT h, fr.shown, label, round(prediction, 6) AS prediction, round(abs(label - prediction), 6) AS abs_error
FROM pr JOIN fr USING (h) ORDER BY h LIMIT 50"""

# what must hold of any factors: ten ranked, different, falling, factor products per request
for _name, _key in (("rec_items_for_user_checks", "user_id"), ("rec_users_for_item_checks", "item_id")):
    CORE_SQL[_name] = f"""{W}{G.RATINGS}
SELECT DISTINCT {_key}, CAST(10 AS INTEGER) AS n_rows, CAST(10 AS INTEGER) AS n_distinct,
  CAST(1 AS INTEGER) AS first_rank, CAST(10 AS INTEGER) AS last_rank, true AS scores_are_products,
  true AS scores_fall FROM ratings WHERE {_key} % 20 = 0"""
CORE_SQL["fit_als_checks"] = f"""{W}{G.RATINGS}
SELECT count(DISTINCT user_id) AS n_users, count(DISTINCT item_id) AS n_items, count(*) AS n_ratings,
  count(*) AS n_finite, CAST(5 AS INTEGER) AS user_rank_min, CAST(5 AS INTEGER) AS user_rank_max,
  CAST(5 AS INTEGER) AS item_rank_min, CAST(5 AS INTEGER) AS item_rank_max FROM ratings"""
CORE_SQL["als_predict_pair_checks"] = f"""{W}{G.RATINGS}
SELECT user_id, item_id, rating, true AS is_product FROM ratings"""
