"""Helpers that write the DuckDB oracle SQL (CTE text) for the stand-in views.

The oracle is an independent statement of each query in plain SQL; these
helpers only avoid retyping the same view and feature CTEs.
"""

from __future__ import annotations

from orchard.functions.hashing import STEP_PRIME, step_factors

K_PRIORITY = 5          # distinct o_orderpriority values in binary_big
NUM = ["f0", "f1", "f2", "f3"]


def md5_head(expr: str) -> str:
    return f"CAST('0x' || substr(md5(CAST({expr} AS VARCHAR)), 1, 8) AS BIGINT)"


def split_case(h: str) -> str:
    return (f"CASE WHEN {h} % 10 < 8 THEN 'train' WHEN {h} % 10 < 9 THEN 'validation' "
            f"ELSE 'test' END")


def binary_view() -> str:
    key = "CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR)"
    return f"""bb0 AS (
  SELECT l_orderkey, l_linenumber, o_orderpriority AS category, l_quantity AS f0,
         l_extendedprice AS f1, l_discount AS f2, l_tax AS f3,
         CASE WHEN l_extendedprice + o_totalprice / 10 > 75000 THEN 1 ELSE 0 END AS label,
         {md5_head(key)} AS h
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
bb AS (SELECT *, {split_case('h')} AS split, h / 4294967296.0 AS u FROM bb0)"""


def page_view(table: str = "pt") -> str:
    cols = """d.doc_id, concat('http://', d.source, '.example/', CAST(d.doc_id AS VARCHAR)) AS url,
         d.lang AS category, CAST(d.n_chars AS DOUBLE) AS f0,
         CAST(length(d.text) - length(replace(d.text, ' ', '')) - 100 AS DOUBLE) AS f1,
         CASE WHEN d.doc_id % 11 = 0 THEN NULL
              ELSE CAST(length(d.text) - length(replace(d.text, chr(10), '')) AS DOUBLE) END AS f2,
         CAST(length(d.text) - length(replace(d.text, ',', '')) AS DOUBLE) AS f3"""
    return f"""pt0 AS (
  SELECT {cols}, l.quality AS label, {md5_head('d.doc_id')} AS h
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
{table} AS (SELECT *, {split_case('h')} AS split, h / 4294967296.0 AS u FROM pt0),
ps AS (SELECT {cols} FROM documents d ANTI JOIN labels l ON d.doc_id = l.doc_id)"""


def features_cte(src: str, k: int, nb: bool, name: str = "z",
                 fit_where: str = "split = 'train'", dict_src: str | None = None,
                 extra_src: str | None = None) -> str:
    """raw x0..x{k+3}: one-hot of category ++ numbers; then scaled z0..

    ``nb``: clamp negatives and scale without centring; else standardise.
    ``extra_src``: a second frame (same columns) transformed with the same fit.
    """
    d = k + len(NUM)
    dict_src = dict_src or src
    onehot = ", ".join(f"CASE WHEN dc.idx = {i} THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END AS x{i}"
                       for i in range(k))
    nums = []
    for i, c in enumerate(NUM):
        v = f"COALESCE(CAST({c} AS DOUBLE), 0.0)"
        if nb:
            v = f"greatest({v}, 0.0)"
        nums.append(f"{v} AS x{k + i}")
    stats = ", ".join(f"avg(x{j}) AS m{j}, stddev_samp(x{j}) AS s{j}" for j in range(d))

    def scaled(j):
        inv = f"(CASE WHEN st.s{j} <> 0 THEN 1.0 / st.s{j} ELSE 0.0 END)"
        return (f"(x{j} - 0.0) * {inv} AS {name}{j}" if nb
                else f"(x{j} - st.m{j}) * {inv} AS {name}{j}")
    zs = ", ".join(scaled(j) for j in range(d))
    out = f"""dc AS (SELECT category, CAST(row_number() OVER (ORDER BY category) - 1 AS INTEGER) AS idx
        FROM (SELECT DISTINCT category FROM {dict_src} WHERE category IS NOT NULL)),
raw AS (SELECT s.*, {onehot}, {", ".join(nums)} FROM {src} s LEFT JOIN dc ON s.category = dc.category),
st AS (SELECT {stats} FROM raw WHERE {fit_where}),
feat AS (SELECT raw.*, {zs} FROM raw, st)"""
    if extra_src:
        out += f""",
raw2 AS (SELECT s.*, {onehot}, {", ".join(nums)} FROM {extra_src} s LEFT JOIN dc ON s.category = dc.category),
feat2 AS (SELECT raw2.*, {zs} FROM raw2, st)"""
    return out


def dot(prefix: str, weights: list[str]) -> str:
    """x0*w0 + x1*w1 + ... with left-to-right association (as Spark builds it)."""
    return " + ".join(f"{prefix}{j} * {w}" for j, w in enumerate(weights))


def nb_model_cte(src: str, d: int, lam, where: str = "split = 'train'",
                 zname: str = "z", name: str = "nbm") -> str:
    """``lam``: a number, or SQL text (a scalar subquery) when it is chosen in SQL."""
    lam = _Lit(lam) if isinstance(lam, str) else lam
    sums = ", ".join(f"sum({zname}{j}) AS s{j}" for j in range(d))
    tot_s = " + ".join(f"s{j}" for j in range(d))
    th = ", ".join(f"ln(s{j} + {lam!r}) - ln(({tot_s}) + {d} * {lam!r}) AS t{j}" for j in range(d))
    return f"""{name}_s AS (SELECT CAST(label AS DOUBLE) AS label, count(*) AS n, {sums}
        FROM {src} WHERE {where} GROUP BY label),
{name}_t AS (SELECT sum(n) AS nn, count(*) AS kk FROM {name}_s),
{name} AS (SELECT label, ln(n + {lam!r}) - ln(nn + kk * {lam!r}) AS pi, {th}
        FROM {name}_s, {name}_t)"""


class _Lit(str):
    def __repr__(self):
        return f"({str(self)})"


def nb_predict_expr(d: int, m0: str = "c0", m1: str = "c1", zname: str = "z") -> str:
    s0 = f"{m0}.pi + ({dot(zname, [f'{m0}.t{j}' for j in range(d)])})"
    s1 = f"{m1}.pi + ({dot(zname, [f'{m1}.t{j}' for j in range(d)])})"
    return f"CASE WHEN {s1} > {s0} THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END"


def auc_select(pred: str = "prediction", label: str = "label") -> str:
    tp = f"CAST(sum(CASE WHEN {pred} = 1 AND {label} = 1 THEN 1 ELSE 0 END) AS BIGINT)"
    pos = f"CAST(sum(CASE WHEN {label} = 1 THEN 1 ELSE 0 END) AS BIGINT)"
    tn = f"CAST(sum(CASE WHEN {pred} = 0 AND {label} = 0 THEN 1 ELSE 0 END) AS BIGINT)"
    neg = f"CAST(sum(CASE WHEN {label} = 0 THEN 1 ELSE 0 END) AS BIGINT)"
    return (f"count(*) AS n, round(CASE WHEN {pos} > 0 AND {neg} > 0 THEN "
            f"(CAST({tp} AS DOUBLE) / {pos} + CAST({tn} AS DOUBLE) / {neg}) / 2.0 END, 6) AS auc_hard")


RATINGS = """ratings AS (
  SELECT CAST(o_custkey AS INT) AS user_id, CAST(l_partkey AS INT) AS item_id,
         CAST(least(5, CAST(floor(avg(l_quantity) / 10) AS INT) + 1) AS DOUBLE) AS rating
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_custkey, l_partkey)"""

TITLES = """titles AS (SELECT CAST(p_partkey AS INT) AS item_id, p_name AS title FROM part)"""

HOURLY = """hourly0 AS (
  SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS h, CAST(quarter(ts) AS INT) AS season,
         CAST(month(ts) AS INT) AS mnth, CAST(hour(ts) AS INT) AS hr,
         CASE WHEN month(ts) = 1 AND day(ts) = 1 THEN 1 ELSE 0 END AS holiday,
         CAST(dayofweek(ts) AS INT) AS weekday,
         CASE WHEN dayofweek(ts) IN (0, 6) THEN 0 ELSE 1 END AS workingday,
         CAST(hour(ts) % 4 + 1 AS INT) AS weathersit, count(*) AS label
  FROM events GROUP BY ALL),
hourly AS (
  SELECT *, (hr % 10) / CAST(10.0 AS DOUBLE) AS temp, (hr % 5) / CAST(5.0 AS DOUBLE) AS atemp,
         ((hr + weekday) % 10) / CAST(10.0 AS DOUBLE) AS hum,
         (hr % 3) / CAST(3.0 AS DOUBLE) AS windspeed,
         strftime(h, '%Y-%m-%d %H:%M:%S') AS hs
  FROM hourly0)"""

_QUOTED = ", ".join(f"concat('\"', coalesce(CAST(CAST({c} AS BIGINT) AS VARCHAR), '?'), '\"')"
                    for c in ("f0", "f1", "f2", "f3"))
PAGE_LINE = f"""page_line AS (
  SELECT doc_id, concat_ws(chr(9), concat('"', url, '"'), CAST(doc_id AS VARCHAR), '"x"',
         concat('"', category, '"'), {_QUOTED}, concat('"', CAST(label AS VARCHAR), '"')) AS value
  FROM pt)"""


def case_map(col: str, table: dict) -> str:
    whens = " ".join(f"WHEN {col} = {k} THEN '{v}'" for k, v in table.items())
    return f"CASE {whens} END"


def explode_long(src: str, keys: str, prefix: str, d: int, where: str = "") -> str:
    arr = ", ".join(f"{prefix}{j}" for j in range(d))
    w = f" WHERE {where}" if where else ""
    return (f"SELECT {keys}, CAST(j AS INTEGER) AS j, round(v, 6) AS value FROM ("
            f"SELECT {keys}, unnest(range({d})) AS j, unnest([{arr}]) AS v FROM {src}{w})")


def sgd_recursive(train: str, d: int, kind: str, configs: list[tuple], t_max: int,
                  x: str = "z", y: str = "label", u: str = "u", tol: float = 0.001) -> str:
    """CTEs ``cfg`` and ``sgd`` (cid, t, w0..): every config's weights after each step.

    ``configs``: (cid, step, reg, fraction).  Weights freeze once converged.
    """
    vals = ", ".join(f"({c}, CAST({s!r} AS DOUBLE), CAST({r!r} AS DOUBLE), CAST({f!r} AS DOUBLE))"
                     for c, s, r, f in configs)
    ws = ", ".join(f"CAST(0.0 AS DOUBLE) AS w{j}" for j in range(d))
    margin = " + ".join(f"{x}{j} * p.w{j}" for j in range(d))
    if kind == "logistic":
        mult = f"1.0 / (1.0 + exp(-({margin}))) - {y}"
    else:
        ys = f"(2.0 * {y} - 1.0)"
        mult = f"CASE WHEN {ys} * ({margin}) < 1.0 THEN -{ys} ELSE 0.0 END"
    a, b = zip(*(step_factors(t) for t in range(1, t_max + 1)))
    step_u = (f"CAST((CAST({u} * 4294967296 AS BIGINT) * {list(a)}[p.t + 1] + {list(b)}[p.t + 1]) "
              f"% {STEP_PRIME} AS DOUBLE) / {STEP_PRIME}")
    sampled = f"(p.frac >= 1.0 OR {step_u} < p.frac)"
    eta = "(p.step / sqrt(p.t + 1))"
    sums = ", ".join(f"sum(m * {x}{j}) AS g{j}" for j in range(d))
    xs = ", ".join(f"{x}{j}" for j in range(d))
    nws = ", ".join(
        f"CASE WHEN p.done OR g.n = 0 THEN p.w{j} ELSE (1.0 - {eta} * p.reg) * p.w{j} - "
        f"{eta} * (g.g{j} / g.n) END AS nw{j}" for j in range(d))
    ows = ", ".join(f"p.w{j} AS ow{j}" for j in range(d))
    diff = " + ".join(f"(nw{j} - ow{j}) * (nw{j} - ow{j})" for j in range(d))
    nrm = " + ".join(f"nw{j} * nw{j}" for j in range(d))
    outw = ", ".join(f"nw{j} AS w{j}" for j in range(d))
    return f"""cfg AS (SELECT * FROM (VALUES {vals}) v(cid, step, reg, frac)),
sgd AS (
  SELECT cid, step, reg, frac, 0 AS t, 0 AS nupd, false AS done, {ws} FROM cfg
  UNION ALL
  SELECT cid, step, reg, frac, t, nupd,
         pdone OR (NOT pdone AND n > 0 AND nupd > 1 AND
                   sqrt({diff}) < {tol!r} * greatest(sqrt({nrm}), 1.0)) AS done, {outw}
  FROM (
    SELECT p.cid, p.step, p.reg, p.frac, p.t + 1 AS t, p.done AS pdone, g.n,
           p.nupd + CASE WHEN NOT p.done AND g.n > 0 THEN 1 ELSE 0 END AS nupd, {ows}, {nws}
    FROM sgd p, LATERAL (
      SELECT count(*) AS n, {sums}
      FROM (SELECT {xs}, {mult} AS m FROM {train} WHERE {sampled}) s) g
    WHERE p.t < {t_max}) q)"""


def linear_predict(kind: str, d: int, x: str = "z", w: str = "m") -> str:
    margin = " + ".join(f"{x}{j} * {w}.w{j}" for j in range(d))
    if kind == "logistic":
        return (f"CASE WHEN 1.0 / (1.0 + exp(-({margin}))) > 0.5 THEN CAST(1.0 AS DOUBLE) "
                f"ELSE CAST(0.0 AS DOUBLE) END")
    return f"CASE WHEN {margin} > 0.0 THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END"


def regression_stump(src: str, features: list[str], train_where: str = "split = 'train'") -> str:
    """CTEs fitting a depth-1 variance tree: candidates are the midpoints of
    consecutive distinct training values; the first best (feature order, then
    threshold order) wins; no split when the best gain is <= 0.  Ends in
    ``stump(fidx, thr, lmean, rmean, root)``."""
    cands = []
    for i, f in enumerate(features):
        cands.append(f"""SELECT {i} AS fidx, (v + nv) / 2.0 AS thr FROM (
      SELECT v, lead(v) OVER (ORDER BY v) AS nv FROM (SELECT DISTINCT CAST({f} AS DOUBLE) AS v
      FROM {src} WHERE {train_where})) WHERE nv IS NOT NULL""")
    vals = " UNION ALL ".join(
        f"SELECT {i} AS fidx, CAST({f} AS DOUBLE) AS v, CAST(label AS DOUBLE) AS y FROM {src} "
        f"WHERE {train_where}" for i, f in enumerate(features))
    return f"""cand AS ({" UNION ALL ".join(cands)}),
tv AS ({vals}),
tot AS (SELECT count(*) * 1.0 AS n, sum(CAST(label AS DOUBLE)) AS s,
        sum(CAST(label AS DOUBLE) * CAST(label AS DOUBLE)) AS ss FROM {src} WHERE {train_where}),
lstat AS (SELECT c.fidx, c.thr, count(*) * 1.0 AS ln, sum(tv.y) AS ls, sum(tv.y * tv.y) AS lss
          FROM cand c JOIN tv ON tv.fidx = c.fidx AND tv.v <= c.thr GROUP BY c.fidx, c.thr),
gains AS (SELECT l.fidx, l.thr, l.ln, l.ls, t.n - l.ln AS rn, t.s - l.ls AS rs,
          (t.ss - (t.s * t.s) / t.n) / t.n
          - (l.ln / t.n) * ((l.lss - (l.ls * l.ls) / l.ln) / l.ln)
          - ((t.n - l.ln) / t.n) * (((t.ss - l.lss) - ((t.s - l.ls) * (t.s - l.ls)) / (t.n - l.ln)) / (t.n - l.ln))
          AS gain FROM lstat l, tot t WHERE t.n - l.ln >= 1),
best AS (SELECT * FROM gains ORDER BY gain DESC, fidx ASC, thr ASC LIMIT 1),
stump AS (SELECT CASE WHEN b.gain > 0 THEN b.fidx END AS fidx, b.thr, b.ls / b.ln AS lmean,
          b.rs / b.rn AS rmean, t.s / t.n AS root FROM best b, tot t)"""


def stump_predict(features: list[str], row: str = "r") -> str:
    whens = " ".join(f"WHEN st.fidx = {i} THEN CAST({row}.{f} AS DOUBLE)" for i, f in enumerate(features))
    return (f"CASE WHEN st.fidx IS NULL THEN st.root WHEN (CASE {whens} END) <= st.thr "
            f"THEN st.lmean ELSE st.rmean END")


def quantile_bins(src: str, dim: int, bins: int, x: str = "x", train_where: str = "split = 'train'") -> str:
    """CTE ``binned`` = ``src`` with b0..: exact-quantile bin numbers of x0.., as ``operators.binning``."""
    parts = []
    for j in range(dim):
        parts.append(f"""qc{j} AS (SELECT v, n, sum(n) OVER (ORDER BY v) AS cum, sum(n) OVER () AS total, count(*) OVER () AS d
  FROM (SELECT {x}{j} AS v, count(*) AS n FROM {src} WHERE {train_where} GROUP BY 1)),
th{j} AS (SELECT coalesce(list(v ORDER BY v), []::DOUBLE[]) AS t FROM qc{j} WHERE cum < total
  AND (d <= {bins} OR least(cum * {bins} // total, {bins - 1}) > (cum - n) * {bins} // total))""")
    bs = ", ".join(f"CAST(len(list_filter(th{j}.t, lambda q: q < {x}{j})) AS DOUBLE) AS b{j}" for j in range(dim))
    parts.append(f"binned AS MATERIALIZED (SELECT {src}.*, {bs} FROM {src}, {', '.join(f'th{j}' for j in range(dim))})")
    return ",\n".join(parts)


def _impurity(kind: str, n: str, s: str, ss: str) -> str:
    """Impurity of ``n`` rows with label sum ``s`` and label square sum ``ss`` (0/1 labels but for variance)."""
    if kind == "variance":
        return f"(({ss} - ({s} * {s}) / {n}) / {n})"
    p1, p0 = f"({s} / {n})", f"(({n} - {s}) / {n})"
    if kind == "gini":
        return f"(1.0 - {p0} * {p0} - {p1} * {p1})"
    log = "(CASE WHEN {p} > 0 THEN {p} * (ln({p}) / ln(CAST(2.0 AS DOUBLE))) ELSE 0.0 END)"
    return f"(0.0 - {log.format(p=p0)} - {log.format(p=p1)})"


def regression_tree(src: str, features: list[str], depth: int, key: str = "hs",
                    train_where: str = "split = 'train'", impurity: str = "variance") -> str:
    """CTEs growing a tree level by level, as Spark ML grows it: a variance tree, or an entropy
    or gini tree of 0/1 labels whose leaves predict their majority (0 in a tie).

    Candidates: midpoints of consecutive distinct training values per feature
    (valid while every feature has fewer distinct values than maxBins).  At
    each level every open node takes the first best split (feature order,
    then threshold order) with gain > 0 and both children non-empty; rows
    (all splits) are routed by ``value <= threshold``; node ids are
    1, 2n, 2n+1.  Ends in ``tree_rows`` (all columns and the prediction) and
    ``tree_pred(key, prediction)``.
    """
    cands = " UNION ALL ".join(
        f"""SELECT {i} AS fidx, (v + nv) / 2.0 AS thr FROM (
      SELECT v, lead(v) OVER (ORDER BY v) AS nv FROM (SELECT DISTINCT CAST({f} AS DOUBLE) AS v
      FROM {src} WHERE {train_where})) WHERE nv IS NOT NULL""" for i, f in enumerate(features))
    fcase = "CASE " + " ".join(f"WHEN b.fidx = {i} THEN CAST(r.{f} AS DOUBLE)"
                               for i, f in enumerate(features)) + " END"
    unpiv = " UNION ALL ".join(
        f"SELECT node, {i} AS fidx, CAST({f} AS DOUBLE) AS v, y FROM tr{{L}}"
        for i, f in enumerate(features))
    parts = [f"tcand AS MATERIALIZED ({cands})",
             f"""a0 AS MATERIALIZED (SELECT *, 1 AS node, false AS done, CAST(label AS DOUBLE) AS y,
             ({train_where}) AS is_tr FROM {src})"""]
    for L in range(depth):
        parts.append(f"""tr{L} AS MATERIALIZED (SELECT * FROM a{L} WHERE is_tr AND NOT done),
ns{L} AS MATERIALIZED (SELECT node, CAST(count(*) AS DOUBLE) AS n, sum(y) AS s, sum(y * y) AS ss FROM tr{L} GROUP BY node),
tv{L} AS MATERIALIZED ({unpiv.format(L=L)}),
ls{L} AS MATERIALIZED (SELECT t.node, c.fidx, c.thr, CAST(count(*) AS DOUBLE) AS ln, sum(t.y) AS ls, sum(t.y * t.y) AS lss
       FROM tcand c JOIN tv{L} t ON t.fidx = c.fidx AND t.v <= c.thr GROUP BY t.node, c.fidx, c.thr),
g{L} AS MATERIALIZED (SELECT l.node, l.fidx, l.thr,
       {_impurity(impurity, 'p.n', 'p.s', 'p.ss')}
       - (l.ln / p.n) * {_impurity(impurity, 'l.ln', 'l.ls', 'l.lss')}
       - ((p.n - l.ln) / p.n) * {_impurity(impurity, '(p.n - l.ln)', '(p.s - l.ls)', '(p.ss - l.lss)')}
       AS gain FROM ls{L} l JOIN ns{L} p ON p.node = l.node WHERE p.n - l.ln >= 1),
b{L} AS MATERIALIZED (SELECT node, fidx, thr FROM (
       SELECT *, row_number() OVER (PARTITION BY node ORDER BY gain DESC, fidx ASC, thr ASC) AS rk
       FROM g{L}) WHERE rk = 1 AND gain > 0),
a{L + 1} AS MATERIALIZED (SELECT r.* EXCLUDE (node, done),
       CASE WHEN r.done OR b.node IS NULL THEN r.node
            WHEN {fcase} <= b.thr THEN 2 * r.node ELSE 2 * r.node + 1 END AS node,
       r.done OR b.node IS NULL AS done
       FROM a{L} r LEFT JOIN b{L} b ON b.node = r.node AND NOT r.done)""")
    value = "sum(y) / count(*)" if impurity == "variance" else "CASE WHEN 2 * sum(y) > count(*) THEN 1.0 ELSE 0.0 END"
    parts.append(f"""leafs AS (SELECT node, CAST({value} AS DOUBLE) AS prediction FROM a{depth} WHERE is_tr GROUP BY node),
tree_rows AS (SELECT a.*, l.prediction FROM a{depth} a JOIN leafs l ON l.node = a.node),
tree_pred AS (SELECT {key}, prediction FROM tree_rows)""")
    return ",\n".join(parts)


def tree_shape(depth: int) -> str:
    """CTE ``shape(depth, num_nodes)`` of the grown tree after Spark ML's
    pruning: sibling leaves with equal predictions merge into their parent,
    bottom-up, for as many rounds as the tree is deep."""
    rounds = [f"pr0 AS (SELECT node, prediction FROM leafs)"]
    for i in range(depth):
        rounds.append(f"""m{i} AS (SELECT l.node // 2 AS parent, l.prediction FROM pr{i} l JOIN pr{i} r
       ON l.node % 2 = 0 AND r.node = l.node + 1 AND l.prediction = r.prediction),
pr{i + 1} AS (SELECT * FROM pr{i} WHERE node // 2 NOT IN (SELECT parent FROM m{i})
       UNION ALL SELECT parent AS node, prediction FROM m{i})""")
    splits = " + ".join(f"(SELECT count(*) FROM b{L})" for L in range(depth))
    merges = " + ".join(f"(SELECT count(*) FROM m{i})" for i in range(depth))
    rounds.append(f"""shape AS (SELECT CAST(max(floor(log2(node))) AS INTEGER) AS depth,
       CAST(2 * ({splits}) + 1 - 2 * ({merges}) AS INTEGER) AS num_nodes FROM pr{depth})""")
    return ",\n".join(rounds)
