"""Class trees whose cost follows the rows.

Spark ML's learner sends, level by level, a dense table of counts for every open node from every
partition; a deep tree has about as many nodes as rows, so that traffic outgrows the rows by far.
Here the rows become blocks of bin numbers once.  While a node holds more than ``LOCAL_ROWS`` rows,
every partition counts (feature, bin, class) for the large nodes only and reducers choose their
splits; the rows of each smaller node are then shuffled together once and its subtree is
grown in a task, all its nodes of a level at a time.

Candidates, gains, ties, stopping and merging of leaves are Spark ML's: candidates come from the
same sample of the rows, and the result is a ``DecisionTreeClassificationModel``, written in the
format in which Spark ML saves trees.
"""

from __future__ import annotations

import json
import time
import uuid

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.classification import DecisionTreeClassificationModel, DecisionTreeClassifier
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orchard.operators.common import persisted
from orchard.session import ensure_checkpoint_dir

LOCAL_ROWS = 32_768
HIST_CELLS = 4_000_000      # counts that a task holds at once
MAX_CLASSES = 100           # what the learner takes unless told
SAMPLED = 10_000            # rows from which the learner takes candidates, at least
SAMPLE_SEEDS = {11: 1478691902}     # of the learner's sample for its own seed


def shape(rows: DataFrame) -> tuple[int, int, int] | None:
    """Rows, features and classes; ``None`` for rows that are the learner's own to refuse."""
    x, y = F.col("features"), F.col("label")
    odd = (x.isNull() | y.isNull() | F.isnan(y) | (y < 0) | (y >= MAX_CLASSES) | (y != F.floor(y))
           | F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))))
    r = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(odd).alias("odd"), F.max("label").alias("top"),
                 F.min(F.size(x)).alias("lo"), F.max(F.size(x)).alias("hi")).first()
    if not r["n"] or r["odd"] or r["lo"] != r["hi"] or not r["lo"] or r["top"] < 1:
        return None
    return int(r["n"]), int(r["lo"]), int(r["top"]) + 1


def candidates(rows: DataFrame, n: int, dim: int, bins: int, seed: int) -> list[np.ndarray]:
    """Thresholds of each feature as the learner takes them: midpoints of all values, or of those where
    the count passes a stride; from all rows, or a sample of max(bins^2, 10,000) of them."""
    need = max(min(bins, n) ** 2, SAMPLED)
    share = need / n if need < n else 1.0
    spark = rows.sparkSession
    some = rows.select("features")
    if share < 1.0:
        drawn = some._jdf.javaRDD().sample(False, share, SAMPLE_SEEDS.get(seed, seed))
        some = DataFrame(spark._jsparkSession.createDataFrame(drawn, some._jdf.schema()), spark)
    expected, splits, eps = share * n, min(bins, n) - 1, float(np.finfo(float).eps)

    def thresholds(part):
        held = part["v"].to_numpy()
        v, c = np.unique(held, return_counts=True)
        c = c.astype(float)
        if expected - len(held) > eps * len(held) * 100:      # zeros are not sent
            at = np.searchsorted(v, 0.0)
            v, c = np.insert(v, at, 0.0), np.insert(c, at, expected - len(held))
        mid = (v[:-1] + v[1:]) / 2.0
        if len(mid) > splits:
            stride = expected / (splits + 1)
            target, seen, taken = stride, np.cumsum(c), []
            for i in range(1, len(v)):
                if abs(seen[i - 1] - target) < abs(seen[i] - target):
                    taken.append(i - 1)
                    target += stride
            mid = mid[taken]
        return part.iloc[:1][["j"]].assign(t=[mid.tolist()])

    long = some.select(F.posexplode("features").alias("j", "v")).where(F.col("v") != 0.0)
    out = [np.zeros(0)] * dim
    for r in long.groupBy("j").applyInPandas(thresholds, "j int, t array<double>").collect():
        out[r["j"]] = np.array(r["t"], float)
    return out


def _impurity(kind: str):
    """Impurity of count rows, summed class by class as the learner does."""
    def of(c, total):
        out = np.full(len(c), 1.0 if kind == "gini" else 0.0)
        with np.errstate(divide="ignore", invalid="ignore"):
            for k in range(c.shape[1]):
                f = c[:, k] / total
                out -= f * f if kind == "gini" else np.where(c[:, k] > 0, f * (np.log(f) / np.log(2.0)), 0.0)
        return np.where(total > 0, out, 0.0)
    return of


def _gains(kind: str):
    """Gain of each split: left counts, counts and impurity of the node; -1 where a side is empty."""
    impurity = _impurity(kind)

    def of(left, whole, imp):
        right = whole - left
        nl, nr = left.sum(1), right.sum(1)
        total = nl + nr
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = imp - (nl / total) * impurity(left, nl) - (nr / total) * impurity(right, nr)
        return np.where((nl > 0) & (nr > 0), gain, -1.0)
    return of


def _packed(rows: DataFrame, cuts: list[np.ndarray], dim: int) -> DataFrame:
    """``n, x, y``: blocks of bin numbers and classes, one row per Arrow batch."""
    kind = np.uint8 if max((len(t) for t in cuts), default=0) < 256 else np.int32
    schema = pa.schema([("n", pa.int32()), ("x", pa.binary()), ("y", pa.binary())])

    def run(it):
        for b in it:
            if b.num_rows:
                v = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
                x = np.stack([np.searchsorted(t, v[:, j]).astype(kind) for j, t in enumerate(cuts)], 1)
                y = b.column(1).to_numpy(zero_copy_only=False).astype(np.uint8)
                yield pa.record_batch([pa.array([len(x)], pa.int32()), pa.array([x.tobytes()]), pa.array([y.tobytes()])],
                                      schema=schema)
    return rows.select("features", F.col("label").cast("double")).mapInArrow(run, "n int, x binary, y binary")


class _Tree:
    """Nodes in the order in which they were made: parents before children."""

    def __init__(self, stats, impurity):
        self.stats, self.impurity, self.depth = [np.asarray(stats, float)], [float(impurity)], [0]
        self.feature, self.cut, self.gain, self.left = [-1], [0], [-1.0], [-1]      # the right child is left + 1

    def split(self, i, feature, cut, gain, left, impurities):
        self.feature[i], self.cut[i], self.gain[i], self.left[i] = feature, cut, gain, len(self.stats)
        self.stats += [left, self.stats[i] - left]
        self.impurity += list(impurities)
        self.depth += [self.depth[i] + 1] * 2
        for held, v in ((self.feature, -1), (self.cut, 0), (self.gain, -1.0), (self.left, -1)):
            held += [v, v]

    def router(self):
        """Node of each row, from its bins."""
        feature, cut, left = (np.array(v) for v in (self.feature, self.cut, self.left))

        def of(x):
            at = np.zeros(len(x), np.int64)
            live = np.arange(len(x)) if feature[0] >= 0 else np.zeros(0, np.int64)
            while len(live):
                a = at[live]
                a = left[a] + (x[live, feature[a]] > cut[a])
                at[live] = a
                live = live[feature[a] >= 0]
            return at
        return of


def _level(blocks: DataFrame, tree: _Tree, ask: list[int], kind: str, sizes: list[int], classes: int) -> list:
    """Best split of each node asked for: ``node, gain, feature, cut, left`` counts."""
    route, gains, impurity, dim = tree.router(), _gains(kind), _impurity(kind), len(sizes)
    slot = np.full(len(tree.stats), -1)
    slot[ask] = np.arange(len(ask))
    whole = np.array([tree.stats[i] for i in ask])
    imps = np.array([tree.impurity[i] for i in ask])
    wide = np.uint8 if max(sizes) <= 256 else np.int32
    schema = pa.schema([("s", pa.int32()), ("j", pa.int32()), ("c", pa.list_(pa.int64()))])
    best_schema = pa.schema([("s", pa.int32()), ("gain", pa.float64()), ("j", pa.int32()), ("cut", pa.int32()),
                             ("l", pa.list_(pa.float64()))])

    def partial(it):
        hist = [np.zeros(len(ask) * b * classes, np.int64) for b in sizes]
        for r in (r for b in it for r in b.to_pylist()):
            x, y = np.frombuffer(r["x"], wide).reshape(-1, dim), np.frombuffer(r["y"], np.uint8)
            s = slot[route(x)]
            held = np.flatnonzero(s >= 0)
            x, y, s = x[held], y[held].astype(np.int64), s[held]
            for j, b in enumerate(sizes):
                hist[j] += np.bincount((s * b + x[:, j]) * classes + y, minlength=len(hist[j]))
        for i in range(len(ask)):
            out = [h.reshape(len(ask), -1)[i] for h in hist]
            if out[0].any():
                yield pa.record_batch([pa.array([i] * dim, pa.int32()), pa.array(range(dim), pa.int32()),
                                       pa.array(out, pa.list_(pa.int64()))], schema=schema)

    def best(it):
        sums: dict[tuple[int, int], np.ndarray] = {}
        for b in it:
            for i, j, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                sums[i, j] = sums.get((i, j), 0) + c.values.to_numpy()
        for i in sorted({i for i, _ in sums}):
            top = None
            for j, size in enumerate(sizes):
                left = np.cumsum(sums[i, j].reshape(size, classes), 0)[:-1].astype(float)
                if len(left):
                    g = gains(left, whole[i], imps[i])
                    k = int(np.argmax(g))
                    if g[k] > (top[0] if top else 0.0):
                        top = (g[k], j, k, left[k])
            if top:
                yield pa.record_batch([pa.array([v], f.type) for v, f in zip((i, *top), best_schema)], schema=best_schema)

    found = blocks.mapInArrow(partial, "s int, j int, c array<bigint>").repartition(min(len(ask), 64), "s").mapInArrow(
        best, "s int, gain double, j int, cut int, l array<double>").collect()
    return [(ask[r["s"]], r["gain"], r["j"], r["cut"], np.array(r["l"])) for r in sorted(found, key=lambda r: r["s"])]


def _subtrees(blocks: DataFrame, tree: _Tree, open_nodes: list[int], kind: str, sizes: list[int], classes: int,
              max_depth: int) -> list:
    """The subtree of each small node, grown where its rows meet: arrays over its nodes as bytes."""
    route, gains, impurity, dim = tree.router(), _gains(kind), _impurity(kind), len(sizes)
    wide = np.uint8 if max(sizes) <= 256 else np.int32
    wanted = np.zeros(len(tree.stats), bool)
    wanted[open_nodes] = True
    depth = np.array(tree.depth)
    eps = float(np.finfo(float).eps)
    schema = pa.schema([("node", pa.int32()), ("x", pa.binary()), ("y", pa.binary())])

    def dealt(it):
        for r in (r for b in it for r in b.to_pylist()):
            x, y = np.frombuffer(r["x"], wide).reshape(-1, dim), np.frombuffer(r["y"], np.uint8)
            at = route(x)
            order = np.argsort(at, kind="stable")
            ends = np.flatnonzero(np.diff(at[order])) + 1
            parts = [p for p in np.split(order, ends) if wanted[at[p[0]]]]
            if parts:
                yield pa.record_batch([pa.array([int(at[p[0]]) for p in parts], pa.int32()),
                                       pa.array([x[p].tobytes() for p in parts]), pa.array([y[p].tobytes() for p in parts])],
                                      schema=schema)

    def best_of(x, y, s, whole, imps):
        """Best gain, feature, cut and left counts of each slot over its rows."""
        n = len(whole)
        top, feature, cut, left = np.zeros(n), np.full(n, -1), np.zeros(n, np.int64), np.zeros((n, classes))
        for j, size in enumerate(sizes):
            if size < 2:
                continue
            cell = np.sort((s * size + x[:, j]) * classes + y)
            at = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
            count, cell = np.diff(np.r_[at, len(cell)]), cell[at]
            value = cell // classes
            new = np.r_[True, value[1:] != value[:-1]]
            h = np.zeros((int(new.sum()), classes))
            h[np.cumsum(new) - 1, cell % classes] = count
            value = value[new]
            node = value // size
            first = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
            sums = np.cumsum(h, 0)
            low = sums - (sums[first] - h[first])[node]
            g = gains(low, whole[node], imps[node])
            most = np.maximum.reduceat(g, first)
            hit = np.flatnonzero(g == most[node])[::-1]
            pick = np.zeros(n, np.int64)
            pick[node[hit]] = hit                     # the first of equal ones
            better = most > top
            pick = pick[better]
            top[better], feature[better], cut[better], left[better] = g[pick], j, value[pick] % size, low[pick]
        return top, feature, cut, left

    def grow(part):
        node = int(part["node"].iloc[0])
        x = np.concatenate([np.frombuffer(v, wide) for v in part["x"]]).reshape(-1, dim)
        y = np.concatenate([np.frombuffer(v, np.uint8) for v in part["y"]]).astype(np.int64)
        stats = np.bincount(y, minlength=classes).astype(float)[None]
        made = dict(stats=[stats], impurity=[impurity(stats, stats.sum(1))], feature=[], cut=[], gain=[], left=[])
        s, total = np.zeros(len(y), np.int64), 1
        is_open = np.ones(1, bool)
        for level in range(int(depth[node]), max_depth + 1):
            whole, imps, n = made["stats"][-1], made["impurity"][-1], len(is_open)
            feature, cut, gain, child = np.full(n, -1), np.zeros(n, np.int64), np.full(n, -1.0), np.full(n, -1)
            at = np.flatnonzero(is_open)
            if level < max_depth and len(at):
                held = is_open[s]
                x, y, s = x[held], y[held], (np.cumsum(is_open) - 1)[s[held]]
                top, f, c, left = best_of(x, y, s, whole[at], imps[at])
                yes = np.flatnonzero(f >= 0)
                feature[at[yes]], cut[at[yes]], gain[at[yes]] = f[yes], c[yes], top[yes]
                child[at[yes]] = total + 2 * np.arange(len(yes))
                number = np.full(len(at), -1)
                number[yes] = np.arange(len(yes))
                held = number[s] >= 0
                x, y, s = x[held], y[held], s[held]
                s = 2 * number[s] + (x[np.arange(len(x)), f[s]] > c[s])
            else:
                yes = np.zeros(0, np.int64)
            for k, v in (("feature", feature), ("cut", cut), ("gain", gain), ("left", child)):
                made[k].append(v)
            if not len(yes):
                break
            below = np.empty((2 * len(yes), classes))
            below[0::2], below[1::2] = left[yes], whole[at[yes]] - left[yes]
            made["stats"].append(below)
            made["impurity"].append(impurity(below, below.sum(1)))
            is_open = np.abs(made["impurity"][-1]) >= eps
            total += len(below)
        return part.iloc[:1][["node"]].assign(**{k: [np.concatenate(v).astype(
            float if k in ("stats", "impurity", "gain") else np.int64).tobytes()] for k, v in made.items()})

    tasks = min(len(open_nodes), max(1, int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    rows = blocks.mapInArrow(dealt, "node int, x binary, y binary").repartition(tasks, "node")
    return rows.groupBy("node").applyInPandas(
        grow, "node int, stats binary, impurity binary, feature binary, cut binary, gain binary, left binary").collect()


def _preorder(tree: _Tree, subtrees: list) -> dict[str, np.ndarray]:
    """All nodes with subtrees in place, sibling leaves that predict the same merged, in preorder."""
    stats, imp = np.array(tree.stats), np.array(tree.impurity)
    feature, cut, gain, left = (np.array(v) for v in (tree.feature, tree.cut, tree.gain, tree.left))
    more = {"stats": [stats], "imp": [imp], "feature": [feature], "cut": [cut], "gain": [gain], "left": [left]}
    size = len(feature)
    for r in sorted(subtrees, key=lambda r: r["node"]):
        f, c, l = (np.frombuffer(r[k], np.int64) for k in ("feature", "cut", "left"))
        g, i, s = (np.frombuffer(r[k]) for k in ("gain", "impurity", "stats"))
        if f[0] < 0:
            continue
        shift = size - 1                              # the subtree's root is the node itself
        at = r["node"]
        feature[at], cut[at], gain[at], left[at] = f[0], c[0], g[0], l[0] + shift
        for k, v in (("stats", s.reshape(len(f), -1)), ("imp", i), ("feature", f), ("cut", c), ("gain", g)):
            more[k].append(v[1:])
        more["left"].append(np.where(l[1:] >= 0, l[1:] + shift, -1))
        size += len(f) - 1
    out = {k: np.concatenate(v) for k, v in more.items()}
    guess, child = np.argmax(out["stats"], 1), out["left"].tolist()
    same = guess.tolist()
    for i in np.flatnonzero(out["left"] >= 0)[::-1].tolist():       # children come after parents
        a = child[i]
        if child[a] < 0 and child[a + 1] < 0 and same[a] == same[a + 1]:
            child[i] = -1
    order, stack, number = [], [0], {}
    while stack:
        i = stack.pop()
        number[i] = len(order)
        order.append(i)
        if child[i] >= 0:
            stack += [child[i] + 1, child[i]]
    kept = {k: v[order] for k, v in out.items()}
    kept["prediction"] = guess[order].astype(float)
    kept["left"] = np.array([number[child[i]] if child[i] >= 0 else -1 for i in order])
    kept["right"] = np.array([number[child[i] + 1] if child[i] >= 0 else -1 for i in order])
    return kept


def _model(spark, nodes: dict[str, np.ndarray], cuts: list[np.ndarray], dim: int, classes: int,
           params: dict) -> DecisionTreeClassificationModel:
    path = f"{ensure_checkpoint_dir(spark)}/grown-{uuid.uuid4().hex}"
    DecisionTreeClassifier(**params).write().save(path)
    told = json.loads(spark.read.text(f"{path}/metadata").first()[0])
    told.update({"class": "org.apache.spark.ml.classification.DecisionTreeClassificationModel",
                 "numFeatures": dim, "numClasses": classes, "timestamp": int(time.time() * 1000)})
    inner = nodes["left"] >= 0
    split = [{"featureIndex": int(f), "leftCategoriesOrThreshold": [float(cuts[f][c])], "numCategories": -1} if i
             else {"featureIndex": -1, "leftCategoriesOrThreshold": [], "numCategories": -1}
             for i, f, c in zip(inner, nodes["feature"], nodes["cut"])]
    table = pa.table({
        "id": pa.array(np.arange(len(inner)), pa.int32()), "prediction": nodes["prediction"], "impurity": nodes["imp"],
        "impurityStats": pa.array(list(nodes["stats"]), pa.list_(pa.float64())),
        "rawCount": pa.array(nodes["stats"].sum(1).astype(np.int64)),
        "gain": np.where(inner, nodes["gain"], -1.0), "leftChild": pa.array(nodes["left"], pa.int32()),
        "rightChild": pa.array(nodes["right"], pa.int32()),
        "split": pa.array(split, pa.struct([("featureIndex", pa.int32()), ("leftCategoriesOrThreshold", pa.list_(pa.float64())),
                                            ("numCategories", pa.int32())]))})
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    try:
        spark.createDataFrame([(json.dumps(told),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/metadata")
        spark.createDataFrame(table).write.parquet(f"{path}/data")
        return DecisionTreeClassificationModel.load(path)
    finally:
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def class_tree(rows: DataFrame, n: int, dim: int, classes: int, params: dict) -> DecisionTreeClassificationModel:
    """The tree of ``DecisionTreeClassifier(**params)`` over ``rows`` (features array, label)."""
    kind, depth = params["impurity"], params["maxDepth"]
    cuts = candidates(rows, n, dim, params["maxBins"], params["seed"])
    sizes = [len(t) + 1 for t in cuts]
    eps = float(np.finfo(float).eps)
    impurity = _impurity(kind)
    counts = {int(r["label"]): r["count"] for r in rows.groupBy("label").count().collect()}
    stats = np.array([[counts.get(k, 0) for k in range(classes)]], float)
    tree = _Tree(stats[0], impurity(stats, stats.sum(1))[0])
    blocks = _packed(rows, cuts, dim)
    with persisted(blocks, level=StorageLevel.MEMORY_AND_DISK):
        front, small = [0], []
        per = max(1, HIST_CELLS // (sum(sizes) * classes))
        while front:
            front = [i for i in front if tree.depth[i] < depth and abs(tree.impurity[i]) >= eps]
            small += [i for i in front if tree.stats[i].sum() <= LOCAL_ROWS]
            large = [i for i in front if tree.stats[i].sum() > LOCAL_ROWS]
            found = [r for k in range(0, len(large), per) for r in _level(blocks, tree, large[k:k + per], kind, sizes, classes)]
            front = []
            for i, gain, j, cut, left in found:
                both = np.stack([left, tree.stats[i] - left])
                front += [len(tree.stats), len(tree.stats) + 1]
                tree.split(i, j, cut, gain, left, impurity(both, both.sum(1)))
        below = _subtrees(blocks, tree, small, kind, sizes, classes, depth) if small else []
    return _model(rows.sparkSession, _preorder(tree, below), cuts, dim, classes, params)
