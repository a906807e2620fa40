"""Page models over a category column of any size.

The dense pipeline (``features.PageFeatures``) gives every category a slot in every
row and keeps its statistics on the driver.  Here a row keeps its category and the
numeric block only, and whatever belongs to a category (number, share, scale, weights,
class counts) is a row of a table.  The slots that a row does not hold enter through
sums over that table, so results equal those of the dense form: the same scaler, the
same gradient steps, the same class statistics.

Training is co-partitioned: rows are written once, hash-partitioned by (slot, part) and
sorted, and so is the category table, hence a gradient step joins them where they lie.
A category with more than a partition's share of the rows is split into parts, each
with its own copy of the category's row; there are fewer such categories than
partitions.  A step moves one row per category, never a row of the input.

Unknown categories (not in the fitted table, or NULL) have no slot.
"""

from __future__ import annotations

import math
import time
from dataclasses import dataclass
from typing import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orchard.functions.prep import strip_quotes
from orchard.operators.common import (dense_numbers, join_small, laid_out, lit_array, reliable, shuffle_partitions,
                                      static_plans, written)
from orchard.operators.features import numeric_slots
from orchard.operators.linear import CONVERGENCE_TOL, SgdConfig, step_flag

# Rows of a partition of the layout, as long as the session's shuffle partitions are enough for that.
PARTITION_ROWS = 50_000


@dataclass
class SparsePages:
    """``table(slot, part, idx, parts, p, s)``: number, share of the fit rows and 1/std (0 if
    constant) of each category, once per part, laid out by (slot, part)."""

    table: DataFrame
    size: int
    numeric: list[str]
    mean: list[float]
    scale: list[float]
    centred: bool
    clamp: bool
    partitions: int

    @property
    def dim(self) -> int:
        return self.size + len(self.numeric)

    @property
    def categories(self) -> DataFrame:
        """``slot, idx, p, s``, one row per category."""
        return self.table.where("part = 0").select("slot", "idx", "p", "s")

    @property
    def hot(self) -> DataFrame:
        """``slot, parts`` of the categories that are split: fewer than there are partitions."""
        return self.table.where("part = 0 and parts > 1").select("slot", "parts")

    def transform(self, df: DataFrame, category: str = "category") -> DataFrame:
        """Add ``slot`` (the category), ``z`` (scaled numbers) and keep the other columns."""
        z = [(v - F.lit(m)) * F.lit(s) for v, m, s in
             zip(numeric_slots(self.numeric, clamp=self.clamp), self.mean, self.scale)]
        return df.withColumn("slot", strip_quotes(category)).withColumn("z", F.array(*z).cast("array<double>"))

    def lay_out(self, rows: DataFrame) -> DataFrame:
        """Transformed rows written beside their category's row; rows of a split category and
        rows without one are dealt to its parts."""
        dealt = rows.join(F.broadcast(self.hot), "slot", "left")
        parts = F.when(F.col("slot").isNull(), F.lit(self.partitions)).otherwise(F.coalesce("parts", F.lit(1)))
        part = F.pmod(F.monotonically_increasing_id(), parts.cast("long")).cast("int")
        return laid_out(dealt.withColumn("part", part).drop("parts"), self.partitions, "slot", "part")

    def long(self, rows: DataFrame, *keys: str) -> DataFrame:
        """Transformed rows as ``keys, j, value``: every slot of the dense form, then the numbers."""
        k, d = self.size, len(self.numeric)
        shift = F.col("p") if self.centred else F.lit(0.0)
        own = self.categories.select("slot", "idx")
        held = join_small(rows, own, "slot", small_rows=k)
        e = held.select(*keys, "idx", "z", F.explode(F.sequence(F.lit(0), F.lit(k + d - 1))).alias("j"))
        stats = self.categories.select(F.col("idx").alias("j"), shift.alias("p"), "s")
        e = join_small(e, stats, "j", small_rows=k)
        hit = F.when(F.col("j") == F.col("idx"), 1.0).otherwise(0.0)
        value = F.when(F.col("j") < k, (hit - F.col("p")) * F.col("s")).otherwise(F.get("z", F.col("j") - k))
        return e.select(*keys, F.col("j").cast("int").alias("j"), value.alias("value"))

    def vectors(self, df: DataFrame, category: str = "category", out: str = "fvec") -> DataFrame:
        """``df`` with its unscaled features as a sparse vector: the category's slot and the numbers."""
        k, d = self.size, len(self.numeric)
        own = self.categories.select("slot", "idx")
        rows = join_small(df.withColumn("slot", strip_quotes(category)), own, "slot", small_rows=k)
        return rows.withColumn(out, sparse_vector(F.col("idx"), numeric_slots(self.numeric, clamp=self.clamp), k)) \
            .drop("slot", "idx")


def sparse_vector(idx: Column, numbers: Sequence[Column], k: int) -> Column:
    """Spark ML vector of k indicator slots (``idx`` is 1, all 0 where it is NULL) and the numbers behind them."""
    places = F.array(*[F.lit(k + j) for j in range(len(numbers))])
    values = F.array(*[v.cast("string") for v in numbers])
    held = F.when(idx.isNull(), F.array().cast("array<int>")).otherwise(F.array(idx.cast("int")))
    ones = F.when(idx.isNull(), F.array().cast("array<string>")).otherwise(F.array(F.lit("1.0")))
    text = F.concat(F.lit(f'{{"v":{{"type":0,"size":{k + len(numbers)},"indices":['),
                    F.array_join(F.concat(held, places), ","), F.lit('],"values":['),
                    F.array_join(F.concat(ones, values), ","), F.lit("]}}"))
    return F.from_json(text, T.StructType([T.StructField("v", VectorUDT())]))["v"]


def fit_sparse_pages(df: DataFrame, numeric: Sequence[str], category: str = "category",
                     fit_on: Column | None = None, centred: bool = True, clamp: bool = False,
                     partitions: int | None = None) -> SparsePages:
    """Dictionary over all rows, scaler over the ``fit_on`` rows; one aggregate by category.

    The numbers' means and variances are pooled from those of the categories (Chan et al.)
    by two sums over the category table."""
    fit = fit_on if fit_on is not None else F.lit(True)
    nums = numeric_slots(numeric, clamp=clamp)
    aggs = [F.count(F.lit(1)).alias("rows"), F.count_if(fit).alias("c")]
    for j, v in enumerate(nums):
        aggs += [F.avg(F.when(fit, v)).alias(f"m{j}"), F.var_samp(F.when(fit, v)).alias(f"v{j}")]
    by = reliable(df.groupBy(strip_quotes(category).alias("slot")).agg(*aggs))
    total = by.agg(F.sum("rows").alias("rows"), F.sum("c").alias("n"),
                   *[F.sum(F.col("c") * F.col(f"m{j}")).alias(f"m{j}") for j in range(len(nums))]).first()
    rows, n = int(total["rows"] or 0), int(total["n"] or 0)
    mean = [float(total[f"m{j}"] or 0.0) / max(n, 1) for j in range(len(nums))]
    spread = [F.sum((F.col("c") - 1) * F.coalesce(F.col(f"v{j}"), F.lit(0.0))
                    + F.col("c") * (F.col(f"m{j}") - F.lit(m)) ** 2).alias(f"q{j}") for j, m in enumerate(mean)]
    squares = by.where("c > 0").agg(*spread).first() if nums else {}
    stds = [math.sqrt(max(float(squares[f"q{j}"] or 0.0), 0.0) / (n - 1)) if n > 1 else 0.0 for j in range(len(nums))]
    count = partitions or min(shuffle_partitions(df.sparkSession), max(1, -(-rows // PARTITION_ROWS)))
    p = F.col("c") / F.lit(float(max(n, 1)))
    std = F.sqrt((F.col("c") * (1 - p) * (1 - p) + (F.lit(n) - F.col("c")) * p * p) / F.lit(float(max(n - 1, 1))))
    parts = F.greatest(F.lit(1), F.ceil(F.col("rows") * count / F.lit(max(rows, 1)))).cast("int")
    slots = dense_numbers(by.where("slot is not null").select(
        "slot", parts.alias("parts"), p.alias("p"), F.when(std > 0, 1 / std).otherwise(0.0).alias("s")), "slot", "idx")
    part = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    table = laid_out(slots.select("slot", part, "idx", "parts", "p", "s"), count, "slot", "part")
    return SparsePages(table, table.where("part = 0").count(), list(numeric), mean if centred else [0.0] * len(nums),
                       [1.0 / s if s else 0.0 for s in stds], centred, clamp, count)


# ---- linear models ----------------------------------------------------------------

@dataclass
class SparseLinearModel:
    kind: str
    table: DataFrame            # slot, part, parts, p, s, w (one weight per configuration), laid out
    column: int                 # the configuration's place in w
    numeric: list[float]
    base: float                 # what the slots that a row does not hold add up to
    size: int

    @property
    def weights(self) -> DataFrame:
        return self.table.where("part = 0").select(F.col("slot").alias("category"), "p", "s",
                                                   F.col("w")[self.column].alias("w"))

    def predict_col(self, weight: Column) -> Column:
        """1.0 or 0.0; ``weight`` is the row's own w times s, NULL where it has no slot."""
        m = F.coalesce(weight, F.lit(0.0)) + F.lit(self.base)
        for j, w in enumerate(self.numeric):
            m = m + F.col("z")[j] * F.lit(w)
        score = 1 / (1 + F.exp(-m)) if self.kind == "logistic" else m
        return (score > (0.5 if self.kind == "logistic" else 0.0)).cast("double")

    def transform(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        """``df`` with columns slot and z (``SparsePages.transform``) plus the prediction."""
        w = self.weights.select(F.col("category").alias("slot"), (F.col("w") * F.col("s")).alias("__w"))
        return join_small(df, w, "slot", small_rows=self.size).withColumn(out, self.predict_col(F.col("__w"))).drop("__w")


def _step_sums(joined: DataFrame, kinds: np.ndarray, numeric: np.ndarray, base: np.ndarray,
               fractions: list[float], of: np.ndarray) -> DataFrame:
    """``slot, m0 …, tot``: multiplier sums of runs of rows of a slot, and one row per task with batch
    sizes, multiplier sums and numeric gradient sums of all its rows in ``tot``."""
    c, d = numeric.shape
    names = [f"m{i}" for i in range(c)]
    schema = pa.schema([("slot", pa.string()), *[(m, pa.float64()) for m in names], ("tot", pa.list_(pa.float64()))])

    def run(it):
        n, g, all_m = np.zeros(len(fractions)), np.zeros((c, d)), np.zeros(c)
        for b in it:
            rows = b.num_rows
            if not rows:
                continue
            z = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(rows, d)
            y = b.column(2).to_numpy(zero_copy_only=False)
            inside = np.stack([b.column(5 + k).to_numpy(zero_copy_only=False) for k in range(len(fractions))], axis=1)
            held = b.column(3).is_valid().to_numpy(zero_copy_only=False)
            margin = np.tile(base, (rows, 1)) + z @ numeric.T
            margin[held] += (b.column(3).flatten().to_numpy(zero_copy_only=False).reshape(-1, c)
                             * b.column(4).to_numpy(zero_copy_only=False)[held, None])
            sign = (2.0 * y - 1.0)[:, None]
            with np.errstate(over="ignore"):
                m = np.where(kinds, 1.0 / (1.0 + np.exp(-margin)) - y[:, None],
                             np.where(sign * margin < 1.0, -sign, 0.0)) * inside[:, of]
            n, g, all_m = n + inside.sum(axis=0), g + m.T @ z, all_m + m.sum(axis=0)
            code = pc.fill_null(b.column(0).dictionary_encode().indices, -1).to_numpy(zero_copy_only=False)
            first = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
            sums = np.add.reduceat(m, first, axis=0)
            yield pa.record_batch([b.column(0).take(pa.array(first)), *[pa.array(sums[:, i]) for i in range(c)],
                                   pa.nulls(len(first), pa.list_(pa.float64()))], schema=schema)
        total = np.concatenate([n, all_m, g.ravel()])
        yield pa.record_batch([pa.nulls(1, pa.string()), *[pa.array([0.0])] * c, pa.array([total.tolist()])], schema=schema)

    ddl = ", ".join(["slot string", *[f"{m} double" for m in names], "tot array<double>"])
    return joined.mapInArrow(run, ddl)


def fit_sparse_sgd_many(df: DataFrame, pages: SparsePages, configs: Sequence[SgdConfig], iterations: Sequence[int],
                        label: str = "label", unit: str = "u", tol: float = CONVERGENCE_TOL) -> tuple[dict, dict]:
    """``linear.fit_sgd_many`` with category weights as a table: {(config, T): model}, {T: milliseconds}.

    A step joins the laid-out rows with the laid-out weights in place, sums multipliers by
    category and updates the table; only totals reach the driver.
    """
    unknown = {cfg.kind for cfg in configs} - {"logistic", "hinge"}
    if unknown:
        raise ValueError(f"unknown loss {unknown.pop()!r}")
    t0 = time.perf_counter()
    c, d = len(configs), len(pages.numeric)
    fractions = sorted({cfg.mini_batch_fraction for cfg in configs})
    of = np.array([fractions.index(cfg.mini_batch_fraction) for cfg in configs])
    kinds = np.array([cfg.kind == "logistic" for cfg in configs])
    reg = np.array([cfg.reg_param for cfg in configs])
    keep = ["slot", "z", F.col(label).cast("double").alias("y")] + ([unit] if unit in df.columns else [])
    rows = pages.lay_out(df.select(*keep).where(F.col("y").isNotNull()))
    hot = df.sparkSession.createDataFrame(pages.hot.collect(), "slot string, parts int")
    table = pages.table.select("slot", "part", "parts", "p", "s", lit_array(np.zeros(c)).alias("w"))
    numeric, base, done = np.zeros((c, d)), np.zeros(c), np.zeros(c, bool)
    models, took = {}, {}
    for t in range(1, max(iterations, default=0) + 1):
        if not done.all():
            flags = [step_flag(unit, t, f).cast("double").alias(f"__b{k}") for k, f in enumerate(fractions)]
            joined = rows.join(table.select("slot", "part", "w", "s"), ["slot", "part"], "left")
            with written(_step_sums(joined.select("slot", "z", "y", "w", "s", *flags),
                                    kinds, numeric, base, fractions, of)) as sums:
                tot = np.sum([r["tot"] for r in sums.where("tot is not null").select("tot").collect()], axis=0)
                n, all_m = tot[:len(fractions)][of], tot[len(fractions):len(fractions) + c]
                g = tot[len(fractions) + c:].reshape(c, d)
                moves = (n > 0) & ~done
                eta = np.array([cfg.step_size for cfg in configs]) / math.sqrt(t)
                rate = np.where(moves, eta / np.maximum(n, 1), 0.0)
                shrink = np.where(moves, 1.0 - eta * reg, 1.0)
                by = sums.where("tot is null and slot is not null").groupBy("slot").agg(
                    *[F.sum(f"m{i}").alias(f"m{i}") for i in range(c)])
                parts = F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)).alias("part")
                by = by.join(F.broadcast(hot), "slot", "left").select("slot", parts, F.array(
                    *[f"m{i}" for i in range(c)]).alias("m"))
                mine = F.arrays_zip(F.col("w"), F.coalesce(F.col("m"), lit_array(np.zeros(c))).alias("m"))
                step = F.arrays_zip(lit_array(shrink).alias("shrink"), lit_array(rate).alias("rate"),
                                    lit_array(all_m if pages.centred else np.zeros(c)).alias("all"))
                new_w = F.zip_with(mine, step, lambda a, b: b["shrink"] * a["w"] - b["rate"] * F.col("s") * (
                    a["m"] - F.col("p") * b["all"]))
                with static_plans(df.sparkSession):
                    table = reliable(table.join(by, ["slot", "part"], "left").select(
                        "slot", "part", "parts", "p", "s", new_w.alias("w"), F.col("w").alias("old")))
            at = table.where("part = 0")
            r = at.agg(*[e.alias(f"{name}{i}") for i in range(c) for name, e in (
                ("k", F.sum(F.col("w")[i] * F.col("p") * F.col("s"))), ("q", F.sum(F.col("w")[i] ** 2)),
                ("d", F.sum((F.col("w")[i] - F.col("old")[i]) ** 2)))]).first()
            new = shrink[:, None] * numeric - rate[:, None] * g
            for i in np.flatnonzero(moves):
                diff = math.sqrt((r[f"d{i}"] or 0.0) + float(((new[i] - numeric[i]) ** 2).sum()))
                size = math.sqrt((r[f"q{i}"] or 0.0) + float((new[i] ** 2).sum()))
                done[i] = t > 1 and diff < tol * max(size, 1.0)
            numeric = new
            base = np.array([-(r[f"k{i}"] or 0.0) if pages.centred else 0.0 for i in range(c)])
            table = table.drop("old")
        if t in iterations:
            took[t] = (time.perf_counter() - t0) * 1000.0
            for i, cfg in enumerate(configs):
                models[cfg, t] = SparseLinearModel(cfg.kind, table, i, numeric[i].tolist(), float(base[i]), pages.size)
    return models, took


def fit_sparse_sgd(df: DataFrame, pages: SparsePages, kind: str, num_iterations: int, step_size: float,
                   reg_param: float = 0.0, mini_batch_fraction: float = 1.0, label: str = "label",
                   unit: str = "u", tol: float = CONVERGENCE_TOL) -> SparseLinearModel:
    """One model: the steps of ``linear.fit_sgd``."""
    cfg = SgdConfig(kind, float(step_size), float(reg_param), float(mini_batch_fraction))
    return fit_sparse_sgd_many(df, pages, [cfg], [num_iterations], label, unit, tol)[0][cfg, num_iterations]


def predict_sparse_many(df: DataFrame, pages: SparsePages, models: dict[str, SparseLinearModel]) -> tuple[
        DataFrame, dict[str, Column]]:
    """``df`` laid out and joined in place with every weight table that the models use, and one
    prediction column for each model."""
    out = pages.lay_out(df)
    tables, cols = [], {}
    for name, m in models.items():
        if not any(m.table is t for t in tables):
            tables.append(m.table)
            own = m.table.select("slot", "part", F.col("w").alias(f"__w{len(tables) - 1}"),
                                 F.col("s").alias(f"__s{len(tables) - 1}"))
            out = out.join(own, ["slot", "part"], "left")
        k = next(i for i, t in enumerate(tables) if t is m.table)
        cols[name] = m.predict_col(F.col(f"__w{k}")[m.column] * F.col(f"__s{k}"))
    return out, cols


# ---- naive Bayes ------------------------------------------------------------------

@dataclass
class SparseClassStats:
    """Class counts and sums (A7): numbers per class here, category counts per class in ``table``."""

    labels: list[float]
    n: list[int]
    sums: list[list[float]]     # of the scaled numbers
    mass: list[float]           # of all scaled category slots together
    table: DataFrame            # slot, s, c (a count for each label)
    dim: int
    size: int

    def model(self, smoothing: float) -> SparseNaiveBayes:
        lam, total, k = float(smoothing), sum(self.n), len(self.labels)
        prior = [math.log(n + lam) - math.log(total + k * lam) for n in self.n]
        den = [math.log(mass + sum(s) + self.dim * lam) for mass, s in zip(self.mass, self.sums)]
        return SparseNaiveBayes(self.labels, prior, [[math.log(v + lam) - den[i] for v in s]
                                                     for i, s in enumerate(self.sums)], den, lam, self.table, self.size)


@dataclass
class SparseNaiveBayes:
    labels: list[float]
    log_prior: list[float]
    numeric: list[list[float]]
    log_total: list[float]
    smoothing: float
    counts: DataFrame           # slot, s, c; unknown categories add nothing
    size: int

    def _theta(self, i: int, s: Column, c: Column) -> Column:
        return F.log(c[i] * s + F.lit(self.smoothing)) - F.lit(self.log_total[i])

    @property
    def table(self) -> DataFrame:
        """``category, s, theta`` (one value per label)."""
        s, c = F.col("s"), F.col("c")
        return self.counts.select(F.col("slot").alias("category"), "s", F.array(
            *[self._theta(i, s, c) for i in range(len(self.labels))]).alias("theta"))

    def predict_col(self, s: Column, c: Column) -> Column:
        """Label of the highest score, the smallest of equal ones; NULL s and c add nothing."""
        scores = []
        for i, prior in enumerate(self.log_prior):
            sc = F.lit(prior) + F.coalesce(s * self._theta(i, s, c), F.lit(0.0))
            for j, th in enumerate(self.numeric[i]):
                sc = sc + F.col("z")[j] * F.lit(th)
            scores.append(sc)
        best = F.greatest(*scores) if len(scores) > 1 else scores[0]
        return F.coalesce(*[F.when(sc == best, F.lit(lab)) for lab, sc in zip(self.labels, scores)])

    def attach(self, df: DataFrame) -> DataFrame:
        """Rows with their category's scale and counts in ``__s`` and ``__c``."""
        t = self.counts.select("slot", F.col("s").alias("__s"), F.col("c").alias("__c"))
        return join_small(df, t, "slot", small_rows=self.size)

    def transform(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        return self.attach(df).withColumn(out, self.predict_col(F.col("__s"), F.col("__c"))).drop("__s", "__c")


def fit_sparse_stats(df: DataFrame, pages: SparsePages, label: str = "label") -> SparseClassStats:
    """Class statistics from one aggregate by (category, class) and sums over its result.
    The features must be scaled without centring and clamped at 0."""
    if pages.centred:
        raise ValueError("naive Bayes needs features scaled without centring")
    d, y = len(pages.numeric), F.col(label).cast("double")
    groups = reliable(df.where(y.isNotNull()).groupBy("slot", y.alias("y")).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(F.col("z")[j]).alias(f"s{j}") for j in range(d)]))
    per_class = (groups.groupBy("y").agg(F.sum("n").alias("n"), *[F.sum(f"s{j}").alias(f"s{j}") for j in range(d)])
                 .orderBy("y").collect())
    if not per_class:
        raise ValueError("cannot fit naive Bayes on an empty frame")
    labels = [float(r["y"]) for r in per_class]
    # one row per category: a count for each class, 0 where it has none
    wide = groups.groupBy("slot").agg(*[F.sum(F.when(F.col("y") == lab, F.col("n"))).alias(f"c{i}")
                                        for i, lab in enumerate(labels)])
    counts = F.array(*[F.coalesce(F.col(f"c{i}"), F.lit(0)) for i in range(len(labels))])
    table = reliable(pages.categories.select("slot", "s").join(wide, "slot", "left").select("slot", "s", counts.alias("c")))
    mass = table.agg(*[F.sum(F.col("c")[i] * F.col("s")).alias(f"v{i}") for i in range(len(labels))]).first()
    return SparseClassStats(labels, [int(r["n"]) for r in per_class],
                            [[float(r[f"s{j}"] or 0.0) for j in range(d)] for r in per_class],
                            [float(mass[f"v{i}"] or 0.0) for i in range(len(labels))], table, pages.dim, pages.size)


def fit_sparse_naive_bayes(df: DataFrame, pages: SparsePages, smoothing: float = 1.0,
                           label: str = "label") -> SparseNaiveBayes:
    """Multinomial naive Bayes with a class count per (category, class) as a table."""
    return fit_sparse_stats(df, pages, label).model(smoothing)
