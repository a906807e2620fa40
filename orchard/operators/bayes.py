"""Multinomial naive Bayes from per-class sufficient statistics.

Training is one grouped aggregate (partial per partition, so a class holding
most rows costs nothing extra); every smoothing value is arithmetic on the
same few numbers, so a whole lambda sweep costs one scan.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orchard.operators.common import dot


def _usable(df: DataFrame, dim: int, features: str, label: str) -> DataFrame:
    return df.where((F.size(features) == dim) & F.col(label).isNotNull())


def class_stats(df: DataFrame, dim: int, features: str = "features",
                label: str = "label") -> DataFrame:
    """(label, n, s0..s{d-1}, min_x): count and per-feature sums per class.

    Rows without a full feature vector or without a label do not count.
    """
    df = _usable(df, dim, features, label)
    x = F.col(features)
    aggs = [F.count(F.lit(1)).alias("n")]
    aggs += [F.sum(x.getItem(j)).alias(f"s{j}") for j in range(dim)]
    lows = [F.min(x.getItem(j)) for j in range(dim)]
    aggs.append((F.least(*lows) if dim > 1 else lows[0]).alias("min_x"))
    return df.groupBy(F.col(label).cast("double").alias("label")).agg(*aggs)


@dataclass
class NaiveBayesModel:
    labels: list[float]
    log_prior: list[float]
    log_theta: list[list[float]]
    smoothing: float

    def scores(self, features: str | Column = "features") -> list[Column]:
        return [F.lit(p) + dot(features, th) for p, th in zip(self.log_prior, self.log_theta)]

    def predict_col(self, features: str | Column = "features") -> Column:
        """Label of the highest score; the first (smallest) label wins a tie."""
        s = self.scores(features)
        if len(s) == 1:
            return F.lit(self.labels[0])
        best = F.greatest(*s)
        out = None
        for lab, sc in zip(self.labels, s):
            out = (F.when(sc == best, F.lit(lab)) if out is None
                   else out.when(sc == best, F.lit(lab)))
        return out

    def transform(self, df: DataFrame, features: str = "features",
                  out: str = "prediction") -> DataFrame:
        return df.withColumn(out, self.predict_col(features))


def collect_stats(stats: DataFrame, dim: int) -> list[tuple[float, int, list[float]]]:
    """Bring the per-class statistics (one row per class) to the driver."""
    rows = stats.orderBy("label").collect()
    for r in rows:
        if r["min_x"] is not None and r["min_x"] < 0:
            raise ValueError("naive Bayes needs non-negative features; clamp or "
                             "scale without centring first")
    return [(float(r["label"]), int(r["n"]), [float(r[f"s{j}"] or 0.0) for j in range(dim)])
            for r in rows]


def model_from_stats(stats: list[tuple[float, int, list[float]]],
                     smoothing: float) -> NaiveBayesModel:
    """Multinomial NB: log prior and log feature weights with additive smoothing."""
    if not stats:
        raise ValueError("cannot fit naive Bayes on an empty frame")
    lam = float(smoothing)
    k = len(stats)
    d = len(stats[0][2])
    total = sum(n for _, n, _ in stats)
    pi_den = math.log(total + k * lam)
    labels, prior, theta = [], [], []
    for lab, n, sums in stats:
        labels.append(lab)
        prior.append(math.log(n + lam) - pi_den)
        th_den = math.log(sum(sums) + d * lam)
        theta.append([math.log(s + lam) - th_den for s in sums])
    return NaiveBayesModel(labels, prior, theta, lam)


def fit_stats(df: DataFrame, dim: int, features: str = "features",
              label: str = "label") -> list[tuple[float, int, list[float]]]:
    """Per-class count and feature sums on the driver, one scan.

    Wide vectors go through the long form: ``posexplode`` then
    ``groupBy(label, j)`` (partial-aggregated, so only classes x d rows move).
    """
    from orchard.operators import common
    if dim <= common.WIDE_DIM:
        return collect_stats(class_stats(df, dim, features, label), dim)
    df = _usable(df, dim, features, label)
    long = df.select(F.col(label).cast("double").alias("label"),
                     F.posexplode_outer(features).alias("j", "v")).where(F.col("j").isNotNull())
    rows = long.groupBy("label", "j").agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("s"),
                                          F.min("v").alias("mn")).collect()
    by: dict[float, list] = {}
    for r in rows:
        if r["mn"] is not None and r["mn"] < 0:
            raise ValueError("naive Bayes needs non-negative features; clamp or "
                             "scale without centring first")
        ent = by.setdefault(float(r["label"]), [0, [0.0] * dim])
        if int(r["j"]) == 0:
            ent[0] = int(r["n"])
        ent[1][int(r["j"])] = float(r["s"] or 0.0)
    return [(lab, n, sums) for lab, (n, sums) in sorted(by.items())]


def fit_naive_bayes(df: DataFrame, dim: int, smoothing: float = 1.0,
                    features: str = "features", label: str = "label") -> NaiveBayesModel:
    return model_from_stats(fit_stats(df, dim, features, label), smoothing)


def fit_page_naive_bayes(df: DataFrame, numeric: list[str], smoothing: float = 1.0,
                         category: str = "category", label: str = "label",
                         fit_on: Column | None = None, on_unknown: str = "error"):
    """(PageFeatures, NaiveBayesModel) from one scan; see ``fit_page_stats``."""
    pf, stats = fit_page_stats(df, numeric, category, label, fit_on, on_unknown)
    return pf, model_from_stats(stats, smoothing)


def fit_page_stats(df: DataFrame, numeric: list[str], category: str = "category",
                   label: str = "label", fit_on: Column | None = None,
                   on_unknown: str = "error"):
    """Dictionary, scaler (no centring, negatives clamped) and class statistics in ONE scan.

    Because naive Bayes here sees ``x * (1/std)``, its per-class sums are the
    raw per-class sums times ``1/std``; one ``groupBy(category, label)``
    aggregate therefore carries everything: the categories (all rows), and for
    the ``fit_on`` rows the counts, means and variances (for the scaler) and
    sums (for the classes).  Returns (PageFeatures, per-class statistics); any
    number of smoothing values then cost no further scan.

    The dense form, as ``features.fit_page_features``: the model holds a number per category
    and class on the driver.  ``sparse.fit_sparse_naive_bayes`` keeps them in a table.
    """
    from orchard.functions.prep import strip_quotes
    from orchard.operators.features import (PageFeatures, ScalerModel, _combine, _dictionary,
                                            numeric_slots)
    fit = fit_on if fit_on is not None else F.lit(True)
    nums = numeric_slots(numeric, clamp=True)
    aggs = [F.count_if(fit).alias("n")]
    for j, v in enumerate(nums):
        w = F.when(fit, v)
        aggs += [F.avg(w).alias(f"m{j}"), F.var_samp(w).alias(f"v{j}"), F.sum(w).alias(f"s{j}")]
    g = df.groupBy(strip_quotes(category).alias("category"),
                   F.col(label).cast("double").alias("label")).agg(*aggs)
    rows = g.collect()
    cats = sorted({r["category"] for r in rows if r["category"] is not None})
    index = _dictionary(df.sparkSession, cats)
    live = [r for r in rows if int(r["n"]) > 0]
    n = sum(int(r["n"]) for r in live)
    if n == 0:
        raise ValueError("cannot fit naive Bayes on an empty frame")
    per_cat = {c: 0 for c in cats}
    for r in live:
        if r["category"] is not None:
            per_cat[r["category"]] += int(r["n"])
    mean, std = [], []
    for c in cats:                                     # one-hot slots
        p = per_cat[c] / n
        mean.append(p)
        m2 = per_cat[c] * (1.0 - p) ** 2 + (n - per_cat[c]) * p * p
        std.append((m2 / (n - 1)) ** 0.5 if n > 1 else 0.0)
    for j in range(len(nums)):                         # numeric slots, pooled
        m, s = _combine([(int(r["n"]), float(r[f"m{j}"] or 0.0), float(r[f"v{j}"] or 0.0))
                         for r in live])
        mean.append(m)
        std.append(s)
    scaler = ScalerModel(mean, std, with_mean=False, with_std=True)
    inv = scaler.scale_factors()[1]
    k = len(cats)
    slot = {c: i for i, c in enumerate(cats)}
    classes: dict[float, list] = {}
    for r in live:
        if r["label"] is None:
            continue
        ent = classes.setdefault(float(r["label"]), [0, [0.0] * (k + len(nums))])
        ent[0] += int(r["n"])
        if r["category"] is not None:
            ent[1][slot[r["category"]]] += int(r["n"])
        for j in range(len(nums)):
            ent[1][k + j] += float(r[f"s{j}"] or 0.0)
    stats = [(lab, cnt, [s * f for s, f in zip(sums, inv)])
             for lab, (cnt, sums) in sorted(classes.items())]
    pf = PageFeatures(index, list(numeric), scaler, True, on_unknown)
    return pf, stats
