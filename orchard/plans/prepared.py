"""Prepared model inputs: view -> split -> fitted features, shared by queries."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orchard.functions.hashing import md5_unit, row_key
from orchard.operators.common import reliable
from orchard.operators.features import PageFeatures, fit_page_features
from orchard.operators.sparse import SparsePages, fit_sparse_naive_bayes, fit_sparse_pages
from orchard.operators.split import assign_split
from orchard.sources import views as V


@dataclass
class Prepared:
    frame: DataFrame          # keys..., label, features, split, u
    features: PageFeatures | None
    dim: int
    key: list[str]

    def part(self, name: str) -> DataFrame:
        return self.frame.where(F.col("split") == name)

    def train_validation(self) -> DataFrame:
        return self.frame.where(F.col("split").isin("train", "validation"))


def binary(spark: SparkSession, sf_dir: str, nb: bool = False,
           scale: bool = True, reuse: bool = False) -> Prepared:
    """``binary_big`` with one-hot category ++ 4 numbers.

    ``nb=True``: negatives clamped and scaled without centring (features stay
    non-negative for naive Bayes); otherwise standardised.  Dictionary fitted
    on all rows, scaler on the training split.  ``reuse=True`` writes the joined
    view to the checkpoint folder once, for callers that scan it several times.
    """
    key = row_key(*V.BINARY_KEY)
    bb = V.binary_big(spark, sf_dir)
    bb = assign_split(bb, key).withColumn("u", md5_unit(key))
    if reuse:
        bb = reliable(bb)
    pf = fit_page_features(bb, V.BINARY_NUMERIC, with_mean=not nb, clamp=nb, scale=scale,
                           fit_on=F.col("split") == "train")
    out = pf.transform(bb).select(*V.BINARY_KEY, F.col("label").cast("double").alias("label"),
                                  "features", "split", "u")
    return Prepared(out, pf, pf.dim, list(V.BINARY_KEY))


@dataclass
class PreparedPages:
    """Labelled and unlabelled pages with the fitted page features; categories are a table, so a
    page keeps its category and numbers only (``slot, z``)."""

    frame: DataFrame          # doc_id, url, category, numbers, label, split, u, slot, z
    score: DataFrame          # unlabelled pages: doc_id, url, category, numbers, slot, z
    features: SparsePages

    def part(self, name: str) -> DataFrame:
        return self.frame.where(F.col("split") == name)


def pages(spark: SparkSession, sf_dir: str, nb: bool = False,
          refit_scaler: bool = False, score_ids: DataFrame | None = None) -> PreparedPages:
    """Labelled pages (train/validation/test by doc_id) and scored unlabelled pages.

    Unlabelled pages are scored with the training fit; ``refit_scaler=True``
    instead fits a fresh scaler on the unlabelled pages themselves (the
    historical behaviour, kept for comparison).  ``score_ids`` (a short list) limits
    the scored pages before any text is read for them.  The labelled pages' counts
    are written once, so that their texts are read once for all passes.
    """
    key = F.col("doc_id")
    pt = reliable(assign_split(V.page_train(spark, sf_dir), key).withColumn("u", md5_unit(key)))
    pf = fit_sparse_pages(pt, V.PAGE_NUMERIC, centred=not nb, clamp=nb, fit_on=F.col("split") == "train")
    lab = pf.transform(pt).withColumn("label", F.col("label").cast("double"))
    ps = V.page_score(spark, sf_dir, score_ids)
    scored_with = pf
    if refit_scaler:
        own = fit_sparse_pages(ps, V.PAGE_NUMERIC, centred=not nb, clamp=nb)
        scored_with = replace(pf, mean=own.mean, scale=own.scale)
    return PreparedPages(lab, scored_with.transform(ps), pf)


def multi(spark: SparkSession, sf_dir: str) -> Prepared:
    m = V.multi(spark, sf_dir)
    key = F.col("vec_id")
    m = assign_split(m, key).withColumn("u", md5_unit(key))
    return Prepared(m, None, 64, ["vec_id"])


def hourly(spark: SparkSession, sf_dir: str) -> Prepared:
    h = V.hourly(spark, sf_dir)
    key = F.date_format("h", "yyyy-MM-dd HH:mm:ss")
    feats = F.array(*[F.col(c).cast("double") for c in V.HOURLY_FEATURES])
    h = assign_split(h.withColumn("features", feats), key)
    out = h.select("h", F.col("label").cast("double").alias("label"), "features", "split",
                   *V.HOURLY_FEATURES)
    return Prepared(out, None, len(V.HOURLY_FEATURES), ["h"])


def page_naive_bayes(spark: SparkSession, sf_dir: str, smoothing: float,
                     score_ids: DataFrame | None = None):
    """Prepared pages and a naive Bayes model fitted on the train split."""
    prep = pages(spark, sf_dir, nb=True, score_ids=score_ids)
    return prep, fit_sparse_naive_bayes(prep.part("train"), prep.features, smoothing)
