"""Scoring reports (X6-X9): predictions joined back to identity and text.

Reports are ordinary DataFrames; ``n`` limits only the rows shown, after an
explicit ordering by key, so the same rows come back on every run.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orchard.functions import decode as D
from orchard.operators import evaluate


def score_new_pages(scored: DataFrame, n: int = 10, key: str = "doc_id") -> DataFrame:
    """First ``n`` unlabelled pages by key: url, predicted class and its name."""
    cols = [key] if key == "url" else [key, "url"]
    return (scored.orderBy(*cols).limit(n)
            .select(*cols, "prediction",
                    D.page_class(F.col("prediction").cast("int")).alias("class")))


def labelled_report(scored: DataFrame, key: Sequence[str], n: int = 50,
                    extra: Sequence[Column] = ()) -> DataFrame:
    """First ``n`` labelled rows by key: truth, prediction, right / wrong."""
    return (scored.orderBy(*key).limit(n)
            .select(*key, "label", "prediction", evaluate.correct_flag().alias("result"), *extra))


def land_report(scored: DataFrame, n: int = 20) -> DataFrame:
    """Sampled land rows: six leading features, prediction, truth, right / wrong."""
    x = F.col("features")
    # fixed values: the names under which the report prints its features
    names = ["elevation", "aspect", "slope", "water_vertical", "water_horizontal", "shade_9am"]
    return (scored.orderBy("vec_id").limit(n)
            .select("vec_id", *[x.getItem(i).alias(nm) for i, nm in enumerate(names)],
                    "prediction", "label", evaluate.correct_flag().alias("result")))


def hourly_report(scored: DataFrame, n: int = 200) -> DataFrame:
    """First ``n`` hours: description, prediction, truth, absolute error."""
    from orchard.sources.views import HOURLY_FEATURES
    return (scored.orderBy("h").limit(n)
            .select(F.date_format("h", "yyyy-MM-dd HH:mm:ss").alias("h"),
                    D.hourly_description(*HOURLY_FEATURES).alias("description"),
                    F.col("prediction").cast("int").alias("prediction"),
                    F.col("label").cast("int").alias("label"),
                    evaluate.abs_error().alias("abs_error")))
