"""Metrics as aggregates (E1-E5).  Many models are scored in one scan."""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def _count_if(cond: Column) -> Column:
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("bigint")


def auc_from_counts(tp, pos, tn, neg) -> Column:
    """Area under the ROC of hard 0/1 predictions = (TPR + TNR) / 2.

    NULL when one class is absent from the truth.
    """
    tp, pos, tn, neg = map(_c, (tp, pos, tn, neg))
    return F.when((pos > 0) & (neg > 0),
                  (tp.cast("double") / pos + tn.cast("double") / neg) / F.lit(2.0))


def _auc_counts(prediction: str, label: str) -> list[Column]:
    p, y = F.col(prediction), F.col(label)
    return [F.count(F.lit(1)).alias("n"),
            _count_if((p == 1) & (y == 1)).alias("tp"),
            _count_if(y == 1).alias("pos"),
            _count_if((p == 0) & (y == 0)).alias("tn"),
            _count_if(y == 0).alias("neg")]


def auc_hard(df: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """One row: n, auc_hard."""
    counts = df.agg(*_auc_counts(prediction, label))
    return counts.select("n", auc_from_counts("tp", "pos", "tn", "neg").alias("auc_hard"))


def auc_hard_by(df: DataFrame, by: str, prediction: str = "prediction",
                label: str = "label") -> DataFrame:
    """One row per value of ``by`` (e.g. the split): by, n, auc_hard — one aggregate."""
    counts = df.groupBy(by).agg(*_auc_counts(prediction, label))
    return counts.select(by, "n", auc_from_counts("tp", "pos", "tn", "neg").alias("auc_hard"))


def accuracy(df: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """One row: n, accuracy = share of rows predicted right."""
    return df.agg(F.count(F.lit(1)).alias("n"),
                  F.avg(F.when(F.col(prediction) == F.col(label), 1.0).otherwise(0.0))
                  .alias("accuracy"))


def accuracy_by(df: DataFrame, by: str, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """One row per value of ``by``: by, n, accuracy."""
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("n"),
                              F.avg(F.when(F.col(prediction) == F.col(label), 1.0).otherwise(0.0)).alias("accuracy"))


def rmse_by(df: DataFrame, by: str, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """One row per value of ``by``: by, n, rmse."""
    e = F.col(prediction).cast("double") - F.col(label).cast("double")
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("n"), F.sqrt(F.avg(e * e)).alias("rmse"))


def rmse(df: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """One row: n, rmse."""
    e = F.col(prediction).cast("double") - F.col(label).cast("double")
    return df.agg(F.count(F.lit(1)).alias("n"), F.sqrt(F.avg(e * e)).alias("rmse"))


def correct_flag(prediction: str = "prediction", label: str = "label") -> Column:
    """'right' / 'wrong' (E4)."""
    return F.when(F.col(prediction).cast("double") == F.col(label).cast("double"),
                  F.lit("right")).otherwise(F.lit("wrong"))


def abs_error(prediction: str = "prediction", label: str = "label") -> Column:
    """|label - prediction| (E5)."""
    return F.abs(F.col(label).cast("double") - F.col(prediction).cast("double"))


def binary_counts_many(df: DataFrame, predictions: Mapping[str, Column],
                       label: str = "label") -> dict[str, dict[str, int]]:
    """tp/tn per model plus pos/neg in a single aggregate over ``df``."""
    y = F.col(label)
    aggs = [_count_if(y == 1).alias("pos"), _count_if(y == 0).alias("neg")]
    names = list(predictions)
    for i, name in enumerate(names):
        p = predictions[name]
        aggs += [_count_if((p == 1) & (y == 1)).alias(f"tp{i}"),
                 _count_if((p == 0) & (y == 0)).alias(f"tn{i}")]
    row = df.agg(*aggs).first()
    return {n: {"tp": row[f"tp{i}"], "tn": row[f"tn{i}"], "pos": row["pos"], "neg": row["neg"]}
            for i, n in enumerate(names)}


def auc_value(c: Mapping[str, int]) -> float | None:
    if not c["pos"] or not c["neg"]:
        return None
    return (c["tp"] / c["pos"] + c["tn"] / c["neg"]) / 2.0


def metric_many(df: DataFrame, predictions: Mapping[str, Column], metric: str,
                label: str = "label") -> dict[str, float | None]:
    """One of auc_hard / accuracy / rmse for many prediction columns, one scan."""
    if metric == "auc_hard":
        return {k: auc_value(v) for k, v in binary_counts_many(df, predictions, label).items()}
    y = F.col(label).cast("double")
    names = list(predictions)
    aggs = []
    for i, n in enumerate(names):
        p = predictions[n].cast("double")
        if metric == "accuracy":
            aggs.append(F.avg(F.when(p == y, 1.0).otherwise(0.0)).alias(f"m{i}"))
        elif metric == "rmse":
            aggs.append(F.sqrt(F.avg((p - y) * (p - y))).alias(f"m{i}"))
        else:
            raise ValueError(metric)
    row = df.agg(*aggs).first()
    return {n: row[f"m{i}"] for i, n in enumerate(names)}
