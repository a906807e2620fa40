"""Exact-quantile binning of features before a tree is fitted.

The learner draws its split candidates from a sample of the rows where a feature has many
values.  Here the candidates are exact: a feature with at most ``bins`` values keeps a
threshold between each two of them, any other gets the values at which its cumulated share
passes 1/bins, 2/bins and so on.  Rows then hold bin numbers, of which there are at most
``bins`` per feature, so every threshold is a candidate and the tree does not depend on a
sample or on the order of the rows.

Thresholds are found by one count per (feature, value), sorted by range partitions; sums over
whole partitions are carried on, so no value list of a feature is one task's work.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orchard.operators.common import lit_array, reliable
from orchard.operators.trees import TreeModel, fit_tree


def quantile_thresholds(df: DataFrame, bins: int, features: str = "features") -> dict[int, list[float]]:
    """Thresholds of each feature, at most ``bins`` - 1 in ascending order; a row is in bin b when b
    of them are smaller than its value.  Features without two values have none."""
    if bins < 2:
        raise ValueError("bins must be >= 2")
    long = df.select(F.posexplode(features).alias("j", "v")).where(F.col("v").isNotNull())
    counts = reliable(long.groupBy("j", "v").agg(F.count(F.lit(1)).alias("n"))
                      .repartitionByRange("j", "v").withColumn("p", F.spark_partition_id()))
    parts = counts.groupBy("j", "p").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("d"))
    # rows before each partition of a feature: one row per (feature, partition)
    before = Window.partitionBy("j").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy("j")
    parts = parts.select("j", "p", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"),
                         F.sum("n").over(every).alias("total"), F.sum("d").over(every).alias("values"))
    within = Window.partitionBy("j", "p").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    at = counts.withColumn("cum", F.sum("n").over(within)).join(parts, ["j", "p"]).withColumn(
        "cum", F.col("cum") + F.col("ahead"))
    step = F.least(F.expr(f"cum * {bins} div total"), F.lit(bins - 1))
    passed = step > F.expr(f"(cum - n) * {bins} div total")
    chosen = at.where((F.col("cum") < F.col("total")) & ((F.col("values") <= bins) | passed))
    out: dict[int, list[float]] = {}
    for r in chosen.select("j", "v").orderBy("j", "v").collect():       # bins - 1 numbers a feature
        out.setdefault(int(r["j"]), []).append(float(r["v"]))
    return out


def bin_col(features: str | Column, thresholds: dict[int, list[float]], dim: int) -> Column:
    """Bin numbers of the features as an array of doubles."""
    x = F.col(features) if isinstance(features, str) else features

    def below(j: int) -> Column:
        return F.size(F.filter(lit_array(thresholds[j]), lambda t: t < x.getItem(j))).cast("double")

    return F.array(*[below(j) if thresholds.get(j) else F.lit(0.0) for j in range(dim)])


@dataclass
class BinnedTree:
    """A tree over bin numbers; transforms rows with the features themselves."""

    tree: TreeModel
    thresholds: dict[int, list[float]]
    dim: int

    @property
    def depth(self) -> int:
        return self.tree.depth

    @property
    def num_nodes(self) -> int:
        return self.tree.num_nodes

    @property
    def fit_ms(self) -> float:
        return self.tree.fit_ms

    def transform(self, df: DataFrame, out: str = "prediction", features: str = "features") -> DataFrame:
        binned = df.withColumn("__bins", bin_col(features, self.thresholds, self.dim))
        return self.tree.transform(binned, out, "__bins").drop("__bins")


def fit_binned_tree(df: DataFrame, dim: int, kind: str = "class", impurity: str = "gini", max_depth: int = 5,
                    max_bins: int = 32, label: str = "label") -> BinnedTree:
    """``trees.fit_tree`` over exact-quantile bins of the features."""
    rows = reliable(df.select("features", label))
    thresholds = quantile_thresholds(rows, max_bins)
    binned = rows.select(bin_col("features", thresholds, dim).alias("features"), label)
    # bins have few values, so the rows' order does not matter to the learner
    return BinnedTree(fit_tree(binned, kind, impurity, max_depth, max_bins, label=label, stable=False), thresholds, dim)
