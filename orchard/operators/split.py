"""Repeatable hash splits and samples.

A row's split is a pure function of its key (md5), so it does not move when
the input is repartitioned, re-read or recomputed after a lost executor.
No shuffle is involved: the split is a projection.
"""

from __future__ import annotations

from fractions import Fraction
from functools import reduce
from math import gcd
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orchard.functions.hashing import md5_bucket, md5_unit, step_unit

SPLIT_NAMES = ("train", "validation", "test")
# Finest division of the 32 hash bits that still leaves buckets even to 1 part in 4,000.
MAX_BUCKETS = 1_000_000


def _int_weights(weights: Sequence[float]) -> list[int]:
    """Whole numbers in exactly the ratio of ``weights`` (floats as they are written).

    Buckets come from 32 hash bits, so weights that need a finer division, and
    negative or all-zero ones, are an error instead of a rounded split.
    """
    fr = [Fraction(str(w)) for w in weights]
    if any(f < 0 for f in fr) or not any(fr):
        raise ValueError(f"weights must be >= 0 and not all 0: {weights}")
    den = reduce(lambda a, b: a * b // gcd(a, b), [f.denominator for f in fr], 1)
    ints = [int(f * den) for f in fr]
    g = reduce(gcd, ints)
    ints = [i // g for i in ints]
    if sum(ints) > MAX_BUCKETS:
        raise ValueError(f"weights {weights} need {sum(ints)} buckets, more than {MAX_BUCKETS}")
    return ints


def split_column(key: Column, weights: Sequence[float] = (8, 1, 1),
                 names: Sequence[str] = SPLIT_NAMES) -> Column:
    """Name of the split of each row: bucket ``md5(key) % sum(w)`` by ranges.

    Weights (8, 1, 1) give buckets 0-7 train, 8 validation, 9 test.
    """
    w = _int_weights(weights)
    b = md5_bucket(key, sum(w))
    out, lo = None, 0
    for name, wi in zip(names, w):
        cond = b < F.lit(lo + wi)
        out = F.when(cond, F.lit(name)) if out is None else out.when(cond, F.lit(name))
        lo += wi
    return out


def assign_split(df: DataFrame, key: Column, weights: Sequence[float] = (8, 1, 1),
                 names: Sequence[str] = SPLIT_NAMES, out: str = "split") -> DataFrame:
    """Add the split column."""
    return df.withColumn(out, split_column(key, weights, names))


def split_frames(df: DataFrame, key: Column, weights: Sequence[float] = (8, 1, 1),
                 names: Sequence[str] = SPLIT_NAMES) -> list[DataFrame]:
    """The splits as separate frames (filters over one projection)."""
    s = assign_split(df, key, weights, names, "__split")
    return [s.where(F.col("__split") == n).drop("__split") for n in names]


def sample_fraction(df: DataFrame, key: Column, fraction: float,
                    salt: str = "sample") -> DataFrame:
    """Repeatable sample of about ``fraction`` of the rows (R2)."""
    u = md5_unit(F.concat(key.cast("string"), F.lit("#" + salt)))
    return df.where(u < F.lit(float(fraction)))


def with_unit(df: DataFrame, key: Column, out: str = "u") -> DataFrame:
    """Per-row uniform in [0, 1) from the key; basis of mini-batch samples."""
    return df.withColumn(out, md5_unit(key))


def minibatch_flag(u: str | Column, step: int, fraction: float) -> Column:
    """Whether a row is in the mini-batch of SGD step ``step``."""
    if fraction >= 1.0:
        return F.lit(True)
    uc = F.col(u) if isinstance(u, str) else u
    return step_unit(uc, step) < F.lit(float(fraction))


def union_all(*dfs: DataFrame) -> DataFrame:
    """Concatenate frames by column name, duplicates kept."""
    return reduce(lambda a, b: a.unionByName(b), dfs)


def split_counts(df: DataFrame, split_col: str = "split") -> DataFrame:
    """Row count per split in one aggregate (A3)."""
    return df.groupBy(split_col).agg(F.count(F.lit(1)).alias("n"))
