"""Joins whose hot keys are known: no key's rows land in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orchard.llm.common import BROADCAST_IDS

# A key is hot when it holds more than 1 / SHARE of the matching rows, so fewer than SHARE are.
SHARE = 4_096


def lookup(big: DataFrame, small: DataFrame, on: Sequence[str], weight: str, how: str = "inner",
           bound: int = BROADCAST_IDS) -> DataFrame:
    """``big`` joined with ``small`` (cut; one row per key ``on``; ``weight`` = rows of ``big``
    that have the key), inner or left.

    Up to ``bound`` rows ``small`` is broadcast.  Beyond that only the hot keys are, fewer than
    ``SHARE`` by construction, and the other rows of ``big`` meet the other keys by a shuffle
    that no single key dominates.  The rows are the same either way; ``weight`` is dropped.
    """
    on = list(on)
    if small.count() <= bound:
        return big.join(F.broadcast(small.drop(weight)), on, how)
    total = small.agg(F.sum(weight)).first()[0] or 0
    is_hot = F.col(weight) * SHARE > total
    hot, cold = small.where(is_hot).drop(weight), small.where(~is_hot).drop(weight)
    here = big.join(F.broadcast(hot), on)
    rest = big.join(F.broadcast(hot.select(*on)), on, "left_anti").join(cold, on, how)
    return here.unionByName(rest)
