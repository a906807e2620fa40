"""Parsing and cleaning of positional text fields (operators P1-P11)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_fields(line: str | Column, sep: str) -> Column:
    """Split a line on a literal delimiter (P1).  Empty trailing fields kept."""
    return F.split(_c(line), re.escape(sep), -1)


def take_fields(arr: str | Column, n: int) -> Column:
    """First ``n`` fields of an array."""
    return F.slice(_c(arr), 1, n)


def strip_quotes(c: str | Column) -> Column:
    """Remove every double quote from a string."""
    return F.translate(_c(c), '"', "")


def strip_quotes_all(arr: str | Column) -> Column:
    """Remove every double quote from every field of an array."""
    return F.transform(_c(arr), lambda x: F.translate(x, '"', ""))


def to_double(c: Column, mode: str = "strict") -> Column:
    """Parse a double: ``strict`` fails the job on bad input (as the JVM
    ``toDouble`` does), ``permissive`` gives NULL instead."""
    return c.try_cast("double") if mode == "permissive" else c.cast("double")


def missing_to_zero(c: str | Column, marker: str = "?", mode: str = "strict") -> Column:
    """``'?'`` becomes 0.0, anything else is parsed as a double."""
    c = _c(c)
    return F.when(c == F.lit(marker), F.lit(0.0)).otherwise(to_double(c, mode))


def missing_to_zero_all(arr: str | Column, marker: str = "?", mode: str = "strict") -> Column:
    return F.transform(_c(arr), lambda x: F.when(x == F.lit(marker), F.lit(0.0))
                       .otherwise(to_double(x, mode)))


def clamp_nonneg(c: str | Column) -> Column:
    """Negative values become 0.0 (P4; naive Bayes needs counts >= 0)."""
    return F.greatest(_c(c).cast("double"), F.lit(0.0))


def clamp_nonneg_all(arr: str | Column) -> Column:
    return F.transform(_c(arr), lambda x: F.greatest(x, F.lit(0.0)))


def field_slice(arr: str | Column, start: int, until_from_end: int | None = None,
                until: int | None = None) -> Column:
    """Zero-based half-open slice ``[start, until)`` (P5).

    ``until`` counts from the left; ``until_from_end=k`` means ``size - k``.
    Like a JVM ``slice`` it clamps instead of failing on short rows.
    """
    a = _c(arr)
    if until is not None:
        end = F.least(F.lit(until), F.size(a))
    elif until_from_end is not None:
        end = F.size(a) - F.lit(until_from_end)
    else:
        end = F.size(a)
    length = F.greatest(end - F.lit(start), F.lit(0))
    return F.slice(a, F.lit(start + 1), length)


def label_last(arr: str | Column) -> Column:
    """Last field as an integer label."""
    return F.element_at(_c(arr), -1).cast("int")


def label_zero_based(arr: str | Column) -> Column:
    """Last field minus one, as a double class index."""
    return F.element_at(_c(arr), -1).cast("double") - F.lit(1.0)


def all_but_last(arr: str | Column) -> Column:
    a = _c(arr)
    return F.slice(a, F.lit(1), F.greatest(F.size(a) - F.lit(1), F.lit(0)))


def parse_all_double(arr: str | Column, mode: str = "strict") -> Column:
    """Every field parsed as a double."""
    return F.transform(_c(arr), lambda x: to_double(x, mode))


def concat_features(*arrays: str | Column) -> Column:
    """Category block ++ numeric block, as one ``array<double>`` (P10)."""
    return F.concat(*[_c(a).cast("array<double>") for a in arrays])
