"""Repeatable hash buckets and uniforms, identical in Spark SQL and DuckDB.

The bucket of a row is a pure function of its key, so splits and samples do
not move when the input is repartitioned (a seeded ``randomSplit`` does).
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

_TWO_POW_32 = 4294967296.0


def row_key(*cols: str | Column) -> Column:
    """Stable string key of one or more columns, ``'|'``-joined."""
    parts = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in cols]
    return parts[0] if len(parts) == 1 else F.concat_ws("|", *parts)


def _md5_head(key: Column) -> Column:
    # first 32 bits of md5(key) as a non-negative bigint
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint")


def md5_bucket(key: Column, n: int = 10) -> Column:
    """Integer bucket 0..n-1 of a key: ``int(md5(key)[:8], 16) % n``."""
    return (_md5_head(key) % F.lit(n)).cast("int")


def md5_unit(key: Column) -> Column:
    """Uniform in [0, 1) from the key: ``int(md5(key)[:8], 16) / 2**32``."""
    return _md5_head(key) / F.lit(_TWO_POW_32)


# Mini-batch membership: a row's 32-bit number x (its uniform, scaled up) is hashed anew in
# every step t as (a x + b) mod p, with a and b drawn from the step's number alone.  Two
# rows meet in a batch by chance in each step, however close their uniforms are.
STEP_PRIME = 2147483647         # 2^31 - 1, so that a x + b stays below 2^63


def step_factors(t: int) -> tuple[int, int]:
    """The factors a (never 0) and b of step ``t``."""
    h = hashlib.md5(f"step {int(t)}".encode()).digest()
    return (int.from_bytes(h[:8], "big") % (STEP_PRIME - 1) + 1, int.from_bytes(h[8:], "big") % STEP_PRIME)


def step_unit_sql(u: str, t: int) -> str:
    """``step_unit`` as SQL text that Spark and DuckDB read alike; ``u`` is SQL too."""
    a, b = step_factors(t)
    return f"CAST((CAST({u} * {int(_TWO_POW_32)} AS BIGINT) * {a} + {b}) % {STEP_PRIME} AS DOUBLE) / {STEP_PRIME}"


def step_unit(u: Column, t: int) -> Column:
    """Uniform of a row at step ``t`` given its base uniform ``u`` (``md5_unit``)."""
    a, b = step_factors(t)
    x = (u * F.lit(_TWO_POW_32)).cast("bigint")
    return ((x * F.lit(a) + F.lit(b)) % F.lit(STEP_PRIME)).cast("double") / F.lit(float(STEP_PRIME))
