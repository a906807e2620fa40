"""Matrix factorisation of very many ratings in bounded memory (M7).

The method is that of Spark ML's ALS for given ratings: one side's factors are solved by regularised least
squares while the other's stand still, in turn, the penalty weighted by each row's number of ratings.
Spark's learner holds a block's ratings on the heap while it builds them and all factors that a block
needs as objects; here a block's ratings stay in the checkpoint folder, in the order in which a task
meets them, and flow through it:

* a side's ids are dealt over ``blocks``, each one task of a step.  The ratings are written once for
  each side, hash-partitioned by its block and sorted by group of the other side (``GROUP`` factor
  vectors) and range of the block (``RANGE`` ids); a row holds some of the ratings of such a cell;
* a step sends each group of the other side's factors to every block and merges the two
  sorted streams.  The ratings do not move.  A task holds one group of factors, one batch of ratings
  and the normal equations of its own block, ``rank * (rank + 3) / 2 + 1`` numbers an id.

Ids in use must be dense (their largest below ``DENSE`` times their number); others are numbered first.
The starting vectors depend on seed and id alone.
"""

from __future__ import annotations

import contextlib
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orchard.operators.common import dense_numbers, reliable, static_plans, stored

BLOCKS = 5                  # at least; each factor vector is sent to every block in every step
BLOCK_NUMBERS = 63_000_000  # of a block's normal equations: 500 MB, 3 million ids at rank 5
GROUP = 1 << 18             # factor vectors that travel together
RANGE = 1 << 16             # ids of a block that ratings are sorted by
PACK = 2_000_000            # ratings dealt at a time in a task
DENSE = 2
BATCH_BYTES = 16 << 20

# the tasks' functions travel with the job: executors need not have this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@contextlib.contextmanager
def _merging(spark):
    """Joins that keep what is partitioned by the first of their keys; Arrow batches of bounded size."""
    own = {"spark.sql.requireAllClusterKeysForCoPartition": "false",
           "spark.sql.execution.arrow.maxBytesPerBatch": str(BATCH_BYTES)}
    before = {k: spark.conf.get(k) for k in own}
    try:
        for k, v in own.items():
            spark.conf.set(k, v)
        with static_plans(spark):
            yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def _block_keys(spark, blocks: int) -> list[int]:
    """A number for each block, all dealt to different ones of ``blocks`` hash partitions."""
    k = F.col("id").cast("int")
    rows = spark.range(64 * blocks + 64).groupBy(F.pmod(F.hash(k), F.lit(blocks)).alias("p")).agg(F.min(k).alias("k"))
    found = sorted((r["p"], r["k"]) for r in rows.collect())
    spare = iter(range(1 << 30, (1 << 30) + blocks))
    return [k for _, k in found] + [next(spare) for _ in range(blocks - len(found))]


class _Side:
    """How the ids 0 .. ``top`` of one side are dealt: id = place * blocks + block."""

    def __init__(self, top: int, blocks: int):
        self.blocks, self.ids = blocks, top // blocks + 1           # ids of a block
        self.groups = -(-self.ids // GROUP)                         # of a block


def _dealt(ratings: DataFrame, own: _Side, other: _Side, own_col: str, other_col: str, keys: list[int]) -> DataFrame:
    """``block, g, range, a, o, r``: ratings by block of the own side, group of the other, range of the own."""
    ranges = -(-own.ids // RANGE)
    schema = pa.schema([("block", pa.int32()), ("g", pa.int32()), ("range", pa.int32()),
                        ("a", pa.binary()), ("o", pa.binary()), ("r", pa.binary())])
    blocks, all_groups, per_block = own.blocks, other.blocks * other.groups, other.groups
    key_of = np.array(keys, np.int32)

    def packed(parts):
        a, o, r = (np.concatenate(x) for x in zip(*parts))
        place, at = a // blocks, o // blocks
        g = o % blocks * per_block + at // GROUP
        cell = (a % blocks * all_groups + g) * ranges + place // RANGE
        order = np.argsort(cell.astype(np.uint16) if blocks * all_groups * ranges < 1 << 16 else cell, kind="stable")
        cell = cell[order]
        first = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
        ends = np.append(first, len(cell))
        cells = cell[first]
        cols = ((place % RANGE).astype(np.uint16), (at % GROUP).astype(np.uint32), r.astype(np.float32))
        data = []
        for v in cols:
            offsets = pa.py_buffer((ends * v.itemsize).astype(np.int32))
            data.append(pa.Array.from_buffers(pa.binary(), len(cells), [None, offsets, pa.py_buffer(v[order])]))
        return pa.record_batch([pa.array(key_of[cells // ranges // all_groups]), pa.array((cells // ranges % all_groups).astype(np.int32)),
                                pa.array((cells % ranges).astype(np.int32)), *data], schema=schema)

    def run(it):
        parts, held = [], 0
        for b in it:
            parts.append((b.column(0).to_numpy().astype(np.int64), b.column(1).to_numpy().astype(np.int64),
                          b.column(2).to_numpy()))
            held += b.num_rows
            if held >= PACK:
                yield packed(parts)
                parts, held = [], 0
        if held:
            yield packed(parts)

    rows = ratings.select(own_col, other_col, "rating").mapInArrow(run, "block int, g int, range int, a binary, o binary, r binary")
    return reliable(rows.repartition(blocks, "block").sortWithinPartitions("block", "g", "range"))


# ``range`` is -1: it puts the factors before the ratings that they meet, and the planner must not know it
_FACTORS = "g int, range int, vec binary, seen binary"
_FACTORS_SCHEMA = pa.schema([("g", pa.int32()), ("range", pa.int32()), ("vec", pa.binary()), ("seen", pa.binary())])


def _factors(g: int, vec: np.ndarray, seen: np.ndarray) -> pa.RecordBatch:
    cells = (g, -1, vec.tobytes(), seen.tobytes())
    return pa.record_batch([pa.array([c], f.type) for c, f in zip(cells, _FACTORS_SCHEMA)], schema=_FACTORS_SCHEMA)


def _start(spark, side: _Side, rank: int, seed: int) -> DataFrame:
    """``g, range, vec, seen`` of one side: a random direction for each id."""
    blocks, per_block, ids = side.blocks, side.groups, side.ids

    def run(it):
        for b in it:
            for g in b.column(0).to_pylist():
                at = np.arange(g % per_block * GROUP, min((g % per_block + 1) * GROUP, ids), dtype=np.uint64)
                x = (at * np.uint64(blocks) + np.uint64(g // per_block))[:, None] * np.uint64(2 * rank) + np.arange(2 * rank, dtype=np.uint64)
                x = x + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % (1 << 64))
                for shift, times in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):       # splitmix64
                    x = (x ^ (x >> np.uint64(shift))) * np.uint64(times)
                u = ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) + 0.5
                u /= 1 << 53
                v = np.sqrt(-2 * np.log(u[:, :rank])) * np.cos(2 * np.pi * u[:, rank:])
                v /= np.maximum(np.sqrt((v * v).sum(1)), 1e-300)[:, None]
                yield _factors(g, v.astype(np.float32), np.zeros(0, bool))

    groups = blocks * per_block
    return reliable(spark.range(0, groups, 1, min(groups, 64)).select(F.col("id").cast("int")).mapInArrow(run, _FACTORS))


def _solved(acc: np.ndarray, rank: int, reg: float) -> np.ndarray:
    """Factors from summed products, summed ratings times factors and counts (columns of ``acc``)."""
    pairs = [(k, m) for k in range(rank) for m in range(k + 1)]
    count = acc[-1]
    left = np.empty((acc.shape[1], rank, rank))
    for j, (k, m) in enumerate(pairs):
        left[:, k, m] = left[:, m, k] = acc[j]
    left[:, range(rank), range(rank)] += np.where(count > 0, reg * count, 1.0)[:, None]
    right = acc[len(pairs):-1].T[:, :, None]
    try:
        return np.linalg.solve(left, right)[:, :, 0].astype(np.float32)
    except np.linalg.LinAlgError:                           # no penalty and too few ratings
        return (np.linalg.pinv(left, hermitian=True) @ right)[:, :, 0].astype(np.float32)


def _step(dealt: DataFrame, factors: DataFrame, own: _Side, keys: list[int], rank: int, reg: float) -> DataFrame:
    """``g, range, vec, seen`` of the own side, solved from the other's ``factors``."""
    ids, per_block, block_of = own.ids, own.groups, {k: b for b, k in enumerate(keys)}
    few = max(1, 2_000_000 // rank ** 2)                    # systems solved at a time

    def added(acc, vec, a, o, r):
        a = a.astype(np.intp)
        top = acc.shape[1]
        cols, j = [c[o] for c in vec], 0
        for k in range(rank):
            for m in range(k + 1):
                acc[j] += np.bincount(a, cols[k] * cols[m], top)
                j += 1
        for c in cols:
            acc[j] += np.bincount(a, c * r, top)
            j += 1
        acc[j] += np.bincount(a, minlength=top)

    def finished(acc, block):
        for part in range(per_block):
            mine = acc[:, part * GROUP:(part + 1) * GROUP]
            vec = np.concatenate([_solved(mine[:, lo:lo + few], rank, reg) for lo in range(0, mine.shape[1], few)])
            yield _factors(block_of[block] * per_block + part, vec, mine[-1] > 0)

    def run(it):
        acc, vec, now = None, None, None
        for b in it:
            block, g, where = (b.column(c).to_numpy() for c in range(3))
            sent = b.column(6)
            flat = []
            for c, kind in ((3, np.uint16), (4, np.uint32), (5, np.float32)):
                _, off, data = b.column(c).buffers()
                off = np.frombuffer(off, np.int32, b.num_rows + 1 + b.column(c).offset)[b.column(c).offset:]
                size = np.dtype(kind).itemsize
                flat.append((off // size, np.frombuffer(data, kind, off[-1] // size) if off[-1] else np.zeros(0, kind)))
            same = (block[1:] == block[:-1]) & (g[1:] == g[:-1]) & (where[1:] == where[:-1])
            first = np.flatnonzero(np.append(True, ~same)[:b.num_rows])
            for lo, hi in zip(first.tolist(), np.append(first[1:], b.num_rows).tolist()):
                if block[lo] != now:
                    if acc is not None:
                        yield from finished(acc, now)
                    now, acc = int(block[lo]), np.zeros((rank * (rank + 3) // 2 + 1, ids))
                if where[lo] < 0:                           # the group's factors come before its ratings
                    vec = np.frombuffer(sent[lo].as_buffer(), np.float32).reshape(-1, rank).T.astype(np.float64)
                    continue
                a, o, r = (data[off[lo]:off[hi]] for off, data in flat)
                start = int(where[lo]) * RANGE
                added(acc[:, start:start + RANGE], vec, a, o, r)
        if acc is not None:
            yield from finished(acc, now)

    sent = factors.select(F.explode(F.array(*map(F.lit, keys))).alias("block"), "g", "range", "vec")
    both = dealt.join(sent.hint("merge"), ["block", "g", "range"], "full")     # no row matches: the two are merged by their keys
    return reliable(both.select("block", "g", "range", "a", "o", "r", "vec").mapInArrow(run, _FACTORS))


def _unpacked(factors: DataFrame, side: _Side, rank: int) -> DataFrame:
    """``id, features`` of the ids that have ratings."""
    blocks, per_block = side.blocks, side.groups
    schema = pa.schema([("id", pa.int32()), ("features", pa.list_(pa.float32()))])

    def run(it):
        for b in it:
            for i, g in enumerate(b.column(0).to_pylist()):
                seen = np.flatnonzero(np.frombuffer(b.column(3)[i].as_buffer(), bool))
                vec = np.frombuffer(b.column(2)[i].as_buffer(), np.float32).reshape(-1, rank)
                for lo in range(0, len(seen), 10_000):
                    at = seen[lo:lo + 10_000]
                    rows = pa.array(np.arange(0, len(at) * rank + 1, rank, dtype=np.int32))
                    yield pa.record_batch([pa.array(((at + g % per_block * GROUP) * blocks + g // per_block).astype(np.int32)),
                                           pa.ListArray.from_arrays(rows, pa.array(vec[at].ravel()))], schema=schema)

    return factors.mapInArrow(run, "id int, features array<float>")


def _numbered(ratings: DataFrame, col: str) -> tuple[DataFrame, DataFrame]:
    """Ratings with the ids of ``col`` replaced by numbers from 0 on, and the table of both."""
    table = reliable(dense_numbers(ratings.select(F.col(col).alias("id")).distinct(), "id", "at"))
    rows = ratings.join(table.withColumnRenamed("id", col), col)
    return stored(rows.drop(col).withColumnRenamed("at", col)), table


def factorise(ratings: DataFrame, rank: int, max_iter: int, reg: float, seed: int) -> tuple[DataFrame, DataFrame]:
    """``id, features`` of the users and of the items of ``user_id, item_id, rating`` (int ids)."""
    spark, names = ratings.sparkSession, ("user_id", "item_id")
    known = ratings.agg(F.count(F.lit(1)).alias("n"), *[f(c).alias(f"{f.__name__}_{c}") for c in (*names, "rating") for f in (F.count, F.min, F.max)],
                        F.count_if(F.isnan("rating")).alias("nan"),
                        *[F.approx_count_distinct(c, 0.02).alias(f"ids_{c}") for c in names]).first()
    if any(known[f"count_{c}"] < known["n"] for c in (*names, "rating")) or known["nan"]:
        raise ValueError("ratings must not hold null ids, null ratings or NaN")
    if any(not -1 << 31 <= known[f"{f}_{c}"] < 1 << 31 for c in names for f in ("min", "max")):
        raise ValueError("ids must be in the range of int")
    tables, tops = {}, {}
    for c in names:
        tops[c] = known[f"max_{c}"]
        if known[f"min_{c}"] < 0 or tops[c] >= DENSE * known[f"ids_{c}"] + RANGE:
            ratings, tables[c] = _numbered(ratings, c)
            tops[c] = tables[c].count() - 1
    blocks = max(BLOCKS, -(-(max(tops.values()) + 1) * (rank * (rank + 3) // 2 + 1) // BLOCK_NUMBERS))
    users, items = (_Side(tops[c], blocks) for c in names)
    keys = _block_keys(spark, blocks)
    with _merging(spark):
        by_user = _dealt(ratings, users, items, *names, keys)
        by_item = _dealt(ratings, items, users, *names[::-1], keys)
        user_factors = _start(spark, users, rank, seed)
        for _ in range(max_iter):
            item_factors = _step(by_item, user_factors, items, keys, rank, reg)
            user_factors = _step(by_user, item_factors, users, keys, rank, reg)
        found = []
        for c, side, factors in zip(names, (users, items), (user_factors, item_factors)):
            rows = _unpacked(factors, side, rank)
            if c in tables:
                rows = rows.withColumnRenamed("id", "at").join(tables[c], "at").select(F.col("id").cast("int").alias("id"), "features")
            found.append(stored(rows))
    return found[0], found[1]
