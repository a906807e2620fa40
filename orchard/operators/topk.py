"""Exact top-k by inner product over blocks of neighbouring candidates.

Candidates are turned to their principal axes, numbered along a Z-order curve there and stand
in blocks of ``BLOCK``, one row each, with the box that holds the block.  No candidate of a
block scores more than the best corner of its box (nor more than |request| times its largest
norm).  A request meets the block of its best bound first, then the next seven, the next
fifty-six and so on, and each time only those blocks whose bound reaches its k-th score so
far; none that can hold anything better is left out.  Requests and candidates meet by
blocks, in one row and one matrix product; single pairs never become rows, and nothing is
crossed.  Only the boxes, one a block, pass through the driver.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orchard.operators.common import dense_numbers, reliable

BLOCK = 2048
FIRST = 8           # blocks met after two rounds; FIRST times as many after each further one
ROWS = 512          # requests scored or bounded at a time in a task
BITS = 8            # of a coordinate along the curve
SLACK = 1e-9        # relative; bounds and scores are rounded

# the tasks' functions travel with the job: executors need not have this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _matrix(column, rows: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(rows, -1)


def _axes(factors: DataFrame) -> tuple[np.ndarray, np.ndarray, float]:
    """Mean, principal axes (columns, widest first) and the widest deviation of the factors."""
    def run(it):
        for batch in it:
            if batch.num_rows:
                x = _matrix(batch.column(0), batch.num_rows)
                both = np.concatenate((x.sum(0), (x.T @ x).ravel()))
                yield pa.record_batch([pa.array([batch.num_rows]), pa.array([both.tolist()], pa.list_(pa.float64()))], names=["n", "v"])

    sums = factors.select("features").mapInArrow(run, "n long, v array<double>")
    rows = sums.select("n", F.posexplode("v").alias("j", "v")).groupBy("j").agg(F.sum("n").alias("n"), F.sum("v").alias("v"))
    each = np.array([r["v"] / r["n"] for r in rows.orderBy("j").collect()])
    rank = int(np.sqrt(len(each)))                          # rank sums and rank * rank products
    mean, products = each[:rank], each[rank:].reshape(rank, rank)
    if not rank or not np.isfinite(products).all():
        return mean, np.eye(rank), 1.0
    var, axes = np.linalg.eigh(products - np.outer(mean, mean))
    return mean, axes[:, ::-1], float(np.sqrt(max(var[-1], 0.0))) or 1.0


def _candidate_blocks(factors: DataFrame, block: int, mean: np.ndarray, axes: np.ndarray, width: float) -> DataFrame:
    """``b, lo, hi, top, ids, flat``: number, box on the axes, largest norm, ids and factors of each block."""
    def keyed(it):
        for batch in it:
            if batch.num_rows:
                at = (_matrix(batch.column(1), batch.num_rows) - mean) @ axes
                cell = np.clip(np.nan_to_num(at * (2 ** BITS / 8 / width)) + 2 ** (BITS - 1), 0, 2 ** BITS - 1).astype(np.uint8)
                bits = np.unpackbits(cell[:, :, None], axis=2).transpose(0, 2, 1)       # highest bits of all axes first
                key = np.packbits(bits.reshape(len(cell), -1), axis=1)
                yield pa.record_batch([batch.column(0), batch.column(1), pa.array([k.tobytes() for k in key], pa.binary())],
                                      names=["id", "features", "z"])

    def boxed(it):
        for batch in it:
            for r in range(batch.num_rows):
                ids, flat = (batch.column(c)[r].values for c in (1, 2))
                x = flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(ids), -1)
                at = x @ axes
                box = [pa.array([v.tolist()], pa.list_(pa.float64())) for v in (at.min(0), at.max(0))]
                top = pa.array([float(np.sqrt((x * x).sum(1)).max())])
                yield pa.record_batch([batch.column(0).slice(r, 1), *box, top, *(batch.column(c).slice(r, 1) for c in (1, 2))],
                                      names=["b", "lo", "hi", "top", "ids", "flat"])

    rows = factors.select("id", "features").mapInArrow(keyed, "id int, features array<float>, z binary")
    rows = dense_numbers(rows.withColumn("o", F.struct("z", "id")), "o", "at").withColumn("b", F.floor(F.col("at") / block).cast("int"))
    held = F.sort_array(F.collect_list(F.struct("at", "id", "features")))
    rows = rows.groupBy("b").agg(held.alias("h")).select("b", F.col("h.id").alias("ids"), F.flatten("h.features").alias("flat"))
    return rows.mapInArrow(boxed, "b int, lo array<double>, hi array<double>, top double, ids array<int>, flat array<float>")


def _sent(asked: DataFrame, boxes: list, axes: np.ndarray, start: int, until: int) -> DataFrame:
    """``b, rids, x, last, kth``: the requests ``(rid, features, kth)`` that meet block ``b`` as one of their
    ``start``-th to ``until``-th best bounds, where that bound reaches the k-th score (``last`` is ``b + 1``)."""
    lo, hi = (np.array([r[c] for r in boxes]).T for c in ("lo", "hi"))
    top = np.array([r["top"] for r in boxes])
    schema = pa.schema([("b", pa.int32()), ("rids", pa.list_(pa.int32())), ("x", pa.list_(pa.float32())),
                        ("last", pa.list_(pa.int32())), ("kth", pa.list_(pa.float64()))])

    def run(it):
        for batch in it:
            if not batch.num_rows:
                continue
            rid = batch.column(0).to_numpy(zero_copy_only=False)
            x = _matrix(batch.column(1), batch.num_rows)
            kth = batch.column(2).to_numpy(zero_copy_only=False).astype(np.float64)
            least = np.where(np.isnan(kth), -np.inf, kth - np.abs(kth) * SLACK)
            who, what = [], []
            for a in range(0, len(rid), ROWS):
                u = x[a:a + ROWS] @ axes
                size = np.sqrt((u * u).sum(1))[:, None] * top
                bound = np.minimum(np.maximum(u, 0) @ hi + np.minimum(u, 0) @ lo, size) + SLACK * size
                if until == 1:
                    best = bound.argmax(1)[:, None]
                else:
                    best = np.argsort(-bound, axis=1, kind="stable")[:, start:until]
                i, j = np.nonzero(np.take_along_axis(bound, best, 1) >= least[a:a + ROWS, None])
                who.append(i + a)
                what.append(best[i, j])
            who, what = np.concatenate(who), np.concatenate(what)
            order = np.argsort(what, kind="stable")
            who, what = who[order], what[order]
            for mine in np.split(np.arange(len(what)), np.flatnonzero(np.diff(what)) + 1):
                for g in range(0, len(mine), 4096):
                    w, b = who[mine[g:g + 4096]], int(what[mine[g]])
                    cells = (b, rid[w], x[w].astype(np.float32).ravel(), np.full(len(w), b + 1, np.int32), kth[w])
                    yield pa.record_batch([pa.array([c], f.type) for c, f in zip(cells, schema)], schema=schema)

    return asked.select("rid", "features", "kth").mapInArrow(
        run, "b int, rids array<int>, x array<float>, last array<int>, kth array<double>")


def _scored(groups: DataFrame, blocks: DataFrame, n: int) -> DataFrame:
    """``rid, id, score``: of every group of requests joined with a block, each request's best n
    that reach its k-th score so far."""
    schema = pa.schema([("rid", pa.int32()), ("id", pa.int32()), ("score", pa.float64())])

    def run(it):
        for batch in it:
            for r in range(batch.num_rows):
                rid, x, last, kth, ids, y = (batch.column(c)[r].values.to_numpy(zero_copy_only=False) for c in (1, 2, 3, 4, 5, 6))
                b = batch.column(0)[r].as_py()
                rank = len(x) // len(rid)
                x, y = x.reshape(-1, rank).astype(np.float64), y.reshape(-1, rank).astype(np.float64).T
                asked = np.flatnonzero(last > b)
                k = min(n, len(ids))
                for a in range(0, len(asked), ROWS):
                    mine = asked[a:a + ROWS]
                    score = x[mine] @ y
                    # all that reach the k-th score, so that ties go by id
                    seen = np.where(np.isnan(kth[mine]), -np.inf, kth[mine] - np.abs(kth[mine]) * SLACK)
                    reach = np.flatnonzero(score.max(axis=1) >= seen)
                    mine, score, seen = mine[reach], score[reach], seen[reach]
                    least = np.maximum(np.partition(score, len(ids) - k, axis=1)[:, len(ids) - k], seen)
                    i, j = np.nonzero(score >= least[:, None])
                    yield pa.record_batch([pa.array(rid[mine[i]]), pa.array(ids[j]), pa.array(score[i, j])], schema=schema)

    rows = groups.join(blocks.select("b", "ids", "flat"), "b").select("b", "rids", "x", "last", "kth", "ids", "flat")
    return rows.mapInArrow(run, "rid int, id int, score double")


def top_products(requests: DataFrame, candidates: DataFrame, n: int, block: int = BLOCK) -> DataFrame:
    """``rid, rank, id, score``: for each request ``(id, features)`` the n candidates ``(id, features)``
    with the largest inner products, equal ones by id.  Both have int ids and float factors."""
    mean, axes, width = _axes(candidates)
    blocks = reliable(_candidate_blocks(candidates, block, mean, axes, width))
    boxes = blocks.select("b", "lo", "hi", "top").orderBy("b").collect()            # one box a block
    asked = reliable(requests.select(F.col("id").alias("rid"), "features").where(F.lit(bool(boxes))))
    w = Window.partitionBy("rid").orderBy(F.desc("score"), F.asc("id"))
    found, start, until = None, 0, 1
    while found is None or start < len(boxes):
        if found is None:
            kth = asked.withColumn("kth", F.lit(None).cast("double"))
        else:
            kth = asked.join(found.where(F.col("rank") == n).select("rid", F.col("score").alias("kth")), "rid", "left")
        groups = reliable(_sent(kth, boxes, axes, start, until))
        if found is not None and groups.isEmpty():
            break
        rows = _scored(groups, blocks, n)
        if found is not None:
            rows = found.drop("rank").unionByName(rows)
        found = reliable(rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n))
        start, until = until, min(until * FIRST, len(boxes))
    return found.select("rid", "rank", "id", F.col("score").cast("float").alias("score"))
