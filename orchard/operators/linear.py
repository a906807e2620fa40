"""Linear models trained by gradient descent on DataFrames.

Each step is ONE distributed aggregate: rows compute their gradient terms with the
current weights, partial sums are combined per partition and d+1 numbers per
configuration reach the driver.  Several configurations (a grid) advance together
in the same scan, never by a join of configs to rows.  The plan of a step does not
hold the weights: they travel as an array with the task, and every block of rows is one
matrix product over all configurations, so nothing is compiled anew from step to step.
Rows are packed into blocks once, before the first step.

Update rule (no intercept, start at 0), for step t = 1..T:
    eta = step / sqrt(t);  g = (1/n) * sum_batch m * x
    w <- (1 - eta * reg) * w - eta * g
    stop once t > 1 and |w_t - w_{t-1}| < tol * max(|w_t|, 1)
logistic: m = sigmoid(w.x) - y;   hinge: m = -(2y-1) if (2y-1) w.x < 1 else 0.
"""

from __future__ import annotations

import math
import time
from dataclasses import dataclass, field
from typing import Sequence

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orchard.operators import common
from orchard.operators.common import dot
from orchard.functions.hashing import STEP_PRIME, step_factors, step_unit

CONVERGENCE_TOL = 0.001
# Runs longer than this many steps first write their input to the checkpoint
# folder, so an executor lost mid-run costs a re-read, not a recomputation.
LONG_RUN_STEPS = 20


@dataclass
class LinearModel:
    kind: str                       # "logistic" | "hinge"
    weights: list[float]
    intercept: float = 0.0

    @property
    def threshold(self) -> float:
        return 0.5 if self.kind == "logistic" else 0.0

    def margin(self, features: str | Column = "features") -> Column:
        return dot(features, self.weights) + F.lit(self.intercept)

    def _margin_sql(self, features: str) -> str:
        """Unrolled products, for vectors narrow enough for one generated method."""
        m = _dot_sql(f"`{features}`", self.weights)
        return m if self.intercept == 0.0 else f"({m}) + {_num(self.intercept)}"

    def score_col(self, features: str | Column = "features") -> Column:
        m = self.margin(features)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-m)) if self.kind == "logistic" else m

    def predict_col(self, features: str | Column = "features") -> Column:
        """1.0 when the score is above the threshold, else 0.0.

        Built as one SQL expression (a single JVM call) when ``features`` is a
        column name, so scoring dozens of grid models stays cheap to plan.
        """
        if isinstance(features, str) and len(self.weights) <= common.WIDE_DIM:
            m = self._margin_sql(features)
            score = f"1.0D / (1.0D + exp(-({m})))" if self.kind == "logistic" else f"({m})"
            return F.expr(f"CASE WHEN {score} > {_num(self.threshold)} THEN 1.0D ELSE 0.0D END")
        return F.when(self.score_col(features) > F.lit(self.threshold), F.lit(1.0)) \
            .otherwise(F.lit(0.0))

    def transform(self, df: DataFrame, features: str = "features",
                  out: str = "prediction") -> DataFrame:
        return df.withColumn(out, self.predict_col(features))


@dataclass(frozen=True)
class SgdConfig:
    kind: str
    step_size: float
    reg_param: float = 0.0
    mini_batch_fraction: float = 1.0


@dataclass
class _Trajectory:
    cfg: SgdConfig
    w: list[float]
    prev: list[float] | None = None
    updates: int = 0
    converged: bool = False
    snapshots: dict[int, list[float]] = field(default_factory=dict)


def _num(v: float) -> str:
    """A double literal in Spark SQL text (shortest round-trip form)."""
    if math.isfinite(v):
        return f"{float(v)!r}D"
    return f"CAST('{'NaN' if math.isnan(v) else ('Infinity' if v > 0 else '-Infinity')}' AS DOUBLE)"


def _dot_sql(x: str, weights: Sequence[float]) -> str:
    """Same terms and association as ``common.dot`` (zero weights skipped)."""
    terms = [f"{x}[{j}] * {_num(w)}" for j, w in enumerate(weights) if w != 0.0]
    return " + ".join(terms) if terms else "0.0D"


def step_flag(unit: str, step: int, fraction: float) -> Column:
    """Whether a row with uniform ``unit`` is in the mini-batch of a step."""
    return F.lit(True) if fraction >= 1.0 else step_unit(F.col(unit), step) < F.lit(float(fraction))


def _norm(v: Sequence[float]) -> float:
    return math.sqrt(sum(a * a for a in v))


def fit_sgd_many(df: DataFrame, configs: Sequence[SgdConfig], dim: int,
                 iterations: Sequence[int], features: str = "features",
                 label: str = "label", unit: str = "u",
                 tol: float = CONVERGENCE_TOL,
                 checkpoint: bool | None = None) -> tuple[dict, dict[int, float]]:
    """Advance every config together; snapshot weights at each count in ``iterations``.

    ``df`` is scanned once per step through a cached copy in blocks made here (``_packed``).
    ``unit`` is a per-row uniform (``split.with_unit``) used for mini-batches.
    Returns ({(config, T): LinearModel}, {T: milliseconds until step T was done}).
    """
    t0 = time.perf_counter()
    marks = sorted(set(int(i) for i in iterations))
    t_max = marks[-1] if marks else 0
    trajs = [_Trajectory(c, [0.0] * dim) for c in configs]
    took: dict[int, float] = {}
    sampled = any(c.mini_batch_fraction < 1.0 for c in configs)
    # The loop owns a cached copy of (features, label, unit) in blocks; long
    # runs first write it to the checkpoint folder.
    # rows without a full feature vector or a label cannot contribute to a gradient
    owned = _packed(df.where((F.size(features) == dim) & F.col(label).isNotNull()
                             & F.forall(features, lambda v: v.isNotNull())), dim, features, label, unit if sampled else None)
    if checkpoint or (checkpoint is None and t_max > LONG_RUN_STEPS):
        owned = common.reliable(owned)
    owned = owned.persist(StorageLevel.MEMORY_AND_DISK)
    for t in range(1, t_max + 1):
        active = [tr for tr in trajs if not tr.converged]
        if active:
            counts, sums = _gradients(owned, active, t, dim)
            for i, tr in enumerate(active):
                n = counts.get(tr.cfg.mini_batch_fraction, 0)
                if not n:
                    continue
                eta = tr.cfg.step_size / math.sqrt(t)
                shrink = 1.0 - eta * tr.cfg.reg_param
                new = [shrink * w - eta * (g / n) for w, g in zip(tr.w, sums[i])]
                tr.prev, tr.w = tr.w, new
                tr.updates += 1
                if tr.updates > 1:
                    diff = _norm([a - b for a, b in zip(tr.w, tr.prev)])
                    tr.converged = diff < tol * max(_norm(tr.w), 1.0)
        if t in marks:
            took[t] = (time.perf_counter() - t0) * 1000.0
            for tr in trajs:
                tr.snapshots[t] = list(tr.w)
    owned.unpersist()
    out = {(tr.cfg, t): LinearModel(tr.cfg.kind, tr.snapshots[t]) for tr in trajs for t in marks}
    return out, took


def _packed(df: DataFrame, dim: int, features: str, label: str, unit: str | None) -> DataFrame:
    """The rows in blocks, one row per Arrow batch: ``n, x, codes, y, u``.

    A column of a block with at most 256 values is one byte a row and a list of its values, any
    other its doubles (and no codes); no value is rounded.  A step then reads a few large
    byte strings instead of an array per row.
    """
    schema = pa.schema([("n", pa.int32()), ("x", pa.list_(pa.binary())), ("codes", pa.list_(pa.binary())),
                        ("y", pa.binary()), ("u", pa.binary())])

    def run(it):
        for b in it:
            if not b.num_rows:
                continue
            x = b.column(0).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
            held, codes = [], []
            for j in range(dim):
                bits = np.ascontiguousarray(x[:, j]).view(np.int64)
                short = pa.array(bits).dictionary_encode()
                few = len(short.dictionary) <= 256
                held.append((short.dictionary.to_numpy() if few else bits).tobytes())
                codes.append(short.indices.to_numpy().astype(np.uint8).tobytes() if few else b"")
            y = b.column(1).to_numpy(zero_copy_only=False).astype(np.float64)
            u = b"" if unit is None else (
                b.column(2).to_numpy(zero_copy_only=False) * 4294967296.0).astype(np.int64).tobytes()
            yield pa.record_batch([pa.array([v], f.type) for v, f in zip((len(x), held, codes, y.tobytes(), u), schema)],
                                  schema=schema)

    cols = [F.col(features), F.col(label).cast("double")] + ([F.col(unit)] if unit else [])
    return df.select(*cols).mapInArrow(run, "n int, x array<binary>, codes array<binary>, y binary, u binary")


# Coordinates of one gradient that travel in one row.
GRADIENT_BLOCK = 4096


def _gradients(blocks_of: DataFrame, active: Sequence[_Trajectory], step: int,
               dim: int) -> tuple[dict[float, int], np.ndarray]:
    """Mini-batch sizes by fraction and gradient sums (configurations x dim) of one step.

    A block of rows (``_packed``) becomes one matrix product, whatever the number of
    features; a partition sends a row per configuration and block of
    coordinates, and a second stage adds these up block by block.
    """
    weights = np.array([tr.w for tr in active], np.float64)
    kinds = np.array([tr.cfg.kind == "logistic" for tr in active])
    fractions = sorted({tr.cfg.mini_batch_fraction for tr in active})
    of = np.array([fractions.index(tr.cfg.mini_batch_fraction) for tr in active])
    unknown = {tr.cfg.kind for tr in active} - {"logistic", "hinge"}
    if unknown:
        raise ValueError(f"unknown loss {unknown.pop()!r}")
    block, (a, b0) = GRADIENT_BLOCK, step_factors(step)
    sampled = any(f < 1.0 for f in fractions)
    schema = pa.schema([("i", pa.int32()), ("b", pa.int32()), ("n", pa.int64()), ("g", pa.list_(pa.float64()))])
    ddl = "i int, b int, n long, g array<double>"

    def rows(n: np.ndarray, g: np.ndarray):
        """Batch sizes are the rows i < 0, gradients the others."""
        out = [(-1 - k, 0, int(v), [0.0]) for k, v in enumerate(n)]
        out += [(i, j // block, 0, g[i, j:j + block]) for i in range(len(g)) for j in range(0, dim, block)]
        return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    def unpacked(b: pa.RecordBatch):
        for r in b.to_pylist():
            x = np.empty((r["n"], dim))
            for j, (held, codes) in enumerate(zip(r["x"], r["codes"])):
                values = np.frombuffer(held)
                x[:, j] = values[np.frombuffer(codes, np.uint8)] if codes else values
            yield x, np.frombuffer(r["y"]), np.frombuffer(r["u"], np.int64)

    def partial(it):
        n, g = np.zeros(len(fractions), np.int64), np.zeros((len(weights), dim))
        for x, y, x32 in (rows_of for b in it for rows_of in unpacked(b)):
            with np.errstate(over="ignore"):
                margin = x @ weights.T
                sign = (2.0 * y - 1.0)[:, None]
                m = np.where(kinds, 1.0 / (1.0 + np.exp(-margin)) - y[:, None],
                             np.where(sign * margin < 1.0, -sign, 0.0))
            if sampled:
                u = ((x32 * a + b0) % STEP_PRIME).astype(np.float64) / STEP_PRIME
                inside = u[:, None] < np.array([f if f < 1.0 else 2.0 for f in fractions])
                m = m * inside[:, of]
                n += inside.sum(axis=0)
            else:
                n += len(x)
            g += m.T @ x
        yield rows(n, g)

    def total(it):
        sums: dict[tuple[int, int], list] = {}
        for b in it:
            for i, k, n, g in zip(*(c.to_pylist() for c in b.columns[:3]), b.column(3)):
                at = sums.setdefault((i, k), [0, 0.0])
                at[0] += n
                at[1] = at[1] + g.values.to_numpy()
        if sums:
            out = [(i, k, n, g) for (i, k), (n, g) in sums.items()]
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    parts = blocks_of.mapInArrow(partial, ddl)
    blocks = len(fractions) + len(weights) * -(-dim // block)
    # a few rows per partition: enough reducers for the blocks, each adding in a stream
    parts = parts.repartition(min(blocks, 64), "i", "b").mapInArrow(total, ddl)
    counts, sums = dict.fromkeys(fractions, 0), np.zeros((len(weights), dim))
    for r in parts.collect():
        if r["i"] < 0:
            counts[fractions[-1 - r["i"]]] += r["n"]
        else:
            at = r["b"] * block
            sums[r["i"], at:at + len(r["g"])] += r["g"]
    return counts, sums


def fit_sgd(df: DataFrame, kind: str, dim: int, num_iterations: int, step_size: float,
            reg_param: float = 0.0, mini_batch_fraction: float = 1.0,
            features: str = "features", label: str = "label", unit: str = "u") -> LinearModel:
    """One model (M4 with ``kind='logistic'``, M5 with ``kind='hinge'``)."""
    cfg = SgdConfig(kind, float(step_size), float(reg_param), float(mini_batch_fraction))
    models, _ = fit_sgd_many(df, [cfg], dim, [num_iterations], features, label, unit)
    return models[(cfg, num_iterations)]


def fit_logistic_sgd(df, dim, num_iterations=5, step_size=50.0, mini_batch_fraction=0.5,
                     **kw) -> LinearModel:
    return fit_sgd(df, "logistic", dim, num_iterations, step_size, 0.0, mini_batch_fraction, **kw)


def fit_svm_sgd(df, dim, num_iterations=25, step_size=1.0, reg_param=0.01,
                mini_batch_fraction=1.0, **kw) -> LinearModel:
    """Hinge loss + L2.  The historical defaults (step 50, reg 1) diverge:
    each step multiplies the weights by (1 - 50/sqrt(t)); pass them explicitly
    to reproduce that."""
    return fit_sgd(df, "hinge", dim, num_iterations, step_size, reg_param,
                   mini_batch_fraction, **kw)
