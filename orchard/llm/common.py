"""Helpers shared by the operators of this package."""

from __future__ import annotations

import contextlib
import ctypes
import inspect
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orchard.session import ensure_checkpoint_dir

# An id list is broadcast while it has at most this many rows (16 bytes each,
# 8 MB); a longer one is joined with a shuffle.
BROADCAST_IDS = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Rows in an Arrow batch, unless the session sets its own number: rows hold whole texts, and
# Spark's default of 10,000 fills tens of megabytes beside the heap for every running task.
BATCH_ROWS = 1_000
_ROWS_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *keep: str) -> DataFrame:
    """``doc_id, text`` and ``keep`` alone (other columns cannot clash); a null text is empty."""
    spark = docs.sparkSession
    if spark.conf.get(_ROWS_KEY) == "10000":
        spark.conf.set(_ROWS_KEY, str(BATCH_ROWS))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), *keep)


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir`` (a scratch folder on a local master only)."""
    folder = ensure_checkpoint_dir(spark)
    if not folder:
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    return folder


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` into the shared checkpoint folder, so that a lost executor
    costs a re-read; Spark removes the files when nothing refers to them."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


@contextlib.contextmanager
def written(df: DataFrame) -> Iterator[DataFrame]:
    """``df`` as a Parquet table in the shared checkpoint folder for the length of a block:
    for intermediate rows that are too many for an uncompressed checkpoint."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
        jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)


def restrict(df: DataFrame, ids: DataFrame, on: str, how: str = "left_semi") -> DataFrame:
    """Semi or anti join of ``df`` with distinct ``ids`` (one column, already cut).

    The id list is counted first: up to ``BROADCAST_IDS`` rows it is broadcast
    and ``df`` stays where it is, beyond that both sides are shuffled.
    """
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    return df.join(ids, on, how)


def flagged(df: DataFrame, ids: DataFrame, on: str, name: str) -> DataFrame:
    """``df`` with a boolean column: is its ``on`` among the distinct ``ids`` (already cut)?
    Broadcast or shuffled like ``restrict``."""
    ids = ids.select(on, F.lit(True).alias(name))
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    return df.join(ids, on, "left").withColumn(name, F.coalesce(name, F.lit(False)))


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``id, component_id`` of every vertex of ``edges(a, b)``: the smallest id that
    links reach.  Alternating large-star and small-star steps; each vertex keeps
    one row per neighbour, minima are combined before the shuffle, and every
    round is cut.  Edges with a null end and loops are ignored; no edges give
    no rows.
    """
    e = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("u"),
                                         F.least("a", "b").alias("v")).distinct())
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        m = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (both.join(m, "u").where("v > u")
                 .select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
                 .distinct())
        m2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(m2, "u").where("v <> m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(m2.select("u", F.col("m").alias("v"))).distinct())
        e = cut(small)
        # done when every vertex has one parent and no parent has one itself
        ends = (e.select(F.col("u").alias("id"), F.lit(1).alias("child"), F.lit(0).alias("parent"))
                .unionByName(e.select(F.col("v"), F.lit(0), F.lit(1)).toDF("id", "child", "parent"))
                .groupBy("id").agg(F.sum("child").alias("c"), F.max("parent").alias("p")))
        if ends.where("c > 1 or (c > 0 and p > 0)").isEmpty():
            break
    else:
        raise RuntimeError("components did not settle")
    return (e.select(F.col("u").alias("id"), F.col("v").alias("component_id"))
            .unionByName(e.select(F.col("v").alias("id"),
                                  F.col("v").alias("component_id")).distinct()))


def mix64(a: np.ndarray) -> np.ndarray:
    """Finalising mixer on uint64 (spreads polynomial hashes over all bits)."""
    a = a ^ (a >> np.uint64(31))
    a = a * np.uint64(0x9E3779B97F4A7C15)
    a = a ^ (a >> np.uint64(29))
    a = a * np.uint64(0xBF58476D1CE4E5B9)
    return a ^ (a >> np.uint64(32))


def release() -> None:
    """Give memory that this Python process has freed back to the system."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):      # glibc only
        ctypes.CDLL(None).malloc_trim(0)


def tidy(task):
    """Wrap a function for Python workers so that freed memory goes back to the system when a
    task ends: workers are reused, and what one operator freed would stay with the next."""
    def batches(it):
        yield from task(it)
        release()

    def group(rows):
        out = task(rows)
        release()
        return out

    return batches if inspect.isgeneratorfunction(task) else group


def byte_runs(it, max_bytes: int = 1_000_000) -> Iterator[tuple]:
    """(rows, bytes, offsets) of Arrow batches whose second column is a text, in runs of
    about ``max_bytes``: the text of row k of a run is ``bytes[offsets[k]:offsets[k + 1]]``.
    A longer text comes alone, whole."""
    for b in it:
        n, txt = b.num_rows, b.column(1)
        if not n:
            continue
        _, off, data = txt.buffers()
        off = np.frombuffer(off, np.int32, n + 1 + txt.offset)[txt.offset:].astype(np.int64)
        data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
        lo = 0
        while lo < n:
            hi = max(lo + 1, int(np.searchsorted(off, off[lo] + max_bytes, "right")) - 1)
            yield b.slice(lo, hi - lo), data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
            lo = hi


def byte_batches(it, max_bytes: int = 1_000_000) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """``byte_runs`` of (id, text) batches with the ids as a list."""
    for rows, data, off in byte_runs(it, max_bytes):
        yield rows.column(0).to_pylist(), data, off


_STEP = 0x5851F42D4C957F2D                      # odd, so it has an inverse modulo 2^64
_BYTE_CODE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


class Powers:
    """Powers of ``_STEP`` and of its inverse, grown as needed."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def take(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            for name, base in (("up", _STEP), ("down", pow(_STEP, -1, 1 << 64))):
                p = np.full(n, base, np.uint64)
                p[0] = 1
                setattr(self, name, np.cumprod(p, dtype=np.uint64))
        return self.up[:n], self.down[:n]


def prefix_sums(data: np.ndarray, powers: Powers) -> np.ndarray:
    """S with S[e] - S[s] = (hash of data[s:e]) * _STEP**s."""
    up, _ = powers.take(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_CODE[data] * up[:-1], out=out[1:])
    return out


def span_hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray, powers: Powers) -> np.ndarray:
    """64-bit hash of data[start:end], the same wherever the bytes stand."""
    _, down = powers.take(len(sums))
    return mix64((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def word_spans(is_word: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and document of each run of word bytes; runs end at document ends."""
    n = len(is_word)
    before = np.zeros(n + 1, bool)
    before[1:] = is_word
    before[offsets] = False                     # nothing continues over a document's start
    after = np.zeros(n + 1, bool)
    after[:n] = is_word
    after[offsets] = False
    start = np.flatnonzero(is_word & ~before[:n])
    end = np.flatnonzero(is_word & ~after[1:]) + 1
    doc = np.searchsorted(offsets, start, "right") - 1
    return start, end, doc
