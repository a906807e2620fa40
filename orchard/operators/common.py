"""Small shared helpers: bounded broadcast, persistence scope, vector columns."""

from __future__ import annotations

import contextlib
import uuid
from typing import Iterator, Sequence

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Above this many features one expression per feature would make a single huge
# generated method.  Wide vectors take array expressions or the long form
# (``posexplode`` + ``groupBy(j)``, partial-aggregated); results are the same.
WIDE_DIM = 256

# Upper bound on rows of a side we broadcast on our own say-so.  Anything
# larger is joined with a shuffle and left to AQE.
BROADCAST_MAX_ROWS = 1_000_000


def join_small(big: DataFrame, small: DataFrame, on, how: str = "left",
               small_rows: int | None = None) -> DataFrame:
    """Join with ``small`` broadcast only when its row count is known and bounded.

    ``small_rows`` must come from a count or from a construction bound; when
    it is missing or above ``BROADCAST_MAX_ROWS`` the join is planned normally
    (sort-merge, or broadcast chosen by AQE from runtime sizes).
    """
    if small_rows is not None and small_rows <= BROADCAST_MAX_ROWS:
        small = F.broadcast(small)
    return big.join(small, on, how)


@contextlib.contextmanager
def persisted(*dfs: DataFrame,
              level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[None]:
    """Keep frames cached (spilling to disk) for a block of repeated scans."""
    for df in dfs:
        df.persist(level)
    try:
        yield
    finally:
        for df in dfs:
            df.unpersist()


def dot(features: str | Column, weights: Sequence[float]) -> Column:
    """``sum_j w_j * x[j]`` as one JVM expression (weights become literals)."""
    x = F.col(features) if isinstance(features, str) else features
    if len(weights) > WIDE_DIM:
        return F.aggregate(F.zip_with(x, lit_array(weights), lambda a, b: a * b),
                           F.lit(0.0), lambda acc, v: acc + v)
    terms = [x.getItem(j) * F.lit(float(w)) for j, w in enumerate(weights) if w != 0.0]
    if not terms:
        return F.lit(0.0)
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out


def lit_array(values: Sequence[float]) -> Column:
    """One array literal, however long."""
    return F.lit(np.asarray(values, np.float64))


def feature_dim(df: DataFrame, features: str = "features") -> int:
    """Length of the feature arrays (read from one row; all rows agree)."""
    row = df.select(F.size(features).alias("d")).head(1)
    if not row:
        raise ValueError("cannot fit on an empty frame")
    return int(row[0]["d"])


def reliable(df: DataFrame) -> DataFrame:
    """Write ``df`` to the cluster's shared checkpoint folder and cut its lineage.

    A lost executor then re-reads the written rows instead of recomputing
    upstream joins.  Without a configured folder the rows are kept on the executors
    (memory, then disk), so that a loop does not run its whole past again.
    """
    from orchard.session import ensure_checkpoint_dir
    if not ensure_checkpoint_dir(df.sparkSession):
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    return df.checkpoint(eager=True)


@contextlib.contextmanager
def written(df: DataFrame) -> Iterator[DataFrame]:
    """``df`` as a Parquet table in the shared checkpoint folder for the length of a block (kept on
    the executors where no folder is set).  Unlike a checkpoint it starts with sizes of its own:
    the planner's size of a checkpoint is that of all it came from, multiplied at every join."""
    from orchard.session import ensure_checkpoint_dir
    spark = df.sparkSession
    folder = ensure_checkpoint_dir(spark)
    if not folder:
        with persisted(df):
            yield df
        return
    path = f"{folder}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def stored(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the shared checkpoint folder, where it stays as a checkpoint does:
    for rows that lazy results read several times and that are too many for an uncompressed
    checkpoint.  Without a folder the rows are kept on the executors."""
    from orchard.session import ensure_checkpoint_dir
    folder = ensure_checkpoint_dir(df.sparkSession)
    if not folder:
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    path = f"{folder}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_ADAPTIVE = "spark.sql.adaptive.enabled"


@contextlib.contextmanager
def static_plans(spark) -> Iterator[None]:
    """Plans without runtime re-planning: what is written under one keeps its partitioning,
    so that later joins and aggregates on the same keys find their rows in place."""
    before = spark.conf.get(_ADAPTIVE)
    spark.conf.set(_ADAPTIVE, "false")
    try:
        yield
    finally:
        spark.conf.set(_ADAPTIVE, before)


def laid_out(df: DataFrame, partitions: int, *keys: str) -> DataFrame:
    """``df`` written once, hash-partitioned by ``keys`` and sorted by them within partitions.
    Frames laid out alike are joined and grouped by ``keys`` without an exchange or a sort."""
    with static_plans(df.sparkSession):
        return reliable(df.repartition(partitions, *keys).sortWithinPartitions(*keys))


def shuffle_partitions(spark) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def dense_numbers(df: DataFrame, order: str, out: str) -> DataFrame:
    """``df`` (rows distinct in ``order``) with ``out`` = 0, 1, 2 … in the order of that column.

    Rows are range-partitioned and sorted once and written; only the row count of each
    partition reaches the driver and goes out again as the partitions' first numbers.
    """
    rows = reliable(df.repartitionByRange(order).sortWithinPartitions(order)
                    .withColumn("__at", F.monotonically_increasing_id()))
    part = F.shiftrightunsigned("__at", 33).cast("int")
    first, starts = 0, []
    for r in rows.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).orderBy("p").collect():
        starts.append((r["p"], first))
        first += r["n"]
    spark = df.sparkSession
    starts = F.broadcast(spark.createDataFrame(starts, "__p int, __first long"))
    within = F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    return (rows.withColumn("__p", part).join(starts, "__p")
            .withColumn(out, (F.col("__first") + within).cast("int")).drop("__at", "__p", "__first"))
