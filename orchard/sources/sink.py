"""Report sink (S8): results stay DataFrames; a text column carries the line.

A report of a run is a partition of its own (``run=<id>``), so writing is idempotent: Spark
stages the new files beside the old ones and swaps the run's partition when all of them
are there.  A task or a run that is repeated replaces its lines, one that fails leaves
what was there, and other runs are not touched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUN = "run"


def write_report(df: DataFrame, path: str, mode: str = "overwrite", fmt: str = "parquet") -> None:
    """Write a report frame (one formatted ``line`` column plus its fields)."""
    df.write.mode(mode).format(fmt).save(path)


def commit_report(df: DataFrame, path: str, run: str, fmt: str = "parquet") -> None:
    """Write the report of ``run`` under ``path``, in place of what that run has written before.

    An empty report leaves the run as it was: it has no partition to put in its place."""
    if not run or "/" in run:
        raise ValueError(f"not a run id: {run!r}")
    if RUN in df.columns:
        raise ValueError(f"a report has no column {RUN!r} of its own")
    (df.withColumn(RUN, F.lit(run)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(RUN).format(fmt).save(path))


def read_report(spark: SparkSession, path: str, run: str | None = None, fmt: str = "parquet") -> DataFrame:
    """The committed lines of one run, or of all with their run id."""
    runs = spark.read.format(fmt).option("inferSchema", "false").load(path).withColumn(RUN, F.col(RUN).cast("string"))
    return runs if run is None else runs.where(F.col(RUN) == run).drop(RUN)
