"""Reports of runs: repeated, failing and concurrent writes neither double nor lose lines."""

import os

import pytest
from pyspark.sql import functions as F

from orchard.sources import sink


def lines(spark, n, tag):
    return spark.range(n).select(F.col("id").alias("k"), F.concat(F.lit(tag), F.col("id").cast("string")).alias("line"))


def test_repeated_and_failing_runs(spark, tmpdir_fresh):
    path = os.path.join(tmpdir_fresh, "report")
    sink.commit_report(lines(spark, 10, "a"), path, "2024-01")
    sink.commit_report(lines(spark, 10, "a"), path, "2024-01")              # the same run again
    sink.commit_report(lines(spark, 4, "b"), path, "007")
    assert sink.read_report(spark, path).count() == 14
    assert sink.read_report(spark, path, "007").columns == ["k", "line"]
    broken = lines(spark, 50, "c").repartition(5).withColumn(
        "line", F.when(F.col("k") == 49, F.raise_error(F.lit("lost in between"))).otherwise(F.col("line")))
    with pytest.raises(Exception, match="lost in between"):
        sink.commit_report(broken, path, "2024-01")
    assert sorted(r.line for r in sink.read_report(spark, path, "2024-01").collect()) == sorted(f"a{i}" for i in range(10))
    sink.commit_report(lines(spark, 3, "c"), path, "2024-01")               # a shorter report replaces a longer one
    got = sorted((r.run, r.line) for r in sink.read_report(spark, path).collect())
    assert got == [("007", f"b{i}") for i in range(4)] + [("2024-01", f"c{i}") for i in range(3)]


def test_refused_runs(spark, tmpdir_fresh):
    for run in ("", "a/b"):
        with pytest.raises(ValueError):
            sink.commit_report(lines(spark, 1, "a"), tmpdir_fresh, run)
    with pytest.raises(ValueError):
        sink.commit_report(lines(spark, 1, "a").withColumn("run", F.lit(1)), tmpdir_fresh, "x")
