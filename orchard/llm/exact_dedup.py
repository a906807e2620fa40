"""Exact deduplication by skew-safe combining of digest groups.

A text can only have an equal elsewhere when its 64-bit digest is met again, so digests
are counted first (combined before the shuffle) and texts met once never move.  The
others are combined in three stages, and each one compares full texts, as the text
itself is part of the group's key:

* local: every task combines the equal texts of its own partition, so that a hot text
  leaves a task once;
* salted: the local groups of a digest are dealt to ``SALTS`` salts and merged there, so a
  text that stands in every partition is merged by many tasks;
* global: the at most ``SALTS`` winners of a text are combined.

Of equal texts the row with the largest id stays.  Groups go back to the rows by digest;
digests that more than one text has (collisions) by digest and text.  Hot digests are
broadcast, of which there can only be few (``hot.lookup``).

Defined results: a null text is empty, and empty texts are equal; a null id is smaller
than any other, and ``keep_id`` is null where a text has null ids only; of rows that share
the largest id and the text exactly one stays, any of them; an empty table gives no rows;
further columns are ignored by ``copies`` and kept as they are by ``drop_copies``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orchard.llm.common import cut, flagged, restrict, table, written
from orchard.llm.hot import lookup

SALTS = 64


def _digest(text: Column) -> Column:
    return F.xxhash64(text)


def _rows(docs: DataFrame, id_col: str, text_col: str, digest: Callable[[Column], Column]) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), digest(text).alias("h"))


def text_groups(rows: DataFrame, salts: int = SALTS) -> DataFrame:
    """``h, text, keep_id, group_size`` of every text whose digest is met more than once."""
    again = cut(rows.groupBy("h").agg(F.count("*").alias("n")).where("n > 1"))
    some = lookup(rows, again, ["h"], "n").withColumn("salt", F.spark_partition_id() % salts)
    merged = some.groupBy("h", "salt", "text").agg(F.max("doc_id").alias("keep_id"),
                                                   F.count("*").alias("group_size"))
    return merged.groupBy("h", "text").agg(F.max("keep_id").alias("keep_id"),
                                           F.sum("group_size").alias("group_size"))


def copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS,
           digest: Callable[[Column], Column] = _digest) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    rows = _rows(docs, id_col, text_col, digest)
    with written(text_groups(rows, salts)) as groups:
        by_digest = cut(groups.groupBy("h").agg(
            F.count("*").alias("texts"), F.max("keep_id").alias("keep_id"),
            F.max("group_size").alias("group_size"), F.sum("group_size").alias("rows")))
        sha = F.sha2("text", 256).alias("text_sha256")
        one_text = by_digest.where("texts = 1").select("h", "keep_id", "group_size", "rows")
        shared = cut(by_digest.where("texts > 1").select("h"))
        plain = lookup(rows.select("doc_id", "h", sha), one_text, ["h"], "rows", "left")
        marked = plain.withColumn("part", F.lit(0))
        if not shared.isEmpty():
            number = F.row_number().over(Window.partitionBy("h").orderBy("text"))
            split = cut(groups.join(shared, "h").withColumn("part", number)
                        .withColumn("rows", F.col("group_size")))
            told = lookup(restrict(rows, shared, "h"), split, ["h", "text"], "rows")
            marked = restrict(plain, shared, "h", "left_anti").withColumn("part", F.lit(0)).unionByName(
                told.select("doc_id", "h", sha, "keep_id", "group_size", "part"))
        # rows get a number of their own when they are written, so that ties can be told apart
        marked = cut(marked.withColumn("row", F.monotonically_increasing_id()))
    first = F.col("group_size").isNull() | F.col("doc_id").eqNullSafe(F.col("keep_id"))
    tops = marked.where(first & F.col("group_size").isNotNull())
    ties = cut(tops.groupBy("h", "part").agg(F.max("row").alias("stays"), F.count("*").alias("n")).where("n > 1"))
    beaten = cut(lookup(tops, ties, ["h", "part"], "n").where("row <> stays").select("row"))
    out = flagged(marked, beaten, "row", "beaten")
    return out.select("doc_id", F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(
        F.col("keep_id")).alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (first & ~F.col("beaten")).alias("kept"), "text_sha256")


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS,
                digest: Callable[[Column], Column] = _digest) -> DataFrame:
    """``docs`` with one row of every text, that with the largest id."""
    # the caller's columns travel in a struct, so that their names cannot clash
    rows = _rows(docs, id_col, text_col, digest)
    groups = cut(text_groups(rows, salts).where("group_size > 1")
                 .select("h", F.sha2("text", 256).alias("sha"), "keep_id", F.col("group_size").alias("n")))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    keyed = docs.select(F.struct("*").alias("row"), F.col(id_col).cast("long").alias("id"),
                        digest(text).alias("h"), F.sha2(text, 256).alias("sha"))
    met = lookup(keyed, groups.withColumn("copied", F.lit(True)), ["h", "sha"], "n", "left")
    alone = met.where("copied is null").select("row.*")
    top = met.where(F.col("copied") & F.col("id").eqNullSafe(F.col("keep_id")))
    return alone.unionByName(top.groupBy("h", "sha").agg(F.first("row").alias("row")).select("row.*"))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return copies(table(spark, sf_dir, "documents"))


OP12_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(t) AS text_sha256
FROM d WINDOW g AS (PARTITION BY t)
"""

QUERIES = {"op12_exact_dedup": op12_exact_dedup}
ORACLE = {"op12_exact_dedup": OP12_SQL}
