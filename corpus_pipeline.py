"""Training-data pipeline over ``documents``: five stages, each on what the one before kept.

Quality (Kneser-Ney perplexity), line dedup (deletion neighbourhood), near-duplicate
documents (prefix-tree n-gram join; the smallest doc_id of a group stays), benchmark
decontamination (q-gram lemma; documents that hold an item go) and packing into
sequences (best fit, certified).  Every stage's rows are written as Parquet into the
cluster's shared checkpoint folder and read again by the next one.

Defined results: null and empty texts pass the first four stages and are packed as
the end token alone; a document whose lines are all repeats of earlier ones goes with
them; rows without an id are never rejected; an empty table gives no sequences; further
columns of ``documents`` are carried along up to the last stage; ``n_chars`` follows
the text.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orchard.llm import decontaminate, line_dedup, ngram_join, packing, quality
from orchard.llm.common import shared_folder, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = line_dedup.keep_lines(docs)
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.char_length("text").cast(dict(docs.dtypes)["n_chars"]))
    return kept


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("n-gram Jaccard join", near_stage),
    ("benchmark decontamination", benchmark_stage),
    ("best-fit packing", packing_stage),
]

# Perplexity, alignment and tokenisation are beyond SQL; tests/llm checks each stage by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
        if i:                               # what the stage has read is not needed again
            past = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{i - 1}")
            past.getFileSystem(spark._jsc.hadoopConfiguration()).delete(past, True)
    return docs
