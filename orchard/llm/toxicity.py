"""Toxicity scores by FTRL-proximal logistic regression over hashed word n-grams.

Features of a text are the 64-bit hashes of its lower-cased words, its word pairs
and its one-word skip-grams (first and third of three words), each present or not.
Training follows McMahan et al. (2013): per-coordinate learning rates and an L1
term that leaves most weights at zero.  The labelled sample is bounded
(``max_rows``); features are admitted when ``min_docs`` sampled documents have
them.  Every epoch the shards of the sample run FTRL from the same state and
their states are averaged.  What remains is a short list of non-zero weights,
whose size is bounded by ``max_weights``, sent to every task that scores.

Defined results: a null or empty text scores as the bias alone; repeated rows are
scored alike; documents without a label take no part in training; with no
labelled row of both classes every text scores the base rate (0.5 if there is no
label at all); repeated labels of an id count once, toxic if any of them is.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orchard.llm.common import (Powers, byte_batches, cut, mix64, prefix_sums, release, restrict,
                                span_hashes, table, texts, tidy, word_spans)

MAX_ROWS = 8_000       # labelled documents that the model is fitted on
MIN_DOCS = 4            # sampled documents that a feature must occur in
MAX_WEIGHTS = 200_000
SHARDS, EPOCHS = 4, 6
ALPHA, BETA, L1, L2 = 1.0, 1.0, 4.0, 0.1
THRESHOLD = 0.3

# byte -> its lower case; 0 for what separates words
_FOLD = np.array([b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 0
                  for b in range(256)], np.uint8)


def gram_hashes(data: np.ndarray, offsets: np.ndarray, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document) of every word, word pair and skip-gram of a run of texts."""
    low = _FOLD[data]
    start, end, doc = word_spans(low != 0, offsets)
    h = span_hashes(prefix_sums(low, powers), start, end, powers)
    pair = doc[1:] == doc[:-1]
    skip = doc[2:] == doc[:-2]
    two = mix64(h[:-1] * np.uint64(0x9FB21C651E98DF25) + h[1:])[pair]
    gap = mix64(h[:-2] * np.uint64(0xD1B54A32D192ED03) + h[2:] + np.uint64(1))[skip]
    return np.concatenate((h, two, gap)), np.concatenate((doc, doc[:-1][pair], doc[:-2][skip]))


def _document_features(docs: DataFrame) -> DataFrame:
    schema = pa.schema([("doc_id", pa.int64()), ("features", pa.list_(pa.int64()))])

    def run(it):
        powers = Powers()
        for ids, data, off in byte_batches(it):
            h, d = gram_hashes(data, off, powers)
            order = np.lexsort((h, d))
            h, d = h[order], d[order]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
            h, d = h[new].view(np.int64), d[new]
            ends = np.searchsorted(d, np.arange(len(ids) + 1))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(h))
            yield pa.record_batch([pa.array(ids, pa.int64()), lists], schema=schema)

    return docs.mapInArrow(tidy(run), "doc_id long, features array<long>")


def ftrl_pass(rows, labels, z: np.ndarray, n: np.ndarray) -> None:
    """One pass over ``rows`` (feature positions; 0 is the bias); z and n change in place."""
    for x, y in zip(rows, labels):
        x = np.append(x, 0)
        zx, root = z[x], np.sqrt(n[x])
        l1 = np.where(x == 0, 0.0, L1)
        w = np.where(np.abs(zx) <= l1, 0.0, (np.sign(zx) * l1 - zx) / ((BETA + root) / ALPHA + L2))
        g = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35))) - y
        z[x] += g - (np.sqrt(root * root + g * g) - root) / ALPHA * w
        n[x] += g * g


def ftrl_weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    l1 = np.full(len(z), L1)
    l1[0] = 0.0
    return np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))


class ToxicityModel:
    """Non-zero weights by feature hash (sorted) and the bias."""

    def __init__(self, keys: np.ndarray, weights: np.ndarray, bias: float):
        self.keys, self.weights, self.bias = keys, weights, bias

    def scores(self, data: np.ndarray, offsets: np.ndarray, powers: Powers) -> np.ndarray:
        total = np.full(len(offsets) - 1, self.bias)
        if len(self.keys):
            h, d = gram_hashes(data, offsets, powers)
            maybe = np.zeros(1 << 16, bool)
            maybe[(self.keys & np.uint64(0xFFFF)).astype(np.int64)] = True
            near = np.flatnonzero(maybe[(h & np.uint64(0xFFFF)).astype(np.int64)])
            at = np.searchsorted(self.keys, h[near])
            at[at == len(self.keys)] = 0
            hit = self.keys[at] == h[near]
            seen = np.unique(d[near[hit]] * len(self.keys) + at[hit])
            np.add.at(total, seen // len(self.keys), self.weights[seen % len(self.keys)])
        return 1.0 / (1.0 + np.exp(-np.clip(total, -35, 35)))

    def transform(self, docs: DataFrame) -> DataFrame:
        """``doc_id, score`` of every row of ``docs``."""
        spark = docs.sparkSession
        held = spark.sparkContext.broadcast((self.keys, self.weights, self.bias))
        schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

        def run(it):
            model, powers = ToxicityModel(*held.value), Powers()
            for ids, data, off in byte_batches(it):
                yield pa.record_batch([pa.array(ids, pa.int64()),
                                       pa.array(model.scores(data, off, powers))], schema=schema)

        return texts(docs).mapInArrow(tidy(run), "doc_id long, score double")


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, min_docs: int = MIN_DOCS,
        shards: int = SHARDS, epochs: int = EPOCHS) -> ToxicityModel:
    """Fit on ``labels(doc_id, toxic)``: the ``max_rows`` of them that come first by hash."""
    empty = np.empty(0, np.uint64)
    sample = cut(labels.where("doc_id is not null and toxic is not null")
                 .groupBy("doc_id").agg(F.max("toxic").cast("double").alias("y"))
                 .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows))
    base = sample.agg(F.avg("y").alias("p")).head()["p"]
    if base is None or base <= 0 or base >= 1:
        p = min(max(0.5 if base is None else base, 1e-6), 1 - 1e-6)
        return ToxicityModel(empty, np.empty(0), float(np.log(p / (1 - p))))
    rows = cut(_document_features(restrict(texts(docs), sample.select("doc_id"), "doc_id"))
               .join(F.broadcast(sample), "doc_id").dropDuplicates(["doc_id"]))
    admitted = (rows.select(F.explode("features").alias("f")).groupBy("f").count()
                .where(F.col("count") >= min_docs).select("f").toPandas()["f"])
    keys = np.sort(admitted.to_numpy(np.int64).view(np.uint64))
    sc = docs.sparkSession.sparkContext
    held = sc.broadcast(keys)

    def place(it):
        for pdf in it:
            known = held.value
            out = []
            for f in pdf["features"]:
                f = np.asarray(f, np.int64).view(np.uint64)
                at = np.searchsorted(known, f)
                at[at == len(known)] = 0
                out.append((at[known[at] == f] + 1).astype(np.int32) if len(known) else
                           np.empty(0, np.int32))
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "y": pdf["y"], "x": out})

    data = cut(rows.mapInPandas(tidy(place), "doc_id long, y double, x array<int>")
               .withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(shards))))
    z, n = np.zeros(len(keys) + 1), np.zeros(len(keys) + 1)
    for _ in range(epochs):
        state = sc.broadcast((z, n))

        def run(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values("doc_id")
            zs, ns = (a.copy() for a in state.value)
            ftrl_pass([np.asarray(x, np.int64) for x in pdf["x"]], pdf["y"], zs, ns)
            at = np.flatnonzero(ns)
            return pd.DataFrame({"at": at, "z": zs[at], "n": ns[at]})

        # sums over shards are combined per partition; at most len(keys) + 1 rows return
        mixed = (data.groupBy("shard").applyInPandas(tidy(run), "at long, z double, n double")
                 .groupBy("at").agg((F.sum("z") / shards).alias("z"), (F.sum("n") / shards).alias("n"))
                 .toPandas())
        z, n = np.zeros(len(keys) + 1), np.zeros(len(keys) + 1)
        z[mixed["at"]], n[mixed["at"]] = mixed["z"], mixed["n"]
        state.unpersist()
    w = ftrl_weights(z, n)
    del z, n, mixed
    release()
    at = np.flatnonzero(w[1:])
    if len(at) > MAX_WEIGHTS:
        raise ValueError("too many non-zero weights: raise L1 or min_docs")
    return ToxicityModel(keys[at], w[1:][at], float(w[0]))



def op2_ftrl_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4))
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").where(fold != 2)
    model = fit(docs, labels)
    return model.transform(docs).select(
        "doc_id", F.coalesce(fold == 2, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


QUERIES = {"op2_ftrl_toxicity": op2_ftrl_toxicity}
