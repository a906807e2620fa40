"""Score a streaming DataFrame with a fitted feature pipeline and model.

Feature assembly (column expressions, and a stream-static join to what belongs to a
category) and prediction are stateless, so a stream is
scored with the very same operators as a batch; no state store is involved.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orchard.functions.decode import page_class
from orchard.operators.sparse import SparsePages


def score_pages_stream(pages: DataFrame, features: SparsePages, model,
                       key: str = "doc_id") -> DataFrame:
    """(key, url, prediction, class) for every page arriving on the stream; ``model`` is one of the
    models of ``orchard.operators.sparse``."""
    out = model.transform(features.transform(pages))
    return out.select(key, "url", "prediction",
                      page_class(F.col("prediction").cast("int")).alias("class"))


def start_sink(scored: DataFrame, path: str, checkpoint: str | None = None,
               trigger_once: bool = False):
    """Append scored rows to parquet; the checkpoint lives under the cluster's
    ``spark.checkpoint.dir`` in a folder of its own unless given (give one to resume)."""
    spark = scored.sparkSession
    if checkpoint is None:
        base = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir")
        checkpoint = f"{base.rstrip('/')}/stream-score-{uuid.uuid4().hex}"
    w = (scored.writeStream.format("parquet").option("path", path)
         .option("checkpointLocation", checkpoint).outputMode("append"))
    if trigger_once:
        w = w.trigger(availableNow=True)
    return w.start()
