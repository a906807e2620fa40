"""Explicit-feedback matrix factorisation and top-k recommendations."""

from __future__ import annotations

from typing import Sequence

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.ml.util import Identifiable
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orchard.operators.factors import factorise
from orchard.operators.topk import top_products
from orchard.session import ensure_checkpoint_dir

ALS_SEED = 42
FEW_RATINGS = 10_000_000
BLOCK_RATINGS = 50_000_000  # about 2 GB of an executor while the block is built
MIN_BLOCKS = 4
MANY_RATINGS = 40_000_000   # beyond, Spark's blocks of ratings and factors outgrow an executor (factors.py)


def rating_stats(ratings: DataFrame) -> DataFrame:
    """One row: n_ratings, n_users, n_items (A2)."""
    return ratings.agg(F.count(F.lit(1)).alias("n_ratings"),
                       F.countDistinct("user_id").alias("n_users"),
                       F.countDistinct("item_id").alias("n_items"))


def factor_blocks(n_ratings: int, cores: int) -> int:
    """Blocks of ALS for ``n_ratings``; each is one task.

    Few ratings: one block a core, 10 at least.  Every iteration sends each factor vector once to
    nearly every block of the other side, so what is shuffled is vectors times blocks: with many
    ratings there are as few blocks as memory allows, each of ``BLOCK_RATINGS`` at most.
    """
    if n_ratings <= FEW_RATINGS:
        return max(10, cores)
    return max(MIN_BLOCKS, -(-n_ratings // BLOCK_RATINGS))


def fit_als(ratings: DataFrame, rank: int = 5, max_iter: int = 20, reg_param: float = 0.1,
            seed: int = ALS_SEED, cold_start: str = "nan") -> ALSModel:
    """Spark ML ALS (block-partitioned; factors checkpointed every 10 iterations
    when a checkpoint folder is set, which bounds lineage on executor loss); beyond
    ``MANY_RATINGS`` the same steps with the ratings on disk (``factors.factorise``), as Spark's
    learner holds whole blocks of them and all factors they need on the heap.

    ``ratings`` is read several times (it is counted first).  Spark draws the starting vectors by
    block, so the factors vary a little with ``factor_blocks``.
    """
    spark = ratings.sparkSession
    ensure_checkpoint_dir(spark)
    rows = ratings.select("user_id", "item_id", "rating")
    try:
        cores = spark.sparkContext.defaultParallelism
    except Exception:  # noqa: BLE001 - remote session: keep Spark's default
        cores = 10
    n_ratings = rows.count()
    if n_ratings > MANY_RATINGS:
        return _model(spark, rank, *factorise(rows, rank, max_iter, reg_param, seed), cold_start)
    blocks = factor_blocks(n_ratings, cores)
    als = ALS(rank=rank, maxIter=max_iter, regParam=reg_param, userCol="user_id",
              itemCol="item_id", ratingCol="rating", seed=seed, implicitPrefs=False,
              coldStartStrategy=cold_start, checkpointInterval=10,
              numUserBlocks=blocks, numItemBlocks=blocks)
    return als.fit(rows)


def _model(spark, rank: int, users: DataFrame, items: DataFrame, cold_start: str) -> ALSModel:
    """Spark's model over given factors."""
    made = spark._jvm.org.apache.spark.ml.recommendation.ALSModel(Identifiable().uid, rank, users._jdf, items._jdf)
    model = ALSModel._from_java(made.setUserCol("user_id").setItemCol("item_id"))
    return model.setColdStartStrategy(cold_start)


def predict_pairs(model: ALSModel, pairs: DataFrame, cold_start: str = "nan") -> DataFrame:
    """Predicted rating of each (user_id, item_id) pair."""
    m = model.copy()
    m.setColdStartStrategy(cold_start)
    return m.transform(pairs)


def _best(requested: DataFrame | None, key: str, asked: DataFrame, offered: DataFrame, other: str, n: int) -> DataFrame:
    """Top-n of the factors ``offered`` for the requested keys among ``asked`` (all of them for ``None``)."""
    if requested is not None:
        ids = requested.select(F.col(key).cast("int").alias("id")).distinct()
        asked = asked.join(ids, "id", "left_semi")
    recs = top_products(asked, offered, n)
    return recs.select(F.col("rid").alias(key), "rank", F.col("id").alias(other), "score")


def items_for_users(model: ALSModel, users: DataFrame | None, n: int = 10,
                    titles: DataFrame | None = None) -> DataFrame:
    """Top-n items per requested user (``None``: every user), numbered 1..n,
    titled (X11, J2).  Unknown users give no rows; a missing title is NULL.

    Exact and by blocks (``topk``): blocks of items whose norms are too small for a user's
    n-th score are left out, and the (user, item) pairs never become rows.
    """
    recs = _best(users, "user_id", model.userFactors, model.itemFactors, "item_id", n)
    return recs if titles is None else with_titles(recs, titles)


def users_for_items(model: ALSModel, items: DataFrame | None, n: int = 10,
                    titles: DataFrame | None = None) -> DataFrame:
    """Top-n users per requested item (``None``: every item), numbered 1..n, with the
    item's title where ``titles`` is given (X12, J2).  Unknown items give no rows."""
    recs = _best(items, "item_id", model.itemFactors, model.userFactors, "user_id", n)
    return recs if titles is None else with_titles(recs, titles)


def with_titles(df: DataFrame, titles: DataFrame) -> DataFrame:
    """Add the title of each item (J2); a missing title is NULL.

    titles is a dimension table keyed by item_id; AQE broadcasts it when its
    runtime size is small, otherwise this is a shuffle join.
    """
    return df.join(titles.select("item_id", "title"), "item_id", "left")


def check_recommendations(recs: DataFrame, model: ALSModel, key: str, n: int = 10) -> DataFrame:
    """What must hold for each requested key, whatever the factors are: ``rows`` ranks
    1..rows, all different items (or users), falling scores, and each score equal to the
    product of the two factor vectors."""
    other = "item_id" if key == "user_id" else "user_id"
    u = model.userFactors.select(F.col("id").alias("user_id"), F.col("features").alias("__u"))
    i = model.itemFactors.select(F.col("id").alias("item_id"), F.col("features").alias("__i"))
    dot = F.aggregate(F.zip_with("__u", "__i", lambda a, b: a.cast("double") * b.cast("double")),
                      F.lit(0.0), lambda acc, v: acc + v)
    rows = recs.select(key, other, "rank", "score").join(u, "user_id").join(i, "item_id").select(
        key, other, "rank", "score", (F.abs(dot - F.col("score")) < 1e-4).alias("ok"))
    each = rows.groupBy(key).agg(
        F.count(F.lit(1)).cast("int").alias("n_rows"), F.countDistinct(other).cast("int").alias("n_distinct"),
        F.min("rank").alias("first_rank"), F.max("rank").alias("last_rank"), F.min("ok").alias("scores_are_products"),
        F.array_sort(F.collect_list(F.struct("rank", "score"))).alias("s"))
    falling = F.forall(F.sequence(F.lit(1), F.size("s") - 1), lambda k: F.col("s")[k - 1]["score"] >= F.col("s")[k]["score"])
    return each.select(key, "n_rows", "n_distinct", "first_rank", "last_rank", "scores_are_products",
                       F.when(F.size("s") < 2, True).otherwise(falling).alias("scores_fall"))


def top_k_per_key(df: DataFrame, key: Sequence[str], order: Sequence[Column], k: int,
                  rank_col: str = "rank") -> DataFrame:
    """Best ``k`` rows per key by ``order``.

    ``row_number() <= k`` is planned with a partial window-group limit before
    the shuffle, so each map task ships at most k rows per key: a key holding
    a third of the data does not land whole in one task.
    """
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)
