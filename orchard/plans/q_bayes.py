"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator key.

Every query reads whole tables (through the stand-in views) and returns a
frame whose floating columns are rounded to 6 digits so that it can be
compared with the DuckDB oracle in ``orchard.plans.sql_*``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orchard.operators import bayes, evaluate
from orchard.plans import prepared as P
from orchard.plans.settings import NB_LAMBDA

def r6(c):
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def _explode_vec(df: DataFrame, keys, col: str = "features") -> DataFrame:
    """Vector column in long form: keys..., j, value (rounded).

    ``posexplode_outer``: the plain form makes Catalyst infer a
    ``size(features) > 0`` filter and push it below the joins, which would
    compute every feature (text scans included) twice.
    """
    e = df.select(*keys, F.posexplode_outer(col).alias("j", "v"))
    return e.select(*keys, F.col("j").cast("int").alias("j"), r6("v").alias("value"))


# ---- naive Bayes on binary_big ----------------------------------------------

def _nb_fit(spark, sf):
    prep = P.binary(spark, sf, nb=True)
    train = prep.part("train")
    stats = bayes.collect_stats(bayes.class_stats(train, prep.dim), prep.dim)
    return prep, stats


def q_nb_sufficient_stats(spark: SparkSession, sf: str) -> DataFrame:
    prep = P.binary(spark, sf, nb=True)
    st = bayes.class_stats(prep.part("train"), prep.dim)
    long = st.select("label", "n", F.posexplode(F.array(*[f"s{j}" for j in range(prep.dim)]))
                     .alias("j", "s"))
    # a sum of ~1e5 terms carries ~1e-8 of float noise, its mean does not: the mean is
    # compared at 6 decimals, the sum itself at 3
    return long.select("label", "n", F.col("j").cast("int").alias("j"), F.round("s", 3).alias("sum_x"),
                       r6(F.col("s") / F.col("n")).alias("mean_x"))


def q_fit_naive_bayes(spark: SparkSession, sf: str) -> DataFrame:
    prep, stats = _nb_fit(spark, sf)
    m = bayes.model_from_stats(stats, NB_LAMBDA)
    rows = [(lab, float(pi), j, float(t)) for lab, pi, th in zip(m.labels, m.log_prior, m.log_theta)
            for j, t in enumerate(th)]
    df = spark.createDataFrame(rows, "label double, log_prior double, j int, log_theta double")
    return df.select("label", r6("log_prior").alias("log_prior"), "j",
                     r6("log_theta").alias("log_theta"))


def q_predict_naive_bayes(spark: SparkSession, sf: str) -> DataFrame:
    prep, stats = _nb_fit(spark, sf)
    m = bayes.model_from_stats(stats, NB_LAMBDA)
    return m.transform(prep.frame).select(*prep.key, "split", "label", "prediction")


def q_eval_train_validate_test(spark: SparkSession, sf: str) -> DataFrame:
    """Default run (E6): NB with lambda 5 fitted on train; AUC on validation and test.

    The whole fit (dictionary, scaler, class statistics) is one scan; scoring
    and both metrics are a second one.
    """
    from orchard.operators.split import assign_split
    from orchard.sources import views as V
    bb = assign_split(V.binary_big(spark, sf), V.binary_key())
    pf, m = bayes.fit_page_naive_bayes(bb, V.BINARY_NUMERIC, NB_LAMBDA,
                                       fit_on=F.col("split") == "train")
    rest = bb.where(F.col("split").isin("validation", "test"))
    scored = m.transform(pf.transform(rest).withColumn("label", F.col("label").cast("double")))
    return evaluate.auc_hard_by(scored, "split").select("split", "n", r6("auc_hard").alias("auc_hard"))


BAYES_QUERIES = {
    "nb_sufficient_stats": q_nb_sufficient_stats,
    "fit_naive_bayes": q_fit_naive_bayes,
    "predict_naive_bayes": q_predict_naive_bayes,
    "eval_train_validate_test": q_eval_train_validate_test,
}
