from pyspark.sql import functions as F

from orchard.operators import split as SP


def test_every_row_in_one_split_and_repartition_invariant(spark):
    df = spark.range(5000).select(F.col("id").alias("k"))
    base = {r.k: r.split for r in SP.assign_split(df, F.col("k")).collect()}
    assert set(base.values()) == {"train", "validation", "test"}
    for n in (1, 4, 13):
        again = {r.k: r.split for r in SP.assign_split(df.repartition(n), F.col("k")).collect()}
        assert again == base
    counts = {r.split: r.n for r in SP.split_counts(SP.assign_split(df, F.col("k"))).collect()}
    assert sum(counts.values()) == 5000
    assert 3700 < counts["train"] < 4300


def test_weights_normalised_and_sample(spark):
    df = spark.range(2000).select(F.col("id").alias("k"))
    a = SP.assign_split(df, F.col("k"), (0.8, 0.1, 0.1)).collect()
    b = SP.assign_split(df, F.col("k"), (8, 1, 1)).collect()
    assert a == b
    n = SP.sample_fraction(df, F.col("k"), 0.1).count()
    assert 130 < n < 270


def test_minibatch_fraction(spark):
    df = SP.with_unit(spark.range(4000).select(F.col("id").alias("k")), F.col("k"))
    for t in (1, 2, 3):
        n = df.where(SP.minibatch_flag("u", t, 0.5)).count()
        assert 1800 < n < 2200
    assert df.where(SP.minibatch_flag("u", 1, 1.0)).count() == 4000


def test_batches_of_different_steps_are_independent(spark):
    """Pairs of steps share f^2 of the rows, and so do pairs of rows with neighbouring uniforms."""
    import numpy as np
    from orchard.functions.hashing import step_unit
    df = SP.with_unit(spark.range(40_000).select(F.col("id").alias("k")), F.col("k"))
    steps = range(1, 9)
    rows = df.orderBy("u").select(*[SP.minibatch_flag("u", t, 0.3).alias(f"b{t}") for t in steps],
                                  step_unit(F.col("u"), 3).alias("v")).toPandas()
    b = np.stack([rows[f"b{t}"].to_numpy(float) for t in steps])
    shared = b @ b.T / b.shape[1]
    off = shared[~np.eye(len(b), dtype=bool)]
    assert abs(off - 0.09).max() < 0.012 and abs(np.diag(shared) - 0.3).max() < 0.012
    together = (b[:, 1:] * b[:, :-1]).mean(axis=1)          # neighbours in u
    assert abs(together - 0.09).max() < 0.012
    assert 0 <= rows["v"].min() and rows["v"].max() < 1


def test_reliable_cuts_lineage_into_checkpoint_folder(spark):
    from orchard.operators.common import reliable
    from orchard.session import ensure_checkpoint_dir
    assert ensure_checkpoint_dir(spark)            # tests run local: a scratch folder is set
    df = spark.range(100).groupBy((F.col("id") % 7).alias("k")).count()
    r = reliable(df)
    assert "Aggregate" not in r._jdf.queryExecution().logical().toString()
    assert sorted(x.k for x in r.collect()) == list(range(7))


def test_small_weights_are_exact_or_refused(spark):
    import pytest
    assert SP._int_weights([0.9998, 0.0001, 0.0001]) == [9998, 1, 1]
    assert SP._int_weights([0.999, 0.0005, 0.0005]) == [1998, 1, 1]
    assert SP._int_weights([1, 0, 3]) == [1, 0, 3]
    for bad in ([1, 1e-9, 0], [-1, 2], [0, 0]):
        with pytest.raises(ValueError):
            SP._int_weights(bad)
    df = spark.range(40_000).select(F.col("id").alias("k"))
    n = {r.split: r.n for r in SP.split_counts(SP.assign_split(df, F.col("k"), (0.998, 0.001, 0.001))).collect()}
    assert sum(n.values()) == 40_000 and n["validation"] > 10 and n["test"] > 10
