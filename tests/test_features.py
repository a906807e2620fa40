import pytest
from pyspark.ml.feature import StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from orchard.operators import features as FT


def test_scaler_values_and_constant_feature(spark):
    df = spark.createDataFrame([([1.0, 7.0],), ([3.0, 7.0],), ([8.0, 7.0],)], "features array<double>")
    m = FT.fit_scaler(df, 2)
    out = sorted(r.features[0] for r in m.transform(df).collect())
    assert out == pytest.approx([-0.8321, -0.2774, 1.1094], abs=1e-4)
    assert {r.features[1] for r in m.transform(df).collect()} == {0.0}


def test_scaler_matches_spark_ml(spark):
    rows = [([float(i), float(i * i % 7), 1.0 + i / 3.0],) for i in range(50)]
    df = spark.createDataFrame(rows, "features array<double>")
    for with_mean in (True, False):
        ours = FT.fit_scaler(df, 3, with_mean=with_mean).transform(df).collect()
        v = df.withColumn("v", array_to_vector("features"))
        ml = StandardScaler(inputCol="v", outputCol="s", withMean=with_mean, withStd=True).fit(v)
        theirs = ml.transform(v).select(vector_to_array("s").alias("s")).collect()
        for a, b in zip(ours, theirs):
            assert a.features == pytest.approx(b.s, rel=1e-12, abs=1e-12)


def test_dictionary_one_hot_and_unknown(spark):
    df = spark.createDataFrame([("b",), ('"a"',), ("c",), ("a",)], "category string")
    idx = FT.fit_category_index(df, "category")
    assert idx.categories == ["a", "b", "c"]
    oh = idx.lookup(df, "category").select(idx.one_hot("cat_idx").alias("o")).collect()
    assert all(sum(r.o) == 1.0 and len(r.o) == 3 for r in oh)
    new = spark.createDataFrame([("zzz",)], "category string")
    z = idx.lookup(new, "category", on_unknown="zero").select(idx.one_hot("cat_idx").alias("o"))
    assert z.first().o == [0.0, 0.0, 0.0]
    with pytest.raises(Exception):
        idx.lookup(new, "category", on_unknown="error").collect()


def test_too_many_categories_refused(spark):
    df = spark.range(20).select(F.col("id").cast("string").alias("category"))
    with pytest.raises(ValueError):
        FT.fit_category_index(df, "category", max_categories=10)


def test_one_pass_page_fit_equals_two_pass(spark):
    rows = [(i, ["a", "b", "c"][i % 3], float(i % 7) - 2.0, None if i % 5 == 0 else float(i * 3 % 11),
             "train" if i % 4 else "test") for i in range(300)]
    df = spark.createDataFrame(rows, "k int, category string, f0 double, f1 double, split string")
    pf = FT.fit_page_features(df, ["f0", "f1"], fit_on=F.col("split") == "train")
    assert pf.index.categories == ["a", "b", "c"]
    assembled = FT.PageFeatures(pf.index, ["f0", "f1"], None).assemble(df.where("split = 'train'"))
    ref = FT.fit_scaler(assembled, pf.dim)
    assert pf.scaler.mean == pytest.approx(ref.mean, rel=1e-12, abs=1e-14)
    assert pf.scaler.std == pytest.approx(ref.std, rel=1e-12, abs=1e-14)
    out = pf.transform(df).select("features").collect()
    assert all(len(r.features) == 5 for r in out)


def test_large_dictionary_uses_broadcast_join(spark):
    df = spark.range(100).select(F.concat(F.lit("c"), F.col("id").cast("string")).alias("category"))
    idx = FT.fit_category_index(df, "category")
    assert idx.size == 100 > FT.INLINE_LOOKUP_MAX
    got = idx.lookup(df, "category").select("category", "cat_idx").collect()
    want = {c: i for i, c in enumerate(sorted(r.category for r in df.collect()))}
    assert all(want[r.category] == r.cat_idx for r in got)


def test_standardized_training_columns_have_mean0_std1(spark):
    import statistics
    from orchard.plans import prepared as P
    from conftest import SF_MID
    prep = P.pages(spark, SF_MID, nb=False)
    long = prep.features.long(prep.part("train"), "doc_id").collect()
    assert {r.j for r in long} == set(range(prep.features.dim))
    for j in range(prep.features.dim):
        col = [r.value for r in long if r.j == j]
        if statistics.pstdev(col) == 0:
            continue
        assert statistics.mean(col) == pytest.approx(0.0, abs=1e-9)
        assert statistics.stdev(col) == pytest.approx(1.0, rel=1e-9)
