from pyspark.sql import functions as F

from orchard.functions import decode as D
from orchard.functions import prep


def test_missing_negative_quotes(spark):
    df = spark.createDataFrame([('"?"',), ('"-3"',), ('"2.5"',)], "v string")
    out = df.select(prep.missing_to_zero(prep.strip_quotes("v")).alias("x"))
    xs = [r.x for r in out.collect()]
    assert xs == [0.0, -3.0, 2.5]
    clamped = out.select(prep.clamp_nonneg("x").alias("c")).collect()
    assert [r.c for r in clamped] == [0.0, 0.0, 2.5]


def test_split_keeps_trailing_empty_and_slices(spark):
    df = spark.createDataFrame([("a\tb\t\t",)], "value string")
    f = prep.split_fields("value", "\t")
    r = df.select(F.size(f).alias("n"), prep.field_slice(f, 1, until_from_end=1).alias("s"),
                  prep.field_slice(f, 9).alias("empty")).first()
    assert r.n == 4 and r.s == ["b", ""] and r.empty == []


def test_label_rules(spark):
    df = spark.createDataFrame([("1.5,2.5,3",)], "value string")
    f = prep.split_fields("value", ",")
    r = df.select(prep.label_zero_based(f).alias("y"), prep.all_but_last(f).alias("x"),
                  prep.label_last(f).alias("last")).first()
    assert r.y == 2.0 and r.x == ["1.5", "2.5"] and r.last == 3


def test_decoders_unknown_is_null_and_truncation(spark):
    df = spark.createDataFrame([(1, 5, 2.7 / 41)], "s int, bad int, t double")
    r = df.select(D.season("s").alias("a"), D.season("bad").alias("b"),
                  D.denormalize(F.lit(2.7), 1).alias("c")).first()
    assert r.a == "spring" and r.b is None and r.c == 2


def test_strict_and_permissive_parsing(spark):
    import pytest
    from orchard.sources import text as TX
    df = spark.createDataFrame([("1\tx\t4",)], "value string")
    with pytest.raises(Exception):
        TX.parse_ratings(df).collect()
    r = TX.parse_ratings(df, mode="permissive").first()
    assert r.user_id == 1 and r.item_id is None and r.rating == 4.0


def test_decoder_error_mode_and_short_rows(spark):
    import pytest
    from orchard.sources import text as TX
    df = spark.createDataFrame([(9,)], "s int")
    with pytest.raises(Exception):
        df.select(D.season("s", on_unknown="error")).collect()
    lines = spark.createDataFrame([('"u"\t"1"\t"x"\t"c"\t"5"\t"1"',), ('"u"\t"1"',)], "value string")
    assert TX.reject_short_pages(lines).count() == 1
    assert TX.reject_short_pages(lines, labelled=False).count() == 1
