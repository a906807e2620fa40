"""Stand-in views reproduce the row counts stated for the fixtures (sf0.01)."""

from pyspark.sql import functions as F

from conftest import SF_MID
from orchard.sources import views as V


def test_view_counts(spark):
    assert V.ratings(spark, SF_MID).count() == 59391
    r = V.ratings(spark, SF_MID).agg(F.countDistinct("user_id").alias("u"),
                                     F.countDistinct("item_id").alias("i"),
                                     F.min("rating").alias("lo"), F.max("rating").alias("hi")).first()
    assert (r.u, r.i, r.lo, r.hi) == (1500, 2000, 1.0, 5.0)
    assert V.titles(spark, SF_MID).count() == 2000
    pt = V.page_train(spark, SF_MID)
    assert pt.count() == 399 and pt.where("label = 1").count() == 341
    assert pt.where("f1 < 0").count() == 60
    assert V.page_score(spark, SF_MID).count() == 601
    bb = V.binary_big(spark, SF_MID)
    assert bb.count() == 60000 and bb.where("label = 1").count() == 31846
    assert bb.select("category").distinct().count() == 5
    assert V.multi(spark, SF_MID).count() == 500
    assert V.hourly(spark, SF_MID).count() == 720
    assert V.page_line(spark, SF_MID).count() == 399
    assert V.page_line_new(spark, SF_MID).count() == 601
