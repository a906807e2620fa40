"""Stand-in datasets derived from the parquet tables (see FIXTURES.md).

Each view is a lazy DataFrame over whole tables: joins and aggregates are
left to Catalyst/AQE (sort-merge or broadcast picked from runtime sizes, skew
joins split by AQE), and only the columns a view needs are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orchard.functions.hashing import md5_bucket, row_key


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---- ratings / titles (recommender) -----------------------------------------

def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, item_id, rating 1..5): one cell per customer and part."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    q = (li.join(o, li.l_orderkey == o.o_orderkey)
         .groupBy("o_custkey", "l_partkey")
         .agg(F.avg("l_quantity").alias("q")))
    return q.select(
        F.col("o_custkey").cast("int").alias("user_id"),
        F.col("l_partkey").cast("int").alias("item_id"),
        F.least(F.lit(5), F.floor(F.col("q") / 10).cast("int") + 1)
        .cast("double").alias("rating"))


def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("int").alias("item_id"), F.col("p_name").alias("title"))


# ---- pages (two-class pipeline shape) ----------------------------------------

def _count_char(text, ch: str):
    return F.length(text) - F.length(F.replace(text, F.lit(ch), F.lit("")))


def _page_columns(d):
    text = F.col("text")
    return [
        F.col("doc_id"),
        F.concat(F.lit("http://"), F.col("source"), F.lit(".example/"),
                 F.col("doc_id").cast("string")).alias("url"),
        F.col("lang").alias("category"),
        F.col("n_chars").cast("double").alias("f0"),
        (_count_char(text, " ") - 100).cast("double").alias("f1"),
        F.when(F.col("doc_id") % 11 == 0, F.lit(None).cast("double"))
        .otherwise(_count_char(text, "\n").cast("double")).alias("f2"),
        _count_char(text, ",").cast("double").alias("f3"),
    ]


PAGE_NUMERIC = ["f0", "f1", "f2", "f3"]


def _page_features(spark: SparkSession, sf_dir: str, ids: DataFrame | None = None) -> DataFrame:
    """Per-document page columns, computed before any join so that a shuffle
    moves a handful of numbers per document instead of its whole text.
    ``ids``: a short list of documents; others' texts are not counted through."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    if ids is not None:
        d = d.join(F.broadcast(ids), "doc_id", "left_semi")
    return d.select(*_page_columns(d))


def labelled_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id").join(
        table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi")


def unlabelled_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id").join(
        table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_anti")


def first_ids(ids: DataFrame, n: int) -> DataFrame:
    """The first ``n`` ids: what a report of n rows needs to read (so n bounds the list)."""
    return ids.orderBy("doc_id").limit(n)


def page_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    lab = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    return _page_features(spark, sf_dir).join(lab, "doc_id")


def page_score(spark: SparkSession, sf_dir: str, ids: DataFrame | None = None) -> DataFrame:
    """Unlabelled pages; ``ids``: a short list of them, taken as given."""
    if ids is not None:
        return _page_features(spark, sf_dir, ids)
    lab = table(spark, sf_dir, "labels").select("doc_id")
    return _page_features(spark, sf_dir).join(lab, "doc_id", "left_anti")


def _page_text(pages: DataFrame, *last: str) -> DataFrame:
    """(doc_id, value): quoted, tab-separated lines; a missing number is ``"?"``."""
    q = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    nums = [q(F.coalesce(F.col(c).cast("bigint").cast("string"), F.lit("?"))) for c in PAGE_NUMERIC]
    return pages.select("doc_id", F.concat_ws(
        "\t", q(F.col("url")), F.col("doc_id").cast("string"), F.lit('"x"'), q(F.col("category")),
        *nums, *[q(F.col(c).cast("string")) for c in last]).alias("value"))


def page_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled pages as text lines, the label last."""
    return _page_text(page_train(spark, sf_dir), "label").select("value")


def page_line_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unlabelled pages as text lines: the same layout without the label."""
    return _page_text(page_score(spark, sf_dir)).select("value")


def page_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(file, line, value): the labelled lines as ten files, each with a header line
    in front and, as data, one line that reads like the header at its end."""
    rows = _page_text(page_train(spark, sf_dir), "label").select(
        (F.col("doc_id") % 10).cast("int").alias("file"), (F.col("doc_id") + 1).alias("line"), "value")
    ends = rows.groupBy("file").agg(F.max("line").alias("last")).select(
        "file", F.explode(F.array(F.lit(0).cast("bigint"), F.col("last") + 1)).alias("line"),
        F.lit(PAGE_HEADER).alias("value"))
    return rows.unionByName(ends)


# ---- binary_big (model quality) ---------------------------------------------

BINARY_NUMERIC = ["f0", "f1", "f2", "f3"]
BINARY_KEY = ["l_orderkey", "l_linenumber"]


def binary_big(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    return j.select(
        "l_orderkey", "l_linenumber",
        F.col("o_orderpriority").alias("category"),
        F.col("l_quantity").alias("f0"), F.col("l_extendedprice").alias("f1"),
        F.col("l_discount").alias("f2"), F.col("l_tax").alias("f3"),
        F.when(F.col("l_extendedprice") + F.col("o_totalprice") / 10 > 75000, 1)
        .otherwise(0).alias("label"))


def binary_key():
    return row_key(*BINARY_KEY)


# ---- multi (multi-class) ----------------------------------------------------

def multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(vec_id, features array<double>, label 0..9)."""
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id",
                    F.transform("embedding", lambda x: x.cast("double")).alias("features"),
                    F.col("label").cast("double").alias("label"))


def multi_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comma lines ``f0,...,f63,label+1`` (class code written one-based)."""
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", F.concat_ws(
        ",", F.transform("embedding", lambda x: x.cast("double").cast("string")),
        (F.col("label") + 1).cast("string")).alias("value"))


# ---- hourly (regression) ----------------------------------------------------

HOURLY_FEATURES = ["season", "mnth", "hr", "holiday", "weekday", "workingday",
                   "weathersit", "temp", "atemp", "hum", "windspeed"]


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events counted per hour with calendar codes and derived weather."""
    ev = table(spark, sf_dir, "events").select("ts")
    g = ev.groupBy(
        # hour of the wall clock, kept as TIMESTAMP_NTZ: no session time zone
        # (or daylight-saving gap) ever shifts an event to another hour
        F.make_timestamp_ntz(F.year("ts"), F.month("ts"), F.dayofmonth("ts"), F.hour("ts"),
                             F.lit(0), F.lit(0).cast("decimal(16,6)")).alias("h"),
    ).agg(F.count(F.lit(1)).alias("label"))
    # every calendar column is a function of the hour: derived after the aggregate
    dow = F.dayofweek("h") - 1
    g = g.select(
        "h",
        F.quarter("h").cast("int").alias("season"),
        F.month("h").cast("int").alias("mnth"),
        F.hour("h").cast("int").alias("hr"),
        F.when((F.month("h") == 1) & (F.dayofmonth("h") == 1), 1).otherwise(0).alias("holiday"),
        dow.cast("int").alias("weekday"),
        F.when(dow.isin(0, 6), 0).otherwise(1).alias("workingday"),
        (F.hour("h") % 4 + 1).cast("int").alias("weathersit"), "label")
    hr = F.col("hr")
    # The four normalised weather columns have no source table; derive them
    # from the hour so reports and trees have values to work with.
    return g.select(
        "*",
        ((hr % 10) / 10.0).alias("temp"),
        ((hr % 5) / 5.0).alias("atemp"),
        (((hr + F.col("weekday")) % 10) / 10.0).alias("hum"),
        ((hr % 3) / 3.0).alias("windspeed"))


def hourly_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comma lines in the 17-field hourly layout (no header)."""
    h = hourly(spark, sf_dir)
    cols = [F.date_format("h", "yyyyMMddHH"), F.date_format("h", "yyyy-MM-dd"),
            F.col("season"), F.lit(0), F.col("mnth"), F.col("hr"), F.col("holiday"),
            F.col("weekday"), F.col("workingday"), F.col("weathersit"), F.col("temp"),
            F.col("atemp"), F.col("hum"), F.col("windspeed"), F.lit(0), F.col("label"),
            F.col("label")]
    return h.select("h", F.concat_ws(",", *[c.cast("string") for c in cols]).alias("value"))


def split_bucket(key_col) -> "F.Column":
    """Split bucket 0..9 of a row key: 0-7 train, 8 validation, 9 test."""
    return md5_bucket(key_col, 10)


# ---- text lines built from tables (inputs of the parsers) ---------------------

def ratings_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``user<TAB>item<TAB>rating<TAB>stamp`` lines (four fields, three read)."""
    r = ratings(spark, sf_dir)
    return r.select(F.concat_ws("\t", F.col("user_id").cast("string"),
                                F.col("item_id").cast("string"),
                                F.col("rating").cast("string"),
                                (F.col("user_id") + F.col("item_id")).cast("string"))
                    .alias("value"))


def titles_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id|title|brand`` lines."""
    p = table(spark, sf_dir, "part")
    return p.select(F.concat_ws("|", F.col("p_partkey").cast("string"), F.col("p_name"),
                                F.col("p_brand")).alias("value"))


PAGE_HEADER = "url\tid\tx\tcategory\tf0\tf1\tf2\tf3\tlabel"
