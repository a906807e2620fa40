"""Registered queries: sources, parsing, decoders, features, splits, metrics."""

from __future__ import annotations

import contextlib
import uuid

from pyspark.sql import functions as F

from orchard.functions import decode as D
from orchard.functions import prep
from orchard.operators import bayes, evaluate, features as FT, split as SP
from orchard.operators.common import reliable
from orchard.operators.recommend import rating_stats, top_k_per_key, with_titles
from orchard.plans import prepared as P
from orchard.plans.q_bayes import _explode_vec, r6
from orchard.plans.settings import NB_LAMBDA
from orchard.session import ensure_checkpoint_dir
from orchard.sources import text as TX
from orchard.sources import views as V


# ---- sources -------------------------------------------------------------------

def q_src_ratings_tsv(spark, sf):
    return TX.parse_ratings(V.ratings_line(spark, sf))


def q_src_titles_pipe(spark, sf):
    return TX.parse_titles(V.titles_line(spark, sf))


def _numbers():
    return [F.col("numeric").getItem(j).alias(f"x{j}") for j in range(4)]


def q_src_pages_train_tsv(spark, sf):
    p = TX.parse_pages(V.page_line(spark, sf), labelled=True)
    return p.select("url", "category", F.size("numeric").alias("n_numeric"), *_numbers(), "label")


def q_src_pages_score_tsv(spark, sf):
    p = TX.parse_pages(V.page_line_new(spark, sf), labelled=False)
    return p.select("url", "category", F.size("numeric").alias("n_numeric"), *_numbers())


def q_src_numeric_csv(spark, sf):
    p = TX.parse_numeric(V.multi_line(spark, sf), keep=("vec_id",))
    e = p.select("vec_id", "label", F.posexplode_outer("features").alias("j", "v"))
    return e.select("vec_id", "label", F.col("j").cast("int").alias("j"), r6("v").alias("value"))


def q_src_hourly_csv(spark, sf):
    p = TX.parse_hourly(V.hourly_line(spark, sf), keep=("h",))
    e = p.select(F.date_format("h", "yyyy-MM-dd HH:mm:ss").alias("h"), "label",
                 F.posexplode_outer("features").alias("j", "v"))
    return e.select("h", "label", F.col("j").cast("int").alias("j"), r6("v").alias("value"))


@contextlib.contextmanager
def _files(lines, header=None):
    """Folder of several text files that hold the lines, each with its own header line where one is given."""
    spark = lines.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/lines-{uuid.uuid4().hex}"
    lines = lines.select("value").repartition(4)
    if header is None:
        lines.write.text(path)
    else:
        lines.withColumnRenamed("value", header).write.option("header", True).option("quote", "").option(
            "escape", "").option("sep", TX.NO_DELIMITER).csv(path)
    try:
        yield path
    finally:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def q_src_ratings_files(spark, sf):
    with _files(V.ratings_line(spark, sf)) as path:
        return reliable(TX.read_ratings(spark, path))


def q_src_pages_files(spark, sf):
    with _files(V.page_line(spark, sf), V.PAGE_HEADER) as path:
        p = TX.read_pages(spark, path)
        return reliable(p.select("url", "category", F.size("numeric").alias("n_numeric"), *_numbers(), "label"))


def q_src_hourly_files(spark, sf):
    with _files(V.hourly_line(spark, sf), ",".join(f"c{i}" for i in range(TX.HOURLY_FIELDS))) as path:
        e = TX.read_hourly(spark, path).select("label", F.posexplode_outer("features").alias("j", "v"))
        e = e.select("label", F.col("j").cast("int").alias("j"), r6("v").alias("value"))
        return reliable(e.groupBy("label", "j", "value").agg(F.count(F.lit(1)).alias("n")))


def q_src_rejects(spark, sf):
    """Rows and rejects of every layout: each line as it is, blank, cut to one field and with a field too many."""
    layouts = [("ratings", V.ratings_line, TX.TAB, TX.check_ratings, {}),
               ("titles", V.titles_line, TX.PIPE, TX.check_titles, {}),
               ("pages", V.page_line, TX.TAB, TX.check_pages, {"numbers": 4}),
               ("numeric", V.multi_line, TX.COMMA, TX.check_numeric, {"numbers": 64}),
               ("hourly", V.hourly_line, TX.COMMA, TX.check_hourly, {})]
    out = None
    for name, view, sep, check, args in layouts:
        v = F.col("value")
        forms = F.array(v, F.lit(" "), F.substring_index(v, sep, 1), F.concat(v, F.lit(f"{sep}1")))
        checked = check(view(spark, sf).select(F.explode(forms).alias("value")), **args)
        n = (checked.groupBy(F.coalesce("reason", F.lit("row")).alias("reason"))
             .agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("layout"), "reason", "n"))
        out = n if out is None else out.unionByName(n)
    return out


def q_src_drop_header(spark, sf):
    return TX.drop_header(V.page_files(spark, sf), "file", "line").select("file", "value")


def q_sink_report(spark, sf):
    """Every unlabelled page with its predicted class, as one report line each."""
    prep_, m = P.page_naive_bayes(spark, sf, NB_LAMBDA)
    s = m.transform(prep_.score)
    cls = D.page_class(F.col("prediction").cast("int"))
    return s.select("doc_id", F.concat(F.lit("url: "), F.col("url"), F.lit(" ==> "), cls)
                    .alias("line"))


# ---- projections / parsing -------------------------------------------------------

def q_prep_split_take(spark, sf):
    f = prep.take_fields(prep.split_fields("value", "\t"), 3)
    return V.ratings_line(spark, sf).select(f.getItem(0).alias("f0"), f.getItem(1).alias("f1"),
                                            f.getItem(2).alias("f2"), F.size(f).alias("n"))


def _page_fields(spark, sf):
    return V.page_line(spark, sf).select(prep.strip_quotes_all(
        prep.split_fields("value", "\t")).alias("f"))


def q_prep_strip_quotes(spark, sf):
    f = F.col("f")
    return _page_fields(spark, sf).select(*[f.getItem(i).alias(f"c{i}") for i in range(9)])


def q_prep_missing_to_zero(spark, sf):
    f = F.col("f")
    return _page_fields(spark, sf).select(f.getItem(1).cast("bigint").alias("doc_id"),
                                          prep.missing_to_zero(f.getItem(6)).alias("value"))


def q_prep_clamp_nonneg(spark, sf):
    pt = V.page_train(spark, sf)
    return pt.select("doc_id", "f1", prep.clamp_nonneg("f1").alias("f1_clamped"))


def q_prep_field_slice(spark, sf):
    f = F.col("f")
    s = prep.field_slice(f, 4, until_from_end=1)
    one = prep.field_slice(f, 2, until=3)
    return _page_fields(spark, sf).select(f.getItem(1).cast("bigint").alias("doc_id"),
                                          F.size(s).alias("n"), s.getItem(0).alias("first"),
                                          F.size(one).alias("n_inner"), one.getItem(0).alias("inner"))


def q_prep_label_last(spark, sf):
    f = F.col("f")
    return _page_fields(spark, sf).select(f.getItem(1).cast("bigint").alias("doc_id"),
                                          prep.label_last(f).alias("label"))


def q_prep_label_zero_based(spark, sf):
    f = prep.split_fields("value", ",")
    return V.multi_line(spark, sf).select(
        "vec_id", prep.label_zero_based(f).alias("label"),
        F.size(prep.all_but_last(f)).alias("n_features"))


def q_prep_project_field(spark, sf):
    return V.ratings(spark, sf).select("user_id")


def q_feat_concat(spark, sf):
    prep_ = P.binary(spark, sf, scale=False)
    return _explode_vec(prep_.frame, prep_.key)


def q_feat_parse_all_double(spark, sf):
    f = prep.parse_all_double(prep.split_fields("value", ","))
    e = V.multi_line(spark, sf).select("vec_id", F.posexplode_outer(f).alias("j", "v"))
    return e.select("vec_id", F.col("j").cast("int").alias("j"), r6("v").alias("value"))


# ---- lookups -----------------------------------------------------------------------

def q_join_category_index(spark, sf):
    idx = FT.fit_category_index(V.page_train(spark, sf), "category")
    return idx.lookup(V.page_score(spark, sf), "category", on_unknown="zero") \
        .select("doc_id", "category", "cat_idx")


def q_join_title(spark, sf):
    return with_titles(V.ratings(spark, sf), V.titles(spark, sf)).select("user_id", "item_id", "title")


# ---- aggregates --------------------------------------------------------------------

def q_agg_row_count(spark, sf):
    parts = [("ratings", V.ratings), ("titles", V.titles), ("page_train", V.page_train),
             ("page_score", V.page_score), ("binary_big", V.binary_big), ("multi", V.multi),
             ("hourly", V.hourly)]
    out = None
    for name, fn in parts:
        c = fn(spark, sf).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("view"), "n")
        out = c if out is None else out.unionByName(c)
    return out


def q_agg_rating_stats(spark, sf):
    return rating_stats(V.ratings(spark, sf))


def q_agg_split_counts(spark, sf):
    key = V.binary_key()
    return SP.split_counts(SP.assign_split(V.binary_big(spark, sf), key))


def q_feat_category_dict(spark, sf):
    return FT.fit_category_index(V.binary_big(spark, sf), "category").table


def _scaler_frame(spark, sf, nb):
    prep_ = P.binary(spark, sf, nb=nb)
    return prep_.features.scaler.stats_frame(spark)


def q_feat_scaler_fit_center(spark, sf):
    s = _scaler_frame(spark, sf, nb=False)
    return s.select("j", r6("mean").alias("mean"), r6("std").alias("std"))


def q_feat_scaler_fit_std(spark, sf):
    s = _scaler_frame(spark, sf, nb=True)
    return s.select("j", r6("std").alias("std"))


# ---- feature transforms ----------------------------------------------------------------

def q_feat_one_hot(spark, sf):
    pt = V.page_train(spark, sf)
    idx = FT.fit_category_index(pt, "category")
    j = idx.lookup(pt, "category").withColumn("features", idx.one_hot("cat_idx"))
    return _explode_vec(j, ["doc_id"])


def _page_slots(prep_, rows):
    """Fitted page features slot by slot, as the dense form would hold them."""
    return prep_.features.long(getattr(prep_, rows), "doc_id").select("doc_id", "j", r6("value").alias("value"))


def q_feat_standardize(spark, sf):
    return _page_slots(P.pages(spark, sf, nb=False), "frame")


def q_feat_scale_only(spark, sf):
    return _page_slots(P.pages(spark, sf, nb=True), "frame")


def q_feat_page_pipeline(spark, sf):
    return _page_slots(P.pages(spark, sf, nb=False), "score")


# ---- splits ---------------------------------------------------------------------------

def q_split_80_10_10(spark, sf):
    return SP.assign_split(V.binary_big(spark, sf), V.binary_key()).select(
        *V.BINARY_KEY, "split")


def q_split_sample_10(spark, sf):
    return SP.sample_fraction(V.multi(spark, sf), F.col("vec_id"), 0.1).select("vec_id", "label")


def q_split_minibatch(spark, sf):
    prep_ = P.binary(spark, sf, scale=False)
    train = prep_.part("train")
    aggs = [F.count_if(SP.minibatch_flag("u", t, 0.5)).alias(f"n{t}") for t in range(1, 6)]
    row = train.agg(*aggs)
    e = row.select(F.posexplode(F.array(*[f"n{t}" for t in range(1, 6)])).alias("j", "n"))
    return e.select((F.col("j") + 1).cast("int").alias("step"), F.col("n").cast("bigint").alias("n"))


def q_set_union_all(spark, sf):
    # both parts are filters over one written copy: the join below them runs once
    bb = reliable(V.binary_big(spark, sf).select(*V.BINARY_KEY, "label"))
    tr, va, _ = SP.split_frames(bb, V.binary_key())
    return SP.union_all(tr, va)


def q_set_distinct(spark, sf):
    return V.ratings(spark, sf).select("item_id").distinct()


# ---- decoders (hourly) ------------------------------------------------------------------

def q_decode_page_class(spark, sf):
    return V.page_train(spark, sf).select("doc_id", "label", D.page_class("label").alias("class"))


def _hs():
    return F.date_format("h", "yyyy-MM-dd HH:mm:ss").alias("h")


def q_decode_season(spark, sf):
    return V.hourly(spark, sf).select(_hs(), "season", D.season("season").alias("season_name"))


def q_decode_calendar(spark, sf):
    h = V.hourly(spark, sf)
    return h.select(_hs(), "mnth", "hr", D.holiday("holiday").alias("holiday_name"),
                    D.weekday("weekday").alias("weekday_name"),
                    D.workingday("workingday").alias("workingday_name"))


def q_decode_weather(spark, sf):
    return V.hourly(spark, sf).select(_hs(), "weathersit",
                                      D.weather("weathersit").alias("weather_name"))


def q_decode_denormalize(spark, sf):
    h = V.hourly(spark, sf)
    return h.select(_hs(), D.denormalize("temp", D.TEMP_SCALE).alias("temp_c"),
                    D.denormalize("atemp", D.FEELS_SCALE).alias("feels_c"),
                    D.denormalize("hum", D.HUMIDITY_SCALE).alias("humidity"),
                    D.denormalize("windspeed", D.WIND_SCALE).alias("wind"))


def q_fmt_description(spark, sf):
    h = V.hourly(spark, sf)
    return h.select(_hs(), D.hourly_description(*V.HOURLY_FEATURES).alias("description"))


# ---- metrics on the naive Bayes predictions -------------------------------------------------

def _nb_scored(spark, sf):
    prep_ = P.binary(spark, sf, nb=True)
    m = bayes.fit_naive_bayes(prep_.part("train"), prep_.dim, NB_LAMBDA)
    return prep_, m.transform(prep_.frame)


def q_eval_auc_hard(spark, sf):
    _, s = _nb_scored(spark, sf)
    return evaluate.auc_hard_by(s, "split").select("split", "n", r6("auc_hard").alias("auc_hard"))


def q_eval_accuracy(spark, sf):
    _, s = _nb_scored(spark, sf)
    return evaluate.accuracy_by(s, "split").select("split", "n", r6("accuracy").alias("accuracy"))


def q_eval_correct_flag(spark, sf):
    prep_, s = _nb_scored(spark, sf)
    return s.select(*prep_.key, "split", evaluate.correct_flag().alias("result"))


def q_limit_take_n(spark, sf):
    return V.page_train(spark, sf).orderBy("doc_id").limit(20).select("doc_id", "url", "label")


def q_limit_first(spark, sf):
    bb = V.binary_big(spark, sf)
    return bb.orderBy(*bb.columns).limit(1)


def q_topk_per_key(spark, sf):
    r = V.ratings(spark, sf)
    return top_k_per_key(r, ["user_id"], [F.desc("rating"), F.asc("item_id")], 10) \
        .select("user_id", "rank", "item_id", "rating")


PREP_QUERIES = {k[2:]: v for k, v in globals().items() if k.startswith("q_")}
