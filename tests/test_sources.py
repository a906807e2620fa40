import os

import pytest

from orchard.sources import text as TX


def _write(path, lines):
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")


def test_ratings_and_titles(spark, tmpdir_fresh):
    p = os.path.join(tmpdir_fresh, "ratings.tsv")
    _write(p, ["1\t10\t4\t999", "2\t11\t5\t998"])
    r = TX.read_ratings(spark, p).orderBy("user_id").collect()
    assert [(x.user_id, x.item_id, x.rating) for x in r] == [(1, 10, 4.0), (2, 11, 5.0)]
    q = os.path.join(tmpdir_fresh, "titles.txt")
    _write(q, ["10|Toy Story|1995", "11|Heat|1995"])
    t = TX.read_titles(spark, q).orderBy("item_id").collect()
    assert [x.title for x in t] == ["Toy Story", "Heat"]


def test_pages_header_per_file_and_quotes(spark, tmpdir_fresh):
    d = os.path.join(tmpdir_fresh, "pages")
    os.makedirs(d)
    header = "url\tid\tx\tcategory\tf0\tf1\tlabel"
    _write(os.path.join(d, "a.tsv"), [header, '"u1"\t"1"\t"x"\t"news"\t"?"\t"2"\t"1"'])
    _write(os.path.join(d, "b.tsv"), [header, '"u2"\t"2"\t"x"\t"sport"\t"-1"\t"3"\t"0"'])
    rows = TX.read_pages(spark, d).orderBy("url").collect()
    assert len(rows) == 2                                  # both headers gone
    assert rows[0].category == "news" and rows[0].numeric == [0.0, 2.0] and rows[0].label == 1
    assert rows[1].numeric == [-1.0, 3.0] and rows[1].label == 0
    s = TX.read_pages(spark, d, labelled=False).orderBy("url").first()
    assert s.numeric == [0.0, 2.0, 1.0]


def test_quoted_tab_splits_with_quoting_off(spark, tmpdir_fresh):
    d = os.path.join(tmpdir_fresh, "q")
    os.makedirs(d)
    _write(os.path.join(d, "a.tsv"), ["h1\th2\th3", '"a\tb"\t"c"'])
    lines = TX.read_delimited_with_header(spark, d, "\t").collect()
    # the tab inside quotes splits the field, as in the reference's raw split
    assert lines[0].value == '"a\tb"\t"c"'
    assert len(lines[0].value.split("\t")) == 3


def test_numeric_and_hourly(spark, tmpdir_fresh):
    p = os.path.join(tmpdir_fresh, "land.csv")
    _write(p, ["1.0,2.0,3", "4.0,5.0,7"])
    r = TX.read_numeric(spark, p).orderBy("label").collect()
    assert r[0].features == [1.0, 2.0] and r[0].label == 2.0 and r[1].label == 6.0
    h = os.path.join(tmpdir_fresh, "hour")
    os.makedirs(h)
    head = ",".join(f"c{i}" for i in range(17))
    _write(os.path.join(h, "a.csv"), [head, "1,2024-01-01,1,0,1,5,0,1,1,2,0.5,0.4,0.6,0.1,3,4,7"])
    _write(os.path.join(h, "b.csv"), [head, "2,2024-01-01,1,0,1,6,0,1,1,2,0.5,0.4,0.6,0.1,3,4,9"])
    rows = TX.read_hourly(spark, h).orderBy("label").collect()
    assert len(rows) == 2 and rows[0].label == 7 and len(rows[0].features) == 11
    assert rows[0].features[:3] == [1.0, 1.0, 5.0]


def test_long_short_null_and_header_like_lines(spark, tmpdir_fresh):
    d = os.path.join(tmpdir_fresh, "odd")
    os.makedirs(d)
    header = "url\tid\tx\tcategory\tf0\tlabel"
    _write(os.path.join(d, "a.tsv"), [header, "u1\t1\tx\tc\t4\t1", "u2\t2\tx\tc\t5\t6\t0", "short\tline", header.replace("label", "0").replace("f0", "9")])
    _write(os.path.join(d, "b.tsv"), ["another header of this file", "u3\t3\tx\tc\t7\t1"])
    rows = {r.url: r for r in TX.read_pages(spark, d).collect()}
    # a row longer than its header keeps its own last field as the label
    assert rows["u2"].numeric == [5.0, 6.0] and rows["u2"].label == 0
    assert rows["u1"].numeric == [4.0] and rows["u3"].label == 1 and rows["url"].numeric == [9.0]
    assert [r.value for r in TX.read_page_rejects(spark, d).collect()] == ["short\tline"]
    lines = spark.createDataFrame([("u\t1\tx\tc\t4\t1",), ("a",), (None,), ("",)], "value string")
    for mode in ("strict", "permissive"):
        assert TX.parse_pages(lines, mode=mode).count() == 1
    assert TX.reject_short_pages(lines).count() == 3


def test_drop_header_takes_the_first_line_of_each_file_only(spark):
    rows = [("a", 1, "head"), ("a", 2, "x"), ("a", 3, "head"), ("b", 5, "other"), ("b", 6, None), (None, 1, "h"), (None, 2, "y")]
    got = TX.drop_header(spark.createDataFrame(rows, "file string, line int, value string"), "file", "line")
    assert sorted((r.file or "", r.line) for r in got.collect()) == [("", 2), ("a", 2), ("a", 3), ("b", 6)]


LAYOUTS = {
    "ratings": (TX.check_ratings, "1\t10\t4", ["\t", "1\t10"], {}),
    "titles": (TX.check_titles, "10|Heat", ["10"], {}),
    "pages": (TX.check_pages, "u\t1\tx\tc\t4\t?\t1", ["u\t1\tx\tc\t4", "a"], {"numbers": 2}),
    "numeric": (TX.check_numeric, "1,2,3", ["1"], {"numbers": 2}),
    "hourly": (TX.check_hourly, "1,2024-01-01,1,0,1,5,0,1,1,2,0.5,0.4,0.6,0.1,3,4,7", ["1,2,3", "x"], {}),
}


@pytest.mark.parametrize("name", LAYOUTS)
@pytest.mark.parametrize("mode", ["strict", "permissive"])
def test_every_layout_rejects_blank_short_and_ragged_lines(spark, name, mode):
    check, good, short, args = LAYOUTS[name]
    sep = "|" if name == "titles" else "," if "," in good else "\t"
    longer = good + sep + "1"
    lines = spark.createDataFrame([(x,) for x in [good, None, "", "  ", *short, longer, good]], "value string")
    rows, rejects, counts = TX.split_rejects(check(lines, mode=mode, **args))
    ragged = name in ("pages", "numeric", "hourly")
    # a line of separators alone is as short or as blank as it looks
    blank = 3 + sum(not s.strip() for s in short)
    assert rows.count() == 3 - ragged and counts["lines"] == 6 + len(short)
    assert (counts["blank"], counts["short"], counts["ragged"]) == (blank, len(short) - blank + 3, int(ragged))
    why = [(r.value, r.reason) for r in rejects.collect()]
    assert len(why) == counts["lines"] - rows.count()
    assert {v for v, r in why if r == "ragged"} == ({longer} if ragged else set())


def test_malformed_numbers_of_rejects_do_not_fail_a_strict_job(spark):
    lines = spark.createDataFrame([("x,y,z",), ("1,2,3",)], "value string")
    assert TX.accepted(TX.check_numeric(lines, numbers=5)).count() == 0
    assert TX.parse_numeric(lines, mode="permissive").count() == 2
    with pytest.raises(Exception):
        TX.parse_numeric(lines).collect()


def test_headers_of_files_that_are_read_in_splits(spark, tmpdir_fresh):
    d = os.path.join(tmpdir_fresh, "split")
    os.makedirs(d)
    for k in range(3):
        _write(os.path.join(d, f"{k}.tsv"), ["url\tid\tx\tcategory\tf0\tlabel",
                                             *[f"u{k}-{i}\t{i}\tx\tc\t{i}\t1" for i in range(400)]])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        lines = TX.read_delimited_with_header(spark, d, "\t")
        assert lines.rdd.getNumPartitions() > 6
        assert TX.read_pages(spark, d).count() == 1200
        places = lines.select("value", "_metadata.file_path", "_metadata.file_block_start")
        assert places.groupBy("file_path").agg({"file_block_start": "max"}).count() == 3
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
