"""Delimited text readers (S1-S7).  Positional layouts become explicit columns.

File readers keep every line whole (each file's first line is dropped where the
layout has a header) and the ``parse_*`` functions split it once, so a row keeps
all of its own fields however many the header has.  The same functions take a
DataFrame of lines (column ``value``), which is how lines that are already in a
table are handled.

Every layout is checked before it is parsed (``check_*``): blank lines, lines too
short for the layout and lines with another number of values than the rows are to
have get a reason instead of a row, in strict and in permissive mode.
``parse_*`` gives the rows alone; ``split_rejects`` gives rows, rejects and counts from
one scan.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from orchard.functions import prep
from orchard.operators.common import reliable

TAB, PIPE, COMMA = "\t", "|", ","
NO_DELIMITER = "\uffff"       # a code point that is never a character


# Why a line is not a row: nothing in it, too few fields for its layout, or another number
# of values than the caller says all rows have.
BLANK, SHORT, RAGGED = "blank", "short", "ragged"
REASONS = (BLANK, SHORT, RAGGED)


def _cast(c, t, mode):
    return c.try_cast(t) if mode == "permissive" else c.cast(t)


def _check(lines: DataFrame, col: str, sep: str, least: int, columns: Sequence[Column], keep: Sequence = (),
           values: Column | None = None, numbers: int | None = None) -> DataFrame:
    """``lines`` with ``reason`` (NULL for a row) and ``row``, the parsed columns (NULL for a reject).

    Values of rejects are never converted, so a reject cannot fail a strict job.
    """
    width = F.size(prep.split_fields(col, sep))
    reason = F.when(F.col(col).isNull() | F.col(col).rlike(r"^\s*$"), BLANK).when(width < least, SHORT)
    if numbers is not None:
        reason = reason.when(values != numbers, RAGGED)
    row = F.struct(*[F.col(k) if isinstance(k, str) else k for k in keep], *columns)
    return lines.select("*", reason.alias("reason")).withColumn("row", F.when(F.col("reason").isNull(), row))


def accepted(checked: DataFrame) -> DataFrame:
    """The parsed rows of a ``check_*`` frame."""
    return checked.where(F.col("reason").isNull()).select("row.*")


def rejected(checked: DataFrame) -> DataFrame:
    """The lines that are not rows, with the reason."""
    return checked.where(F.col("reason").isNotNull()).drop("row")


def split_rejects(checked: DataFrame) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """(rows, rejects, counts) from one scan of the lines: the checked frame is written once, and
    the number of lines and of each reason is observed on the way."""
    seen = Observation()
    counts = [F.count_if(F.col("reason").eqNullSafe(r)).alias(r) for r in REASONS]
    kept = reliable(checked.observe(seen, F.count(F.lit(1)).alias("lines"), *counts))
    return accepted(kept), rejected(kept), dict(seen.get)


def usual_numbers(rows: DataFrame, col: str) -> int:
    """How many values most rows have in the array ``col`` (of equal counts the larger number);
    0 without rows.  Rows with another number are ragged."""
    sizes = rows.groupBy(F.size(col).alias("size")).agg(F.count(F.lit(1)).alias("n"))
    top = sizes.orderBy(F.desc("n"), F.desc("size")).first()
    return int(top["size"]) if top else 0


def check_ratings(lines: DataFrame, col: str = "value", mode: str = "strict") -> DataFrame:
    f = prep.take_fields(prep.split_fields(col, TAB), 3)
    return _check(lines, col, TAB, 3, [_cast(f.getItem(0), "int", mode).alias("user_id"),
                                       _cast(f.getItem(1), "int", mode).alias("item_id"),
                                       _cast(f.getItem(2), "double", mode).alias("rating")])


def parse_ratings(lines: DataFrame, col: str = "value", mode: str = "strict") -> DataFrame:
    """``user<TAB>item<TAB>rating[<TAB>...]`` -> (user_id int, item_id int, rating double).

    ``mode='strict'`` fails on a malformed number; ``'permissive'`` gives NULL.
    """
    return accepted(check_ratings(lines, col, mode))


def check_titles(lines: DataFrame, col: str = "value", mode: str = "strict") -> DataFrame:
    f = prep.take_fields(prep.split_fields(col, PIPE), 2)
    return _check(lines, col, PIPE, 2, [_cast(f.getItem(0), "int", mode).alias("item_id"), f.getItem(1).alias("title")])


def parse_titles(lines: DataFrame, col: str = "value", mode: str = "strict") -> DataFrame:
    """``id|title|...`` -> (item_id int, title string)."""
    return accepted(check_titles(lines, col, mode))


def check_pages(lines: DataFrame, labelled: bool = True, col: str = "value", keep: tuple = (), mode: str = "strict",
                numbers: int | None = None) -> DataFrame:
    f = prep.strip_quotes_all(prep.split_fields(col, TAB))
    until = 1 if labelled else 0
    raw = prep.field_slice(f, 4, until_from_end=until)
    cols = [f.getItem(0).alias("url"), f.getItem(3).alias("category"),
            prep.missing_to_zero_all(raw, mode=mode).alias("numeric")]
    if labelled:
        cols.append(_cast(F.element_at(f, -1), "int", mode).alias("label"))
    # four leading fields, one number at least and the label
    return _check(lines, col, TAB, 5 + until, cols, keep, F.size(prep.split_fields(col, TAB)) - 4 - until, numbers)


def parse_pages(lines: DataFrame, labelled: bool = True, col: str = "value",
                keep: tuple = (), mode: str = "strict") -> DataFrame:
    """Page layout: 0 url, 3 category, 4.. numbers ('?' = missing), last = label.

    Output: url, category, numeric array<double>[, label int].  Quotes are
    stripped from every field.  Lines too short for the layout (and NULL lines)
    are left out in either mode; ``reject_short_pages`` lists them.
    """
    return accepted(check_pages(lines, labelled, col, keep, mode))


def reject_short_pages(lines: DataFrame, labelled: bool = True, col: str = "value") -> DataFrame:
    """Lines with fewer fields than the layout needs, NULL lines included (not parsed)."""
    return rejected(check_pages(lines, labelled, col)).drop("reason")


def check_numeric(lines: DataFrame, col: str = "value", keep: tuple = (), mode: str = "strict",
                  numbers: int | None = None) -> DataFrame:
    raw = prep.split_fields(col, COMMA)
    f = F.transform(raw, lambda x: _cast(x, "double", mode))
    return _check(lines, col, COMMA, 2, [prep.all_but_last(f).alias("features"),
                                         (F.element_at(f, -1) - F.lit(1.0)).alias("label")], keep, F.size(raw) - 1, numbers)


def parse_numeric(lines: DataFrame, col: str = "value", keep: tuple = (), mode: str = "strict") -> DataFrame:
    """All-double comma line, last field a one-based class."""
    return accepted(check_numeric(lines, col, keep, mode))


HOURLY_FIELDS, HOURLY_NUMBERS = 17, 11      # fixed values: fewest fields of a line, features of such a line


def check_hourly(lines: DataFrame, col: str = "value", keep: tuple = (), mode: str = "strict",
                 numbers: int | None = HOURLY_NUMBERS) -> DataFrame:
    f = prep.split_fields(col, COMMA)
    feats = F.concat(prep.field_slice(f, 2, until=3), prep.field_slice(f, 4, until_from_end=3))
    cols = [F.transform(feats, lambda x: _cast(x, "double", mode)).alias("features"),
            _cast(F.element_at(f, -1), "int", mode).alias("label")]
    return _check(lines, col, COMMA, HOURLY_FIELDS, cols, keep, F.size(f) - (HOURLY_FIELDS - HOURLY_NUMBERS), numbers)


def parse_hourly(lines: DataFrame, col: str = "value", keep: tuple = (), mode: str = "strict") -> DataFrame:
    """Hourly layout: features = field 2 ++ fields 4..size-3, label = last."""
    return accepted(check_hourly(lines, col, keep, mode))


def drop_header(lines: DataFrame, file: str | Sequence[str], line: str) -> DataFrame:
    """Drop each file's first line, whatever it and the other lines say.

    ``file`` names the column(s) that identify a file and ``line`` the one that
    orders its lines.  Only (file, least line) rows are combined and joined; the
    lines stay where they are unless their files are many.
    """
    by = [file] if isinstance(file, str) else list(file)
    first = lines.groupBy(*by).agg(F.min(line).alias("__first"))
    same = [lines[c].eqNullSafe(first[c]) for c in by]
    cond = lines[line] == first["__first"]
    for s in same:
        cond = cond & s
    return lines.join(first, cond, "left_anti")


# ---- file readers ------------------------------------------------------------

def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    return parse_ratings(read_lines(spark, path))


def read_titles(spark: SparkSession, path: str) -> DataFrame:
    return parse_titles(read_lines(spark, path))


def read_delimited_with_header(spark: SparkSession, path: str, sep: str) -> DataFrame:
    """Whole lines (``value``) without each file's first one; blank lines are skipped.

    The CSV source drops the header per file, also when a file is split over
    tasks.  Its delimiter is a character that text cannot hold, so that a line
    is one field; ``sep`` only has to be the layout's delimiter, not that one.
    """
    if sep == NO_DELIMITER:
        raise ValueError("U+FFFF cannot be a delimiter")
    return (spark.read.schema("value string").option("header", True).option("sep", NO_DELIMITER)
            .option("quote", "").option("escape", "").option("enforceSchema", True).csv(path))


def read_pages(spark: SparkSession, path: str, labelled: bool = True,
               mode: str = "strict") -> DataFrame:
    return parse_pages(read_delimited_with_header(spark, path, TAB), labelled, mode=mode)


def read_page_rejects(spark: SparkSession, path: str, labelled: bool = True) -> DataFrame:
    """Lines of the files that ``read_pages`` leaves out."""
    return reject_short_pages(read_delimited_with_header(spark, path, TAB), labelled)


def read_numeric(spark: SparkSession, path: str) -> DataFrame:
    return parse_numeric(read_lines(spark, path))


def read_hourly(spark: SparkSession, path: str) -> DataFrame:
    return parse_hourly(read_delimited_with_header(spark, path, COMMA))
