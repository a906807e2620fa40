"""Line deduplication by a deletion-neighbourhood join, in DataFrame functions alone.

Lines are compared trimmed and lower-cased.  A line goes when an earlier line of the
corpus (smaller doc_id, then smaller line number) equals it or lies within one edit
of it: one character replaced, added or left out.  Blank lines are never touched, and
lines shorter than ``min_chars`` have no neighbours at one edit: only their exact
repeats go, down to ``min_exact`` characters.  The query op6_line_dedup leaves lines
under ``MIN_CHARS`` alone, as its SQL does.

Two lines within one edit meet in equal deletion variants: both without the
character that differs, or one without the character that the other lacks.  The
variants of a line of n characters are n + 1, so they are emitted only where a
partner can be, in two steps that lose none.  An edit leaves the first or the
last part of a line as it is, so only lines that share such an end with a
different line are looked at further.  These are cut into segments; one edit
leaves everything outside of one segment (its context) as it is, and lines that
share a context with a different line emit the variants of that segment.
Variants are joined by hash, the earliest line of each is found by an aggregate
(no pairs are made), and its edit distance is verified.  Keys shared by many
lines are combined before each shuffle.

Defined results: a null text has no lines and stays null; an empty text has one
empty line, which stays; rows equal in id and text are one document, so neither
loses a line to the other; rows with a null id come last in the order; rows that
share an id but not the text are ordered by the hash of both; an empty table
gives no rows; extra columns are kept as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orchard.llm.common import cut, restrict, table, written

MIN_CHARS = 20
SEGMENT = 128       # characters; a line has two segments at least


def _row_key(id_col: str, text_col: str) -> Column:
    return F.xxhash64(F.col(id_col).cast("long"), F.col(text_col).cast("string"))


def _lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """``k, id, line, form, n`` of every line that takes part; (id, k, line) orders the corpus."""
    rows = docs.select(_row_key(id_col, text_col).alias("k"),
                       F.coalesce(F.col(id_col).cast("long"), F.lit((1 << 63) - 1)).alias("id"),
                       F.posexplode(F.split(F.col(text_col).cast("string"), "\n", -1)).alias("line", "raw"))
    return (rows.select("k", "id", "line", F.lower(F.trim("raw")).alias("form"))
            .withColumn("n", F.char_length("form")).where(F.col("n") >= min_chars))


def _end(n: Column) -> Column:
    """Characters of an end: at most (n - 1) / 2, so that an edit misses one of the two."""
    half = F.floor((n - 1) / 2)
    return F.when(half >= 16, half - half % 16).when(half >= 8, 8).otherwise(F.least(half, F.lit(1))).cast("int")


def _ends(lines: DataFrame, min_chars: int) -> DataFrame:
    """Line rows with hash ``h`` and ``ends``, the hashes of what they may share with a
    neighbour of the same length, or of one character less or more (none below ``min_chars``)."""
    here, less = _end(F.col("n")), _end(F.col("n") - 1)

    def both(size: Column) -> list[Column]:
        return [F.xxhash64(size, F.lit(0), F.substring("form", F.lit(1), size)),
                F.xxhash64(size, F.lit(1), F.substring("form", F.col("n") - size + 1, size))]

    ends = F.when(F.col("n") < min_chars, F.array().cast("array<bigint>")).when(here == less, F.array(*both(here))).otherwise(F.array(*both(here), *both(less)))
    return lines.select("k", "id", "line", F.xxhash64("form").alias("h"), ends.alias("ends"))


def _contexts(lines: DataFrame, *keep: str) -> DataFrame:
    """One row per line, length of the shorter line of a pair (n or n - 1) and segment:
    ``ctx`` hashes everything outside the segment, ``seg`` is the segment itself."""
    rows = lines.select(*keep, "form", "n", F.explode(F.array(F.col("n"), F.col("n") - 1)).alias("least"))
    count = F.greatest(F.lit(2), F.ceil(F.col("least") / SEGMENT).cast("int"))
    width = F.ceil(F.col("least") / count).cast("int")
    rows = rows.withColumn("width", width).withColumn(
        "j", F.explode(F.sequence(F.lit(0), F.ceil(F.col("least") / F.col("width")).cast("int") - 1)))
    start = F.col("j") * F.col("width")
    after = F.greatest(F.lit(0), F.col("least") - start - F.col("width"))   # characters behind it
    rows = rows.withColumn("start", start).withColumn("after", after)
    head = F.substring("form", F.lit(1), F.col("start"))
    tail = F.substring("form", F.col("n") - F.col("after") + 1, F.col("after"))
    seg = F.substring("form", F.col("start") + 1, F.col("n") - F.col("after") - F.col("start"))
    return rows.select(*keep, "n", "least", "form", F.xxhash64("least", "j", head, tail).alias("ctx"),
                       seg.alias("seg"))


def _variants(contexts: DataFrame) -> DataFrame:
    """``v, kind, pos, h``: hashed deletion variants of the segments.

    Equal lengths: the segment without its i-th character, with i.  Lengths that
    differ by one: the shorter line's segment as it is (short), the longer one's
    without one character.
    """
    c = contexts.withColumn("i", F.explode(F.sequence(F.lit(0), F.char_length("seg"))))
    less = F.concat(F.substring("seg", F.lit(1), F.col("i") - 1),
                    F.substring("seg", F.col("i") + 1, F.char_length("seg")))
    longer = F.col("n") > F.col("least")
    v = (F.when((F.col("i") == 0) & ~longer, F.xxhash64("ctx", F.lit(-1), "seg"))
         .when((F.col("i") > 0) & ~longer, F.xxhash64("ctx", "i", less))
         .when((F.col("i") > 0) & longer, F.xxhash64("ctx", F.lit(-1), less)))
    kind = F.when(F.col("i") == 0, _SHORT).when(longer, _LONG).otherwise(_SAME)
    return c.select(v.alias("v"), kind.alias("kind"), "pos", "h").where("v is not null")


_SAME, _SHORT, _LONG = 0, 1, 2


def _different(rows: DataFrame, key: str) -> DataFrame:
    """Keys that at least two different lines have."""
    return (rows.groupBy(key).agg(F.min("h").alias("a"), F.max("h").alias("b"))
            .where("a <> b").select(key))


def near_lines(docs: DataFrame, lines: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """``h`` of the distinct lines that have an earlier one at exactly one edit;
    ``lines`` are the rows of ``_ends``."""
    ends = lines.select("h", F.explode("ends").alias("e"))
    hopeful = restrict(ends, cut(_different(ends, "e")), "e").select("h").distinct()
    first = cut(lines.join(hopeful, "h").groupBy("h")
                .agg(F.min(F.struct("id", "k", "line")).alias("pos")))
    some = docs.withColumn("k", _row_key(id_col, text_col))
    some = restrict(some, cut(first.select("pos.k").distinct()), "k").drop("k")
    at = first.select("h", "pos", F.col("pos.k").alias("k"), F.col("pos.line").alias("line"))
    forms = cut(_lines(some, id_col, text_col, min_chars).join(at, ["k", "line"])
                .select("h", "pos", "form", "n").dropDuplicates(["h"]))
    contexts = _contexts(forms, "h", "pos")
    variants = cut(_variants(restrict(contexts, cut(_different(contexts, "ctx")), "ctx")).distinct())
    earliest = variants.groupBy("v", "kind").agg(F.min(F.struct("pos", "h")).alias("first"))
    # lines of one length meet each other; a longer line meets the shorter one and the reverse
    partner = F.when(F.col("kind") == _SHORT, _LONG).when(F.col("kind") == _LONG, _SHORT).otherwise(_SAME)
    met = (variants.withColumn("kind", partner).join(earliest, ["v", "kind"])
           .where(F.col("first.pos") < F.col("pos"))
           .select("h", F.col("first.h").alias("to")).distinct())
    text = forms.select("h", "form")
    return (met.join(text, "h").join(text.toDF("to", "other"), "to")
            .where(F.levenshtein("form", "other", 1).between(0, 1)).select("h").distinct())


def line_decisions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   min_chars: int = MIN_CHARS, min_exact: int = 1) -> DataFrame:
    """``k, exact, near``: line numbers that go from each document (by row key)."""
    with written(_ends(_lines(docs, id_col, text_col, max(min_exact, 1)), min_chars)) as lines:
        near = cut(near_lines(docs, lines, id_col, text_col, min_chars))
        pos = F.struct("id", "k", "line")
        again = lines.groupBy("h").agg(F.min(pos).alias("first"), F.max(pos).alias("last"))
        # lines met once and without an earlier neighbour are out of the way before the join
        listed = cut(again.join(near.withColumn("near", F.lit(True)), "h", "left").where(
            "first <> last or near").select("h", "first", F.coalesce("near", F.lit(False)).alias("near")))
        exact = pos > F.col("first")
        gone = lines.select("h", "k", "id", "line").join(listed, "h").where(exact | F.col("near"))
        return cut(gone.groupBy("k").agg(F.collect_set(F.when(exact, F.col("line"))).alias("exact"),
                                         F.collect_set(F.when(~exact, F.col("line"))).alias("near")))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_chars: int = MIN_CHARS, min_exact: int = 1, counts_col: str = "lines") -> DataFrame:
    """``docs`` with the repeated lines taken out of ``text``, plus struct ``counts_col`` (last) with
    the numbers of lines (n), of exact (exact) and of near (near) repeats removed.
    ``docs`` may have any further columns but one of that name."""
    if counts_col in docs.columns:
        raise ValueError(f"there is a column {counts_col!r} already: name another counts_col")
    plain = docs.select(F.col(id_col), F.col(text_col))
    found = line_decisions(plain, id_col, text_col, min_chars, min_exact)
    # the caller's columns travel in a struct, so that their names cannot clash
    keyed = docs.select(_row_key(id_col, text_col).alias("k"), F.struct("*").alias("row"),
                        F.split(F.col(text_col).cast("string"), "\n", -1).alias("all"))
    keys = found.select("k")
    some = restrict(keyed, keys, "k").join(found, "k")
    stay = F.array_except(F.sequence(F.lit(0), F.size("all") - 1), F.concat("exact", "near"))
    text = F.array_join(F.transform(F.array_sort(stay), lambda i: F.col("all")[i]), "\n")

    def columns(text_now: Column) -> list[Column]:
        return [text_now.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns]

    zero = F.lit(0).cast("long")
    size = F.coalesce(F.size("all").cast("long"), zero)
    counts = F.struct(size.alias("n"), F.size("exact").cast("long").alias("exact"),
                      F.size("near").cast("long").alias("near")).alias(counts_col)
    none = F.struct(size.alias("n"), zero.alias("exact"), zero.alias("near")).alias(counts_col)
    rest = restrict(keyed, keys, "k", "left_anti")
    return some.select(*columns(text), counts).unionByName(rest.select(*columns(F.col("row")[text_col]), none))


def keep_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kwargs) -> DataFrame:
    """``docs`` with repeated lines taken out; documents that lose all of their lines go."""
    name = "lines"
    while name in docs.columns:
        name += "_"
    cleaned = dedup_lines(docs, id_col, text_col, counts_col=name, **kwargs)
    lost = F.col(name)["exact"] + F.col(name)["near"]
    return cleaned.where((lost == 0) | (lost < F.col(name)["n"])).drop(name)


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs, min_exact=MIN_CHARS).select(
        "doc_id", F.col("lines.n").alias("n_lines"), F.col("lines.exact").alias("n_exact"),
        F.col("lines.near").alias("n_near"), F.sha2("text", 256).alias("text_sha256"))


# The SQL finds neighbours by halves (one edit leaves the first or the second half as it is)
# and tries every place of the edit; its own levenshtein() counts bytes.
OP6_SQL = f"""
WITH parts AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents),
raw AS (SELECT doc_id, unnest(range(len(l))) AS line, unnest(l) AS txt FROM parts),
form AS (SELECT doc_id, line, txt, lower(trim(txt, ' ')) AS f FROM raw),
first AS (SELECT f, min((doc_id, line)) AS pos FROM form WHERE length(f) >= {MIN_CHARS} GROUP BY f),
half AS (SELECT f, pos, n, 0 AS side, left(f, n // 2) AS part
         FROM (SELECT f, pos, unnest([length(f), length(f) - 1]) AS n FROM first)
         UNION ALL
         SELECT f, pos, n, 1, right(f, n - n // 2)
         FROM (SELECT f, pos, unnest([length(f), length(f) - 1]) AS n FROM first)),
near AS (SELECT DISTINCT b.f FROM half a JOIN half b
         ON a.n = b.n AND a.side = b.side AND a.part = b.part AND a.pos < b.pos AND a.f <> b.f
         WHERE abs(length(a.f) - length(b.f)) <= 1 AND len(list_filter(
             range(1, greatest(length(a.f), length(b.f)) + 1),
             lambda i: left(a.f, i - 1) = left(b.f, i - 1)
                 AND (substr(a.f, i + 1) = substr(b.f, i + 1) OR substr(a.f, i) = substr(b.f, i + 1)
                      OR substr(a.f, i + 1) = substr(b.f, i)))) > 0),
judged AS (SELECT form.doc_id, line, txt,
                  first.f IS NOT NULL AND (form.doc_id, line) > first.pos AS again,
                  near.f IS NOT NULL AS close
           FROM form LEFT JOIN first USING (f) LEFT JOIN near USING (f))
SELECT doc_id, count(*)::BIGINT AS n_lines,
       count(*) FILTER (again)::BIGINT AS n_exact,
       count(*) FILTER (close AND NOT again)::BIGINT AS n_near,
       sha256(coalesce(string_agg(txt, chr(10) ORDER BY line) FILTER (NOT (again OR close)), '')) AS text_sha256
FROM judged GROUP BY doc_id
"""

QUERIES = {"op6_line_dedup": op6_line_dedup}
ORACLE = {"op6_line_dedup": OP6_SQL}
