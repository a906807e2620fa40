"""Personal data: pattern matches and information-theoretic sanitisation, in DataFrame
functions alone.

Emails, IP addresses, card and phone numbers are found by pattern and checked
(address parts, Luhn sum, number of digits).  They are the protected entities.
Terms near them may reveal them too (Sanchez and Batet, C-sanitized): over the
units of the corpus (50 words of a line; equal units count once, so copies of a
text add nothing), the share of an entity's information that a term gives away is

    PMI(e, t) / IC(e) = log(N n(e, t) / (n(e) n(t))) / log(N / n(e)),

1 when the term never occurs without the entity.  Terms that stand in at least
``SUPPORT`` units of as many texts with an entity and give away ``GENERALISE`` or more of it become
spans of kind term in those units; in the sanitised text they are generalised to
[WORD], or removed when they give away ``REMOVE`` or more.

Positions come from the pieces between matches: lengths are summed up per text in
match order.  Only texts with matches are looked at again, and terms are counted
over the corpus for candidates alone.

Defined results: a null text is empty; texts without matches have no spans;
repeated rows get equal results; an empty table gives no rows; extra columns are
ignored; a null id is kept as null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orchard.llm.common import cut, restrict, table, texts

UNIT = 50
SUPPORT = 3
GENERALISE, REMOVE = 0.9, 0.999

# The patterns as specified.  \G and the look-behind only keep a search from
# starting inside a run that was already tried from its start, and ++ from backing up
# where nothing follows, so that long runs take linear time; matches are the same.
KINDS = ("email", "ip", "card", "phone", "term")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
WORD = r"\p{L}{3,}"


def _pieces(text: Column, pattern: str) -> Column:
    """Matches in order with the length of the text before each since the last one;
    one entry more, without a match, for the rest."""
    return F.zip_with(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
                      F.split(text, pattern, -1),
                      lambda m, p: F.struct(m.alias("match"), F.char_length(p).alias("gap")))


def _placed(rows: DataFrame, *by: str) -> DataFrame:
    """``start`` and ``end`` from the gaps and matches before, per ``by`` in order of ``i``."""
    w = Window.partitionBy(*by).orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    size = F.char_length("match")
    end = F.sum(F.col("gap").cast("long") + size).over(w)
    return rows.withColumn("end", end).withColumn("start", F.col("end") - F.char_length("match"))


def _luhn(digits: Column) -> Column:
    n = F.length(digits)
    values = F.transform(F.sequence(F.lit(1), n), lambda i: F.substring(digits, i, F.lit(1)).cast("int") * F.when(
        (n - i) % 2 == 1, 2).otherwise(1))
    return F.aggregate(values, F.lit(0), lambda a, v: a + F.when(v > 9, v - 9).otherwise(v)) % 10 == 0


def _valid(kind: Column, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    n = F.length(digits)
    # parts without leading zeros, three digits wide: compared as text
    value = F.forall(F.split(match, r"\."), lambda p: (F.length(F.regexp_replace(p, "^0+", "")) <= 3) & (
        F.lpad(F.regexp_replace(p, "^0+", ""), 3, "0") <= "255"))
    return (F.when(kind == "email", True).when(kind == "ip", value)
            .when(kind == "card", F.when(n.between(13, 19), _luhn(digits)).otherwise(False))
            .when(kind == "phone", n.between(9, 15)))


def _keyed(docs: DataFrame) -> DataFrame:
    return texts(docs).select(F.xxhash64("doc_id", "text").alias("k"), "doc_id", "text")


def base_spans(rows: DataFrame) -> DataFrame:
    """``k, kind, start, end, match`` of the valid pattern matches of ``rows(k, text)``."""
    text, none = F.col("text"), F.array().cast("array<struct<match:string,gap:int>>")
    maybe = {"email": text.contains("@"), "ip": text.rlike(r"[0-9]\.[0-9]"),
             "card": text.rlike(r"[0-9][\x20-]?[0-9]"), "phone": text.contains("+")}

    def numbered(kind: str, pattern: str) -> Column:
        pieces = F.when(maybe[kind], _pieces(text, pattern)).otherwise(none)
        return F.transform(pieces, lambda x, i: F.struct(F.lit(kind).alias("kind"), i.alias("i"),
                                                         x["match"].alias("match"), x["gap"].alias("gap")))

    found = F.concat(*[numbered(kind, pattern) for kind, pattern in PATTERNS.items()])
    each = rows.select("k", F.explode(found).alias("x")).select("k", "x.*").where("match is not null")
    placed = _placed(each.dropDuplicates(["k", "kind", "i"]), "k", "kind")
    return placed.where(_valid(F.col("kind"), F.col("match"))).select("k", "kind", "start", "end", "match")


def _units(lines: DataFrame, *keep: str) -> DataFrame:
    """Words of ``lines(text)`` with their unit ``u``, their number ``i`` and gap in the line."""
    words = lines.select(*keep, F.xxhash64("text").alias("line"), F.posexplode(_pieces(F.col("text"), WORD)).alias("i", "x"))
    return words.where("x.match is not null").select(
        *keep, "i", "x.match", "x.gap", F.lower("x.match").alias("term"),
        F.xxhash64("line", F.floor(F.col("i") / UNIT)).alias("u"))


def unit_total(lines: DataFrame) -> int:
    """Distinct units of ``lines(text)``, exactly: equal lines have equal units, so a line's
    hash and number of units are all that is shuffled."""
    size = F.ceil(F.size(F.regexp_extract_all("text", F.lit(WORD), F.lit(0))) / UNIT)
    each = lines.select(F.xxhash64("text").alias("line"), size.alias("units")).where("units > 0")
    return each.groupBy("line").agg(F.max("units").alias("units")).agg(F.sum("units")).head()[0] or 0


def term_spans(rows: DataFrame, base: DataFrame, support: int = SUPPORT,
               generalise: float = GENERALISE) -> DataFrame:
    """``k, start, end, share`` of the terms that reveal an entity of ``base`` in their unit."""
    some = restrict(rows, cut(base.select("k").distinct()), "k").dropDuplicates(["k"])
    lines = some.select("k", F.posexplode(F.split("text", "\n", -1)).alias("no", "text"))
    w = Window.partitionBy("k").orderBy("no").rowsBetween(Window.unboundedPreceding, 0)
    lines = (lines.withColumn("until", F.sum(F.char_length("text").cast("long") + 1).over(w))
             .withColumn("from", F.col("until") - F.char_length("text") - 1))
    entity = F.concat_ws(":", "kind", F.lower("match"))
    # pattern matches do not cross lines, blanks apart: the line where a match starts
    inside = (F.col("start") >= F.col("from")) & (F.col("start") < F.col("until"))
    hit = lines.join(base.select("k", "start", "end", entity.alias("e")), "k").where(inside)
    at_line = cut(hit.select("k", "no", "from", "text", F.col("start").alias("s0"), F.col("end").alias("e0"), "e"))
    words = _units(at_line.select("k", "no", "from", "text").distinct(), "k", "no", "from")
    words = _placed(words, "k", "no").withColumn("start", F.col("start") + F.col("from")).withColumn(
        "end", F.col("end") + F.col("from"))
    over = at_line.select("k", "no", "s0", "e0")
    words = cut(words.join(over, (words["k"] == over["k"]) & (words["no"] == over["no"])
                           & (words["start"] < over["e0"]) & (words["end"] > over["s0"]), "left_anti")
                .select("k", "no", "i", "u", "term", "start", "end"))
    # an entity belongs to the unit of the nearest word before it, the first one at a line's start
    near = words.groupBy("k", "no", "u").agg(F.min("start").alias("a"), F.min("i").alias("first"))
    held = cut(at_line.join(near, ["k", "no"]).where((F.col("a") <= F.col("s0")) | (F.col("first") < UNIT))
               .groupBy("k", "no", "s0", "e").agg(F.max_by("u", "a").alias("u")).select("u", "e").distinct())
    often = held.groupBy("e").agg(F.count("*").alias("ne")).where(F.col("ne") >= support)
    # units may overlap in a text that repeats itself: as many texts are asked for
    joint = cut(words.select("u", "term", "k").distinct().join(held.join(often, "e"), "u")
                .groupBy("e", "term").agg(F.countDistinct("u").alias("both"), F.first("ne").alias("ne"),
                                          F.countDistinct("k").alias("texts"))
                .where((F.col("both") >= support) & (F.col("texts") >= support)))
    if joint.isEmpty():
        return words.limit(0).select("k", "start", "end", F.lit(0.0).alias("share"))
    # How many units of the corpus have each candidate: sketches of fixed size per term,
    # combined before the shuffle, put aside what is far too frequent to tell (the margin is
    # ten times their error); the terms left are counted exactly afterwards.
    corpus = rows.select(F.explode(F.split("text", "\n", -1)).alias("text"))
    n = float(unit_total(corpus))
    units = _units(corpus)
    sketch = cut(restrict(units.select("term", "u"), cut(joint.select("term").distinct()), "term")
                 .groupBy("term").agg(F.approx_count_distinct("u", 0.01).alias("about")))
    most = F.col("both") * F.pow(F.lit(n) / F.col("ne"), F.lit(1 - generalise))
    joint = cut(joint.join(sketch, "term").where(F.col("about") <= 1.1 * most).drop("about"))
    counts = (restrict(units, cut(joint.select("term").distinct()), "term").select("term", "u").distinct()
              .groupBy("term").agg(F.count("*").alias("nt")))
    pmi = F.log(F.lit(n) * F.col("both") / (F.col("ne") * F.col("nt")))
    share = F.try_divide(pmi, F.log(F.lit(n) / F.col("ne")))
    telling = joint.join(counts, "term").withColumn("share", share).where(F.col("share") >= generalise)
    return (words.join(held, "u").join(telling.select("e", "term", "share"), ["e", "term"])
            .groupBy("k", "start", "end").agg(F.max("share").alias("share")))


def personal_spans(docs: DataFrame, **kwargs) -> DataFrame:
    """``k, kind, start, end, share`` of every span (share: for terms)."""
    rows = _keyed(docs)
    base = cut(base_spans(rows))
    terms = term_spans(rows, base, **kwargs)
    return base.select("k", "kind", "start", "end", F.lit(None).cast("double").alias("share")).unionByName(
        terms.select("k", F.lit("term").alias("kind"), "start", "end", "share"))


def _order(kind: Column) -> Column:
    return F.array_position(F.array(*[F.lit(k) for k in KINDS]), kind)


def find_personal(docs: DataFrame, **kwargs) -> DataFrame:
    """``doc_id, spans`` (array of kind, start, end, share; by kind as listed, then start)."""
    spans = personal_spans(docs, **kwargs).groupBy("k").agg(F.array_sort(F.collect_list(
        F.struct(_order(F.col("kind")).alias("o"), "start", "end", "kind", "share"))).alias("s"))
    kept = F.transform(F.col("s"), lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"),
                                                      x["end"].alias("end"), x["share"].alias("share")))
    kind = "array<struct<kind:string,start:bigint,end:bigint,share:double>>"
    return (_keyed(docs).select("k", "doc_id").join(spans, "k", "left")
            .select("doc_id", F.coalesce(kept, F.array().cast(kind)).alias("spans")))


def sanitise(docs: DataFrame, remove: float = REMOVE, **kwargs) -> DataFrame:
    """``doc_id, text``: base spans as [EMAIL], [IP], [CARD], [PHONE]; telling terms as [WORD],
    or nothing.  Of overlapping spans the one that starts first (then the longer) is used."""
    rows = _keyed(docs)
    spans = personal_spans(docs, **kwargs).groupBy("k").agg(F.array_sort(F.collect_list(F.struct(
        "start", (-F.col("end")).alias("less"), "kind", "share"))).alias("s"))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))

    def step(a: Column, x: Column) -> Column:
        mark = F.when((x["kind"] == "term") & (x["share"] >= remove), "").when(
            x["kind"] == "term", "[WORD]").otherwise(F.concat(F.lit("["), F.upper(x["kind"]), F.lit("]")))
        before = F.substring(F.col("text"), (a["at"] + 1).cast("int"), (x["start"] - a["at"]).cast("int"))
        return F.when(x["start"] < a["at"], a).otherwise(F.struct(
            (-x["less"]).alias("at"), F.concat(a["out"], F.array(before, mark)).alias("out")))

    rest = F.substring(F.col("text"), (F.col("b.at") + 1).cast("int"), F.char_length("text"))
    some = rows.join(spans, "k", "left").withColumn("b", F.aggregate(
        F.coalesce("s", F.array().cast(dict(spans.dtypes)["s"])), start, step))
    return some.select("doc_id", F.concat(F.array_join("b.out", ""), rest).alias("text"))


def _is(kind: str):
    return lambda x: x["kind"] == kind


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal(table(spark, sf_dir, "documents"))
    s = F.col("spans")
    count = [F.size(F.filter(s, _is(k))).cast("long").alias(f"n_{k}") for k in KINDS[:4]]

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    return found.select("doc_id", *count,
                        F.sha2(joined(F.filter(s, lambda x: x["kind"] != "term")), 256).alias("base_sha256"),
                        joined(s).alias("spans"))


QUERIES = {"op7_pii": op7_pii}
