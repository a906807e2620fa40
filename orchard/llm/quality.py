"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model.

The model predicts each byte of a text from the four before it (digits read as 0,
texts padded in front).  Counts cover all trusted text and are sharded by n-gram;
every order's probabilities come from joins of n-gram counts with context counts
(Chen and Goodman's three discounts, continuation counts below the top order, a
uniform base).  All n-grams of the corpus get their probability that way, seen in
trusted text or not.

To score texts without moving them, the ``HOT`` most frequent n-grams (a fixed
number, 3 MB) are sent to the tasks, which add up their share in place; each
remaining n-gram of a text becomes a row that is joined with the sharded table.
A text is rejected when its mean log-perplexity lies above its language's limit: a
quantile of trusted texts plus ``SPREAD`` / sqrt(bytes), as the mean over few bytes
varies more.  Which of the ``LEVELS`` is the quantile is fitted per language on the
labelled texts of both classes: the one with the least sum of the share of trusted
texts that go and the share of untrusted ones that stay (the lowest of equals).
One trusted text in ``HELD_OUT`` (by a hash of its id) is kept out of the model, and limits
are fitted on these alone: texts that the model has counted are easier for it than unseen
ones of the same kind.

Defined results: null or empty texts have no perplexity and are kept; rows equal
in id and text are reported once; a null language is a language of its own; a
language with fewer than ``MIN_TRUSTED`` held-out texts takes the limit over all
languages; without untrusted texts the lowest level is taken; with fewer held-out texts
altogether everything is kept; an id counts as trusted when all its labels say so;
extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orchard.llm.common import byte_runs, cut, flagged, release, restrict, table, texts, tidy

ORDER = 5
HOT = 1 << 18
LEVELS = (0.99, 0.9925, 0.995, 0.9975, 0.999)
SPREAD = 2.0
MIN_TRUSTED = 20
HELD_OUT = 4

_FOLD = np.array([48 if 48 <= b <= 57 else b for b in range(256)], np.uint8)


def gram_codes(data: np.ndarray, offsets: np.ndarray, order: int = ORDER) -> np.ndarray:
    """The n-gram that ends at each byte, as a number (first byte on top, zeros before a text)."""
    pad = order - 1
    shift = np.repeat(np.arange(1, len(offsets)) * pad, np.diff(offsets))
    at = np.arange(len(data)) + shift
    low = np.zeros(len(data) + pad * len(offsets), np.uint8)
    low[at] = _FOLD[data]
    code = np.zeros(len(data), np.int64)
    for j in range(pad, -1, -1):
        code = code << 8 | low[at - j]
    return code


def _inputs(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    rows = texts(docs.select(id_col, text_col, F.col(lang_col).cast("string").alias("_lang")), id_col, text_col, "_lang")
    return rows.select(F.xxhash64("doc_id", "text").alias("k"), "text", "doc_id", F.col("_lang").alias("lang"))


def gram_counts(rows: DataFrame) -> DataFrame:
    """``g, c, t``: occurrences of every n-gram in all texts and in trusted ones."""
    schema = pa.schema([(c, pa.int64()) for c in ("g", "c", "t")])

    def merged(parts):
        g = np.concatenate([p[0] for p in parts])
        u, inverse = np.unique(g, return_inverse=True)
        return u, *(np.bincount(inverse, np.concatenate([p[i] for p in parts]), len(u)).astype(np.int64)
                    for i in (1, 2))

    def run(it):
        parts, size = [], 0
        for b, data, off in byte_runs(it):
            trusted = np.repeat(b.column(2).to_numpy(zero_copy_only=False), np.diff(off))
            u, c = np.unique(gram_codes(data, off) << 1 | trusted, return_counts=True)
            parts.append((u >> 1, c, c * (u & 1)))
            size += len(u)
            if size > 1_000_000:            # combine in bounded memory, then hand over
                parts = [merged(parts)]
                size = len(parts[0][0])
                if size > 500_000:
                    yield pa.record_batch([pa.array(x) for x in parts[0]], schema=schema)
                    parts, size = [], 0
        if parts:
            yield pa.record_batch([pa.array(x) for x in merged(parts)], schema=schema)

    return (rows.select("k", "text", "trusted").mapInArrow(tidy(run), "g long, c long, t long")
            .groupBy("g").agg(F.sum("c").alias("c"), F.sum("t").alias("t")))


def _discounts(counts: DataFrame) -> list[float]:
    """Discounts for counts of 1, 2 and 3 or more, from the counts of counts."""
    r = counts.agg(*[F.count(F.when(F.col("c") == k, 1)).alias(f"n{k}") for k in (1, 2, 3, 4)]).head()
    n1, n2, n3, n4 = (float(r[f"n{k}"]) for k in (1, 2, 3, 4))
    if not (n1 and n2 and n3):
        return [0.5, 0.5, 0.5]
    y = n1 / (n1 + 2 * n2)
    return [min(max(d, 0.01), cap) for d, cap in
            ((1 - 2 * y * n2 / n1, 0.99), (2 - 3 * y * n3 / n2, 1.99), (3 - 4 * y * n4 / n3, 2.99))]


def _discount(c: Column, d: list[float]) -> Column:
    return F.when(c == 1, d[0]).when(c == 2, d[1]).otherwise(d[2])


def log_probabilities(grams: DataFrame, order: int = ORDER) -> DataFrame:
    """``g, logp`` of every n-gram of ``grams(g, c, t)`` given its first order - 1 bytes."""
    wanted = [None] * (order + 1)               # n-grams of each order that occur at all
    seen = [None] * (order + 1)                 # trusted counts, continuation counts below the top
    wanted[order] = grams.select("g")
    seen[order] = grams.where("t > 0").select("g", F.col("t").alias("c"))
    for n in range(order - 1, 0, -1):
        last = F.col("g").bitwiseAND((1 << 8 * n) - 1).alias("g")
        wanted[n] = cut(wanted[n + 1].select(last).distinct())
        seen[n] = cut(seen[n + 1].select(last).groupBy("g").agg(F.count("*").alias("c")))
    lower = None
    for n in range(1, order + 1):
        d = _discounts(seen[n])
        c = F.col("c")
        context = seen[n].groupBy(F.shiftright("g", 8).alias("ctx")).agg(
            F.sum("c").cast("double").alias("total"), F.sum(_discount(c, d)).alias("held"))
        rows = (wanted[n].join(seen[n], "g", "left").withColumn("ctx", F.shiftright("g", 8))
                .join(context, "ctx", "left"))
        if lower is None:
            rows = rows.withColumn("below", F.lit(1 / 256))
        else:
            rows = (rows.withColumn("low", F.col("g").bitwiseAND((1 << 8 * (n - 1)) - 1))
                    .join(lower.select(F.col("g").alias("low"), F.col("p").alias("below")), "low", "left"))
        own = F.greatest(c - _discount(c, d), F.lit(0.0)) / F.col("total")
        p = F.when(F.col("total").isNull(), F.col("below")).otherwise(
            F.coalesce(own, F.lit(0.0)) + F.col("held") / F.col("total") * F.col("below"))
        lower = cut(rows.select("g", p.alias("p")))
    return lower.select("g", F.log("p").alias("logp"))


class GramTable:
    """Log-probabilities of a fixed number of n-grams by open addressing."""

    BITS = 20

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.keys = np.full(1 << self.BITS, -1, np.int64)
        self.values = np.zeros(1 << self.BITS)
        slot, todo = self._slot(keys), np.arange(len(keys))
        while len(todo):
            free = todo[self.keys[slot[todo]] == -1]
            s, one = np.unique(slot[free], return_index=True)
            self.keys[s], self.values[s] = keys[free[one]], values[free[one]]
            todo = todo[self.keys[slot[todo]] != keys[todo]]
            slot[todo] = (slot[todo] + 1) & ((1 << self.BITS) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        h = keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (h >> np.uint64(64 - self.BITS)).astype(np.int64)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values (0 where absent) and the places of absent keys."""
        slot = self._slot(keys)
        got = self.keys[slot]
        out = np.where(got == keys, self.values[slot], 0.0)
        absent = []
        todo = np.flatnonzero(got != keys)
        while len(todo):
            empty = self.keys[slot[todo]] == -1
            absent.append(todo[empty])
            todo = todo[~empty]
            slot[todo] = (slot[todo] + 1) & ((1 << self.BITS) - 1)
            hit = self.keys[slot[todo]] == keys[todo]
            out[todo[hit]] = self.values[slot[todo[hit]]]
            todo = todo[~hit]
        return out, np.concatenate(absent) if absent else np.empty(0, np.int64)


def _hot_table(grams: DataFrame, logp: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """N-grams and log-probabilities of the most frequent n-grams, ``HOT`` at most: all those
    above a frequency class, the classes counted first (some hundred rows at any size)."""
    level = F.floor(F.log2(F.col("c").cast("double")) * 16).alias("level")
    classes = sorted(((r["level"], r["count"]) for r in grams.groupBy(level).count().collect()), reverse=True)
    least, room = None, HOT
    for k, n in classes:
        if n > room:
            break
        least, room = k, room - n
    if least is None:
        return np.empty(0, np.int64), np.empty(0)
    hot = grams.where(level >= least).join(logp, "g").select("g", "logp").toPandas()
    out = hot["g"].to_numpy(np.int64, copy=True), hot["logp"].to_numpy(np.float64, copy=True)
    del hot
    release()
    return out


def perplexity(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               lang_col: str = "lang") -> DataFrame:
    """``doc_id, lang, trusted, n_bytes, log_perplexity`` (mean per byte) of every document;
    ``trusted(doc_id)`` names the texts that the model is trained on."""
    trusted = cut(trusted.select(F.col("doc_id").cast("long").alias("doc_id"))
                  .where("doc_id is not null").distinct())
    rows = flagged(_inputs(docs, id_col, text_col, lang_col), trusted, "doc_id", "trusted")
    grams = cut(gram_counts(rows))
    logp = cut(log_probabilities(grams))
    held = docs.sparkSession.sparkContext.broadcast(_hot_table(grams, logp))
    schema = pa.schema([("k", pa.int64()), ("g", pa.int64()), ("n", pa.int64()), ("s", pa.float64()),
                        ("doc_id", pa.int64()), ("lang", pa.string()), ("trusted", pa.bool_())])

    def run(it):
        known = GramTable(*held.value)
        for b, data, off in byte_runs(it):
            code = gram_codes(data, off)
            value, absent = known.find(code)
            total = np.append(0.0, np.cumsum(value))
            k = b.column(0)
            n = len(off) - 1
            # main rows carry a negative key, spread like k, that no n-gram has
            spread = -1 - (k.to_numpy(zero_copy_only=False) & 0xFFFFFFFFFF)
            yield pa.record_batch([k, pa.array(spread), pa.array(np.diff(off)),
                                   pa.array(total[off[1:]] - total[off[:-1]]),
                                   b.column(2), b.column(3), b.column(4)], schema=schema)
            if len(absent):
                doc = np.searchsorted(off, absent, "right") - 1
                order = np.lexsort((code[absent], doc))
                doc, g = doc[order], code[absent][order]
                new = np.flatnonzero(np.append(True, (g[1:] != g[:-1]) | (doc[1:] != doc[:-1])))
                m = len(new)
                yield pa.record_batch([
                    pa.array(k.to_numpy(zero_copy_only=False)[doc[new]]), pa.array(g[new]),
                    pa.array(np.diff(np.append(new, len(g)))), pa.nulls(m, pa.float64()),
                    pa.nulls(m, pa.int64()), pa.nulls(m, pa.string()), pa.nulls(m, pa.bool_())],
                    schema=schema)

    parts = rows.select("k", "text", "doc_id", "lang", "trusted").mapInArrow(
        tidy(run), "k long, g long, n long, s double, doc_id long, lang string, trusted boolean")
    main = F.col("g") < 0
    share = F.when(main, F.col("s")).otherwise(F.col("n") * F.col("logp"))
    total = (parts.join(logp, "g", "left").groupBy("k").agg(
        F.max("doc_id").alias("doc_id"), F.max("lang").alias("lang"), F.max("trusted").alias("trusted"),
        F.sum(F.when(main, F.col("n"))).alias("n"), F.count(F.when(main, 1)).alias("times"),
        F.sum(share).alias("s")))
    return total.select("doc_id", "lang", "trusted", (F.col("n") / F.col("times")).cast("long").alias("n_bytes"),
                        F.when(F.col("n") > 0, -F.col("s") / F.col("n")).alias("log_perplexity"))


def _limits(labelled: DataFrame, levels: tuple, min_trusted: int) -> DataFrame:
    """``of, own``: the limit of each group of ``labelled(of, trusted, over)``."""
    good, over = F.col("trusted"), F.col("over")
    at = (labelled.where(good).groupBy("of").agg(
        F.percentile_approx(over, F.array(*[F.lit(x) for x in levels]), 10_000).alias("q"), F.count("*").alias("m"))
        .where(F.col("m") >= min_trusted).select(F.col("of").alias("same"), "q"))

    def wrong(i: int) -> Column:
        above = (over > F.col("q")[i]).cast("int")
        share = F.avg(F.when(good, above)) + F.avg(F.when(~good, 1 - above))
        return F.struct(share.alias("share"), F.first("q")[i].alias("limit"))

    # a null share (no untrusted text) is the same for all levels, so the lowest limit is taken
    return (labelled.join(F.broadcast(at), F.col("of").eqNullSafe(F.col("same"))).groupBy("of")
            .agg(F.least(*[wrong(i) for i in range(len(levels))])["limit"].alias("own")))


def classify(docs: DataFrame, labels: DataFrame, levels: tuple = LEVELS, spread: float = SPREAD,
             min_trusted: int = MIN_TRUSTED, held_out: int = HELD_OUT, **columns) -> DataFrame:
    """``perplexity`` rows with their language's ``limit`` and ``keep``; ``trusted`` marks the texts
    that the model has counted.  ``labels(doc_id, quality)``: trusted texts are those of quality 1."""
    judged = labels.where("quality is not null").groupBy("doc_id").agg(F.min("quality").alias("q"))
    judged = judged.withColumn("out", F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(held_out)) == 0)
    scored = cut(perplexity(docs, judged.where("q = 1 and not out").select("doc_id"), **columns))
    unseen = cut(judged.where("q = 1 and out and doc_id is not null")
                 .select(F.col("doc_id").cast("long").alias("doc_id")).distinct())
    lp = F.col("log_perplexity")
    room = F.try_divide(F.lit(float(spread)), F.sqrt("n_bytes"))
    junk = cut(judged.where("q <> 1 and doc_id is not null")
               .select(F.col("doc_id").cast("long").alias("doc_id")).distinct())
    marked = flagged(flagged(scored, junk, "doc_id", "junk"), unseen, "doc_id", "good")
    labelled = cut(marked.where(F.col("good") | F.col("junk"))
                   .select("lang", F.col("good").alias("trusted"), (lp - room).alias("over")).where("over is not null"))
    every = _limits(labelled.withColumn("of", F.lit("all")), levels, min_trusted).head()
    by_lang = _limits(labelled.withColumnRenamed("lang", "of"), levels, min_trusted)
    rest = F.lit(None if every is None else every["own"]).cast("double")
    out = scored.join(by_lang, F.col("lang").eqNullSafe(F.col("of")), "left").withColumn(
        "limit", F.coalesce("own", rest) + room)
    return out.select(*scored.columns, "limit", F.coalesce(lp <= F.col("limit"), F.lit(True)).alias("keep"))


def keep_good(docs: DataFrame, labels: DataFrame, **kwargs) -> DataFrame:
    """``docs`` without the rejected documents, columns as they are; rows without an id stay."""
    bad = cut(classify(docs, labels, **kwargs).where("not keep and doc_id is not null")
              .select("doc_id").distinct())
    return restrict(docs, bad, "doc_id", "left_anti")


def op1_kneser_ney_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        "doc_id", "lang", "n_bytes", F.exp("log_perplexity").alias("perplexity"),
        F.exp("limit").alias("max_perplexity"), "keep")


QUERIES = {"op1_kneser_ney_quality": op1_kneser_ney_quality}
