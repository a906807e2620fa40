"""Phrase collocations by SETM: sorted occurrence relations, merge-joined level by level.

The relation R(k) holds an occurrence of a frequent phrase of k words per entry: the piece,
the position in it and the phrase's number.  It is persisted as Parquet, sorted by piece and
position and cut into chunks that no piece crosses (a position leaves a gap between
pieces, so one number says both), hence

* the merge-join by piece and adjacent position, R(k) with R(k) one position later, runs
  inside a chunk and moves nothing: a phrase of k + 1 words is a pair (phrase of its
  first k words, phrase of its last k);
* groups of equal pairs are counted, combined in the task before the shuffle, and those met
  ``min_count`` times become C(k + 1);
* R(k + 1) is the semi-join of the occurrences with C(k + 1), before the next extension.

A phrase's number is given when C(k) is written, so pairs are compared exactly, never by
hash; words are compared as strings.  C(k) is broadcast up to ``bound`` phrases and joined by a
shuffle beyond, with hot phrases apart (``hot.lookup``).  Every frequent phrase carries the
frequencies of all its beginnings and ends, so a cut's score needs no further look-up; products are
decimals of 38 digits.  A phrase that is absorbed by a longer one is absorbed by one that is
one word longer, since frequencies only fall on the way.

Defined results: a null text is empty, a null language ``und``; a piece without words counts
nothing; repeated rows count each for itself; an empty table gives no rows; further columns are
ignored.
"""

from __future__ import annotations

import contextlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orchard.llm.common import Powers, byte_runs, cut, prefix_sums, span_hashes, table, texts, tidy, written
from orchard.llm.hot import lookup
from orchard.llm.wordbytes import as_strings, byte_set, counted, words_of

MIN_COUNT, MAX_WORDS, TOP, ABSORBED = 100, 5, 2000, 100     # ABSORBED in percent of a phrase's frequency
RUN_BYTES = 1_000_000       # texts tokenised together
CHUNK = 1_024               # words in a chunk, but for a longer piece
FLUSH = 400_000             # pairs combined in a task before they are sent on
BOUND = 4_000_000           # phrases broadcast, 48 MB
_BREAK = byte_set((0x0A, 0x0D), *((ord(c),) * 2 for c in ".,;:!?"))
_WORD = ~(_BREAK | byte_set((0x20, 0x20), (0x09, 0x09)))


class _Run:
    """Words of a run of texts: dictionary codes, languages and positions."""

    def __init__(self, rows, data, off):
        words, start, _, self.doc = words_of(data, off, _WORD)
        coded = words.dictionary_encode()
        self.codes, self.words = coded.indices.to_numpy(), coded.dictionary
        langs = rows.column(0).dictionary_encode()
        self.langs, self.lang = langs.dictionary, langs.indices.to_numpy()[self.doc]
        breaks = np.cumsum(_BREAK[data], dtype=np.int32)[start]
        self.new = np.append(True, (np.diff(breaks) > 0) | (np.diff(self.doc) > 0))[:len(start)]
        self.pos = np.arange(len(start)) + np.cumsum(self.new)


def _source(docs: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    rows = docs.withColumn("lang", F.coalesce(F.col(lang_col).cast("string"), F.lit("und")))
    return texts(rows.withColumn("doc_id", F.lit(0)), "doc_id", text_col, "lang").select("lang", "text")


def word_counts(rows: DataFrame) -> DataFrame:
    """``lang, word, f`` of all words."""
    schema = pa.schema([("lang", pa.string()), ("word", pa.string()), ("f", pa.int64())])

    def combined(parts):
        held = pa.Table.from_batches(parts).group_by(["lang", "word"], use_threads=False).aggregate([("f", "sum")])
        held = held.rename_columns({"f_sum": "f"}).select(schema.names).cast(schema)
        return held.combine_chunks().to_batches()

    def run(it):
        parts, held = [], 0
        for b, data, off in byte_runs(it, RUN_BYTES):
            r = _Run(b, data, off)
            key, f = counted(r.codes.astype(np.int64) * len(r.langs) + r.lang)
            parts.append(pa.record_batch([r.langs.take(pa.array(key % len(r.langs))),
                                          r.words.take(pa.array(key // len(r.langs))), pa.array(f)], schema=schema))
            held += len(key)
            if held >= FLUSH:
                yield from combined(parts)
                parts, held = [], 0
        if parts:
            yield from combined(parts)

    return (rows.mapInArrow(tidy(run), "lang string, word string, f long")
            .groupBy("lang", "word").agg(F.sum("f").alias("f")))


_RELATION = "chunk long, pos array<long>, id array<long>"
_RELATION_SCHEMA = pa.schema([("chunk", pa.int64()), ("pos", pa.list_(pa.int64())), ("id", pa.list_(pa.int64()))])


def _chunks(pos: np.ndarray, ids: np.ndarray, chunk: np.ndarray) -> pa.RecordBatch:
    """Relation rows of sorted occurrences; ``chunk`` is their chunk's number, in runs (a task that
    reads several files meets the numbers in any order)."""
    at = np.flatnonzero(np.append(True, chunk[1:] != chunk[:-1])[:len(chunk)])
    names, at = chunk[at], pa.array(np.append(at, len(chunk)).astype(np.int32))
    return pa.record_batch([pa.array(names), pa.ListArray.from_arrays(at, pa.array(pos)),
                            pa.ListArray.from_arrays(at, pa.array(ids))], schema=_RELATION_SCHEMA)


class _Numbering:
    """Chunk numbers and positions in chunks of a task: the same whenever the task is run again."""

    def __init__(self):
        self.next = TaskContext.get().partitionId() << 33

    def of(self, r: _Run) -> tuple[np.ndarray, np.ndarray]:
        begins = np.flatnonzero(r.new)
        number = np.repeat(begins // CHUNK, np.diff(np.append(begins, len(r.pos))))
        first = np.flatnonzero(np.append(True, number[1:] != number[:-1])[:len(number)])
        pos = r.pos - np.repeat(r.pos[first], np.diff(np.append(first, len(number))))
        out = self.next + number
        self.next += len(r.pos) // CHUNK + 1
        return out, pos


def _slices(it, rows: int = 128):
    """Relation rows in batches of bounded size."""
    for b in it:
        for lo in range(0, b.num_rows, rows):
            yield b.slice(lo, rows)


def _flat(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """chunk, pos and id of the occurrences of relation rows."""
    many = np.diff(b.column(1).offsets.to_numpy())
    return (np.repeat(b.column(0).to_numpy(), many), b.column(1).flatten().to_numpy(),
            b.column(2).flatten().to_numpy())


def _adjacent(b: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """chunk, pos, prefix, suffix: the relation merge-joined with itself one position later."""
    chunk, pos, ids = _flat(b)
    i = np.flatnonzero((pos[1:] == pos[:-1] + 1) & (chunk[1:] == chunk[:-1]))
    return chunk[i], pos[i], ids[i], ids[i + 1]


def _collected(joined: DataFrame) -> DataFrame:
    """Relation rows again from single occurrences ``chunk, pos, id``."""
    rows = joined.groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("pos", "id"))).alias("o"))
    return rows.select("chunk", F.col("o.pos").alias("pos"), F.col("o.id").alias("id"))


def _hashes(words: pa.Array, powers: Powers) -> np.ndarray:
    """64-bit hashes of strings."""
    words = pa.concat_arrays([words])                       # a slice keeps its offsets, a copy starts at 0
    _, off, data = words.buffers()
    off = np.frombuffer(off, np.int32, len(words) + 1).astype(np.int64) if len(words) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8, off[-1] - off[0], off[0]) if off[-1] > off[0] else np.empty(0, np.uint8)
    off = off - off[0]
    return span_hashes(prefix_sums(data, powers), off[:-1], off[1:], powers)


class _Known:
    """Numbers of known words: found by hash, compared as strings.  Unlike ``index_in`` a look-up does not
    read all known words."""

    def __init__(self, names: pa.Array, ids: np.ndarray, powers: Powers):
        self.powers, step = powers, 65_536
        parts = [_hashes(names.slice(a, step), powers) for a in range(0, len(names), step)]
        hashes = np.concatenate(parts)
        order = np.argsort(hashes)
        self.hashes, self.names, self.ids = hashes[order], names.take(pa.array(order)), ids[order]
        self.twins = bool((self.hashes[1:] == self.hashes[:-1]).any())

    def of(self, words: pa.Array, hashes: np.ndarray) -> np.ndarray:
        """The number of each word, -1 of an unknown one."""
        if self.twins:
            place = pc.fill_null(pc.index_in(words, value_set=self.names), -1).to_numpy(zero_copy_only=False)
            return np.append(self.ids, -1)[place]
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        out, hit = np.full(len(words), -1), np.flatnonzero(self.hashes[at] == hashes)
        same = pc.equal(words.take(pa.array(hit)), self.names.take(pa.array(at[hit]))).to_numpy(zero_copy_only=False)
        out[hit[same]] = self.ids[at[hit[same]]]
        return out


def first_relation(rows: DataFrame, words: DataFrame, bound: int) -> DataFrame:
    """R(1): occurrences of the words of C(1) (cut; ``lang, phrase, id, f``)."""
    if words.count() > bound // 2:
        def each(it):
            numbering = _Numbering()
            for b, data, off in byte_runs(it, RUN_BYTES):
                r = _Run(b, data, off)
                chunk, pos = numbering.of(r)
                yield pa.record_batch([pa.array(chunk), pa.array(pos), r.langs.take(pa.array(r.lang)),
                                       r.words.take(pa.array(r.codes))], names=["chunk", "pos", "lang", "phrase"])
        flat = rows.mapInArrow(tidy(each), "chunk long, pos long, lang string, phrase string")
        return _collected(lookup(flat, words.select("lang", "phrase", "id", "f"), ["lang", "phrase"], "f", bound=bound))
    listed = words.select("lang", "phrase", "id").toArrow().combine_chunks()
    own = {lang: listed.filter(pc.equal(listed["lang"], lang)) for lang in pc.unique(listed["lang"]).to_pylist()}
    shipped = rows.sparkSession.sparkContext.broadcast(
        {lang: (as_strings(part["phrase"].combine_chunks()), part["id"].to_numpy()) for lang, part in own.items()})

    def run(it):
        numbering, powers = _Numbering(), Powers()
        known = {lang: _Known(names, ids, powers) for lang, (names, ids) in shipped.value.items()}
        for b, data, off in byte_runs(it, RUN_BYTES):
            r = _Run(b, data, off)
            (chunk, pos), ids = numbering.of(r), np.full(len(r.pos), -1)
            hashes = _hashes(r.words, powers)
            for j, lang in enumerate(r.langs.to_pylist()):
                if lang in known:
                    own = r.lang == j
                    codes = np.flatnonzero(np.bincount(r.codes[own], minlength=len(r.words)))
                    numbers = np.full(len(r.words), -1)
                    numbers[codes] = known[lang].of(r.words.take(pa.array(codes)), hashes[codes])
                    ids[own] = numbers[r.codes[own]]
            stay = ids >= 0
            yield _chunks(pos[stay], ids[stay], chunk[stay])

    return rows.mapInArrow(tidy(run), _RELATION)


PACKED = 1 << 31            # up to so many phrases of a length a pair of them is one number


def pair_counts(relation: DataFrame, phrases: int) -> DataFrame:
    """``prefix, suffix, f`` of all adjacent occurrences; ids are below ``phrases``."""
    packed = phrases <= PACKED
    names = ["pair", "f"] if packed else ["prefix", "suffix", "f"]
    schema = pa.schema([(c, pa.int64()) for c in names])

    def combined(parts):
        a, b = (np.concatenate(x) for x in zip(*parts))
        if packed:
            cols = counted(a << 32 | b)
        else:
            ids, code = np.unique(np.concatenate([a, b]), return_inverse=True)
            key, f = counted(code[:len(a)] * len(ids) + code[len(a):])
            cols = ids[key // len(ids)], ids[key % len(ids)], f
        return pa.record_batch([pa.array(c) for c in cols], schema=schema)

    def run(it):
        parts, held = [], 0
        for b in _slices(it):
            _, _, prefix, suffix = _adjacent(b)
            if len(prefix):
                parts.append((prefix, suffix))
                held += len(prefix)
            if held >= FLUSH:
                yield combined(parts)
                parts, held = [], 0
        if parts:
            yield combined(parts)

    counts = relation.mapInArrow(tidy(run), ", ".join(f"{c} long" for c in names)).groupBy(*names[:-1]).agg(
        F.sum("f").alias("f"))
    if packed:
        counts = counts.select(F.shiftright("pair", 32).alias("prefix"),
                               F.col("pair").bitwiseAND((1 << 32) - 1).alias("suffix"), "f")
    return counts


def next_relation(relation: DataFrame, phrases: DataFrame, bound: int) -> DataFrame:
    """R(k + 1): adjacent occurrences semi-joined with C(k + 1) (cut; ``prefix, suffix, id, f``)."""
    if phrases.count() > bound:
        def each(it):
            for b in _slices(it):
                yield pa.record_batch([pa.array(x) for x in _adjacent(b)], names=["chunk", "pos", "prefix", "suffix"])
        flat = relation.mapInArrow(tidy(each), "chunk long, pos long, prefix long, suffix long")
        pairs = phrases.select("prefix", "suffix", "id", "f")
        return _collected(lookup(flat, pairs, ["prefix", "suffix"], "f", bound=bound))
    listed = phrases.select("prefix", "suffix", "id").toArrow()
    first, second, ids = (listed[c].to_numpy() for c in ("prefix", "suffix", "id"))
    packed = max(first.max(initial=0), second.max(initial=0)) < PACKED
    a, b = (None, None) if packed else (np.unique(first), np.unique(second))
    pair = first << 32 | second if packed else np.searchsorted(a, first) * len(b) + np.searchsorted(b, second)
    order = np.argsort(pair)
    small = ids.max(initial=0) < 1 << 31
    shipped = relation.sparkSession.sparkContext.broadcast(
        (a, b, pair[order], ids[order].astype(np.int32 if small else np.int64)))

    def run(it):
        a, b, pair, ids = shipped.value
        for rows in _slices(it):
            chunk, pos, prefix, suffix = _adjacent(rows)
            if not len(ids) or not len(pos):
                continue
            if packed:
                stay, want = True, prefix << 32 | suffix
            else:
                i = np.minimum(np.searchsorted(a, prefix), len(a) - 1)
                j = np.minimum(np.searchsorted(b, suffix), len(b) - 1)
                stay, want = (a[i] == prefix) & (b[j] == suffix), i * len(b) + j
            at = np.minimum(np.searchsorted(pair, want), len(pair) - 1)
            stay = np.flatnonzero(stay & (pair[at] == want))
            if len(stay):
                yield _chunks(pos[stay], ids[at[stay]].astype(np.int64), chunk[stay])

    return relation.mapInArrow(tidy(run), _RELATION)


def _numbered(phrases: DataFrame) -> tuple[DataFrame, int]:
    """Cut, every phrase under a number of its own from 0 on, and how many there are.  Only the
    number of rows of each partition reaches the driver."""
    rows = cut(phrases.withColumn("at", F.monotonically_increasing_id()))
    part = F.shiftrightunsigned("at", 33).cast("int")
    first, starts = 0, []
    for r in rows.groupBy(part.alias("p")).agg(F.count("*").alias("n")).orderBy("p").collect():
        starts.append((r["p"], first))
        first += r["n"]
    starts = F.broadcast(rows.sparkSession.createDataFrame(starts, "p int, first long"))
    id_ = F.col("first") + F.col("at").bitwiseAND((1 << 33) - 1)
    return rows.withColumn("p", part).join(starts, "p").withColumn("id", id_).drop("p", "first", "at"), first


def frequent_phrases(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, lang_col: str = "lang",
                     text_col: str = "text", bound: int = BOUND) -> list[DataFrame]:
    """C(1) to C(max_words): ``id, prefix, suffix, lang, phrase, n, f, starts, ends`` of all phrases
    met ``min_count`` times; starts and ends are the frequencies of the first and last 1, 2 … words."""
    rows = _source(docs, lang_col, text_col)
    none = F.lit(None).cast("long")
    with contextlib.ExitStack() as tables:
        words = tables.enter_context(written(word_counts(rows)))
        totals = cut(words.groupBy("lang").agg(F.sum("f").alias("n"), F.count("*").alias("words")))
        often = lookup(words.where(F.col("f") >= min_count), totals, ["lang"], "words", bound=bound)
        first, size = _numbered(often.select(
            none.alias("prefix"), none.alias("suffix"), "lang", F.col("word").alias("phrase"), F.col("word").alias("last"),
            "n", "f", F.array("f").alias("starts"), F.array("f").alias("ends")))
        levels = [first]
        relation = tables.enter_context(written(first_relation(rows, levels[0], bound)))
        while len(levels) < max_words:
            pairs = cut(pair_counts(relation, size).where(F.col("f") >= min_count))
            start = levels[-1].select(F.col("id").alias("prefix"), "lang", "n", "starts", F.col("phrase").alias("head"))
            end = levels[-1].select(F.col("id").alias("suffix"), "ends", "last")
            named = pairs.join(start, "prefix").join(end, "suffix")
            longer, size = _numbered(named.select(
                "prefix", "suffix", "lang", F.concat_ws(" ", "head", "last").alias("phrase"), "last", "n", "f",
                F.array_append("starts", F.col("f")).alias("starts"), F.array_append("ends", F.col("f")).alias("ends")))
            levels.append(longer)
            if len(levels) < max_words:
                relation = tables.enter_context(written(next_relation(relation, levels[-1], bound)))
    return levels


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, top: int = TOP,
                 absorbed: int = ABSORBED, lang_col: str = "lang", text_col: str = "text",
                 bound: int = BOUND) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: every language's ``top`` phrases whose words go together."""
    levels = frequent_phrases(docs, min_count, max_words, lang_col, text_col, bound)
    kept = []
    for k in range(2, max_words + 1):
        phrases = levels[k - 1]
        if k < max_words:
            longer = levels[k]
            shorter = F.array(F.struct(F.col("prefix").alias("id"), F.col("starts")[k - 1].alias("a")),
                              F.struct(F.col("suffix").alias("id"), F.col("ends")[k - 1].alias("a")))
            gone = (longer.select("f", F.explode(shorter).alias("s"))
                    .where(100 * F.col("f") >= absorbed * F.col("s.a")).select("s.id").distinct())
            phrases = phrases.join(gone, "id", "left_anti")
        kept.append(phrases)
    found = kept[0]
    for more in kept[1:]:
        found = found.unionByName(more)
    cuts = F.expr("""array_min(transform(sequence(1, size(starts) - 1), k -> struct(
        (cast(1000 as decimal(38,0)) * f * n) div (cast(starts[k - 1] as decimal(38,0)) * ends[size(ends) - k - 1]) as score,
        k as k, starts[k - 1] as l, ends[size(ends) - k - 1] as r)))""")
    best = found.select("lang", "phrase", F.col("f").alias("a"), "n", cuts.alias("c"))
    rows = best.select("lang", "phrase", "a", F.col("c.l").alias("l"), F.col("c.r").alias("r"), "n",
                       F.col("c.score").cast("long").alias("score"))
    w = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    return (rows.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= top)
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


_ABC = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_GRAMS = "\nUNION ALL ".join(
    f"SELECT lang, {k} AS k, array_to_string(ws[i:i + {k - 1}], ' ') AS p FROM "
    f"(SELECT lang, ws, unnest(range(1, len(ws) - {k} + 2)) AS i FROM pieces WHERE len(ws) >= {k})"
    for k in range(1, MAX_WORDS + 1))
_CUTS = "\nUNION ALL ".join(
    f"SELECT lang, p, k, a, {j} AS j, array_to_string(string_split(p, ' ')[:{j}], ' ') AS lp, "
    f"array_to_string(string_split(p, ' ')[{j + 1}:], ' ') AS rp FROM f WHERE k > {j}" for j in range(1, MAX_WORDS))

OP11_SQL = f"""
WITH cutup AS (SELECT coalesce(lang, 'und') AS lang,
                      unnest(regexp_split_to_array(translate(coalesce(text, ''), {_ABC}), '[.,;:!?\\n-\\r]')) AS piece
               FROM documents),
pieces AS (SELECT lang, regexp_extract_all(piece, '[^ \\t]+') AS ws FROM cutup),
totals AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM pieces GROUP BY lang),
grams AS ({_GRAMS}),
f AS (SELECT lang, k, p, count(*)::BIGINT AS a FROM grams GROUP BY ALL HAVING count(*) >= {MIN_COUNT}),
inner_f AS (SELECT lang, k, a, array_to_string(string_split(p, ' ')[:k - 1], ' ') AS part FROM f WHERE k > 2
            UNION ALL SELECT lang, k, a, array_to_string(string_split(p, ' ')[2:], ' ') FROM f WHERE k > 2),
gone AS (SELECT DISTINCT s.lang, s.p FROM f s JOIN inner_f i ON s.lang = i.lang AND s.p = i.part
         WHERE 100 * i.a >= {ABSORBED} * s.a),
cuts AS ({_CUTS}),
scored AS (SELECT c.lang, c.p, c.a, x.a AS l, y.a AS r, n, j,
                  ((1000::HUGEINT * c.a * n) // (x.a::HUGEINT * y.a))::BIGINT AS score
           FROM cuts c JOIN f x ON x.lang = c.lang AND x.p = c.lp JOIN f y ON y.lang = c.lang AND y.p = c.rp
           JOIN totals t ON t.lang = c.lang),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, j) = 1),
ranked AS (SELECT lang, p AS phrase, a, l, r, n, score,
                  row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, p) AS rank
           FROM best ANTI JOIN gone USING (lang, p))
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= {TOP}
"""

QUERIES = {"op11_collocations": op11_collocations}
ORACLE = {"op11_collocations": OP11_SQL}
