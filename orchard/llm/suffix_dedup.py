"""Removal of repeated byte strings by hash refinement of anchored text positions
(in place of bucket-pointer refinement, see README).

A byte goes when a string of ``length`` bytes (400) that covers it also starts
anywhere else, in the same text or another.  Positions are not sorted one by one:

* level 0: each window of ``length`` bytes is represented by its smallest q-gram
  (hash order, leftmost first), so equal windows share one.  The q-gram's hash
  is the initial bucket of that position; buckets with one member are final.
* levels 1 to 3: the windows that a q-gram represents are split by their distance
  to it into blocks of up to 64, then 8, then 1.  A block's bucket is refined by
  what follows and precedes: the bytes common to its windows (core) and those
  that any of them covers (hull).  A core met once has no repeated window; a hull
  met twice has no other; both are final.  The next level splits the remaining
  blocks and one block of each hull class that shares a core with them.

Bucket numbers are content hashes of 64 bits, so a refinement needs only the
numbers and counts of the level before, and counts are combined before each
shuffle.  Texts that occur more than once are represented by one copy; the text
of a document moves only when one of its buckets is still open.

Passages of more than 50 words can be shorter than 400 bytes (four in ten are, in the
synthetic tables), so removal alone does not find them all.  ``shared_passages`` counts
them per document by the same anchors over words: nothing more is removed for them.

Defined results: a null text is empty; texts shorter than ``length`` lose
nothing; repeated rows are copies of each other, also with equal or null ids;
an empty table gives no rows; extra columns are ignored.  What is left of a text
is returned as bytes, since a cut may fall inside a character.
"""

from __future__ import annotations

import contextlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orchard.llm.common import (BROADCAST_IDS, Powers, byte_runs, cut, mix64, prefix_sums, restrict, span_hashes,
                                table, texts, tidy, word_spans, written)
from orchard.llm.hot import lookup
from orchard.llm.wordbytes import byte_set

LENGTH = 400
GRAM = 128
BLOCKS = (64, 8, 1)         # windows compared together, level by level
DISTANCE = 1023             # bytes from a window's start to its gram, at most (10 bits of ``_pack``)


def representatives(data: np.ndarray, offsets: np.ndarray, powers: Powers, length: int, gram: int):
    """(bucket, position, first window, last window) of every q-gram that represents windows."""
    sums = prefix_sums(data, powers)
    n = len(data) - gram + 1
    none = np.empty(0, np.int64)
    if n <= length - gram:
        return none.astype(np.uint64), none, none, none
    _, down = powers.take(len(sums))
    order = mix64((sums[gram:] - sums[:-gram]) * down[:n])
    at, first, last = leaders(order, offsets, length, gram)
    return span_hashes(sums, at, at + gram, powers), at, first, last


def leaders(order: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """(position, first window, last window) of the grams that represent windows of ``length``: the
    smallest by ``order``, then the leftmost; windows lie inside one document."""
    n, none = len(order), np.empty(0, np.int64)
    key = (order & np.uint64(0xFFFFFFFF00000000)) | np.arange(n, dtype=np.uint64)
    span, width = length - gram + 1, 1
    while width * 2 <= span:
        key = np.minimum(key[:-width], key[width:])
        width *= 2
    if width < span:
        key = np.minimum(key[:len(key) - (span - width)], key[span - width:])
    at = (key & np.uint64(0xFFFFFFFF)).astype(np.int64)
    starts = np.arange(len(at))
    inside = np.ones(len(at), bool)
    for end in offsets[1:-1]:
        inside[max(0, end - length + 1):end] = False
    starts, at = starts[inside], at[inside]
    if not len(at):
        return none, none, none
    new = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
    return at[new], starts[new], starts[np.append(new[1:], len(at)) - 1]


def _keyed(docs: DataFrame) -> DataFrame:
    """Row key k of (id, text): rows that agree in both share it and are handled alike."""
    return texts(docs).select(F.xxhash64("doc_id", "text").alias("k"), "text", "doc_id")


def _pack(at, near, far):
    """Windows that start near to far bytes before position ``at``, as one number."""
    return at << 20 | near << 10 | far


def _anchors(rows: DataFrame, length: int, gram: int) -> DataFrame:
    schema = pa.schema([(c, pa.int64()) for c in ("bucket", "k", "span")])

    def run(it):
        powers = Powers()
        for b, data, off in byte_runs(it):
            h, at, first, last = representatives(data, off, powers, length, gram)
            doc = np.searchsorted(off, at, "right") - 1
            k = b.column(0).to_numpy(zero_copy_only=False)
            yield pa.record_batch([pa.array(x) for x in (h.view(np.int64), k[doc], _pack(
                at - off[doc], at - last, at - first))], schema=schema)

    return rows.select("k", "text").mapInArrow(tidy(run), "bucket long, k long, span long")


def _refined(rows: DataFrame, length: int, block: int) -> DataFrame:
    """``core, hull, k, span`` of the blocks of the windows listed in ``spans``."""
    schema = pa.schema([(c, pa.int64()) for c in ("core", "hull", "k", "span")])

    def run(it):
        powers = Powers()
        for b, data, off in byte_runs(it):
            sums = prefix_sums(data, powers)
            lists = b.column(2)
            doc = np.repeat(np.arange(b.num_rows), np.diff(lists.offsets.to_numpy()))
            span = lists.flatten().to_numpy(zero_copy_only=False)
            at, near, far = (span >> 20) + off[doc], span >> 10 & 1023, span & 1023
            many = far // block - near // block + 1
            row = np.repeat(np.arange(len(at)), many)
            j = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many) + near[row] // block
            at, doc = at[row], doc[row]
            near, far = np.maximum(near[row], j * block), np.minimum(far[row], j * block + block - 1)
            start = at - j * block
            core = span_hashes(sums, start, start - block + 1 + length, powers)
            hull = span_hashes(sums, at - far, at - near + length, powers)
            # cores of one distance, and hulls of the same windows, are comparable
            core = mix64(core + j.astype(np.uint64))
            hull = mix64(hull + (near * 1024 + far).astype(np.uint64))
            k = b.column(0).to_numpy(zero_copy_only=False)
            yield pa.record_batch([pa.array(x) for x in (
                core.view(np.int64), hull.view(np.int64), k[doc], _pack(at - off[doc], near, far))],
                schema=schema)

    return rows.mapInArrow(tidy(run), "core long, hull long, k long, span long")


def _with_spans(rows: DataFrame, spans: DataFrame) -> DataFrame:
    """``k, text, spans`` of the rows that have any; other texts stay where they are."""
    per_row = cut(spans.groupBy("k").agg(F.collect_set("span").alias("spans")))
    return restrict(rows, per_row.select("k"), "k").join(per_row, "k").select("k", "text", "spans")


def _covered(blocks: DataFrame, length: int) -> DataFrame:
    at, near, far = F.shiftright("span", 20), F.shiftright("span", 10).bitwiseAND(1023), \
        F.col("span").bitwiseAND(1023)
    return blocks.select("k", (at - far).alias("first"), (at - near + length).alias("end"))


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM,
                   blocks: tuple[int, ...] = BLOCKS) -> DataFrame:
    """``k, spans``: byte ranges (first, end) to remove, by row key; ranges may overlap."""
    rows = _keyed(docs)
    copies = cut(rows.select(F.xxhash64("text").alias("t"), "k", F.octet_length("text").alias("n"))
                 .where(F.col("n") >= length))
    # written before it is joined, so that a text with very many copies can be split
    same = cut(copies.groupBy("t").agg(F.count("*").alias("c"), F.min("k").alias("one")).where("c > 1"))
    copied = cut(copies.join(same, "t").select("k", "one", F.col("n").cast("long").alias("end")).distinct())
    one_each = restrict(rows, cut(copied.where("k <> one").select("k").distinct()), "k", "left_anti")
    found = copied.select("k", F.lit(0).cast("long").alias("first"), "end")
    with contextlib.ExitStack() as tables:
        anchors = tables.enter_context(written(_anchors(one_each, length, gram)))
        shared = cut(anchors.groupBy("bucket").count().where("count > 1").select("bucket"))
        open_ = anchors.join(shared, "bucket").select("k", "span")
        for block in blocks:
            level = tables.enter_context(written(_refined(_with_spans(one_each, open_), length, block)))
            classes = cut(level.groupBy("core", "hull").agg(
                F.count("*").alias("c"), F.min(F.struct("k", "span")).alias("one")))
            whole = level.join(classes.where("c > 1").select("core", "hull"), ["core", "hull"])
            found = found.unionByName(_covered(whole, length))
            mixed = (classes.groupBy("core").agg(F.count("*").alias("hulls"), F.min("c").alias("least"))
                     .where("hulls > 1 and least = 1").select("core"))
            open_ = classes.join(mixed, "core").select("one.*")
        return cut(found.groupBy("k").agg(F.collect_set(F.struct("first", "end")).alias("spans")))


def remove_repeats(docs: DataFrame, length: int = LENGTH, **kwargs) -> DataFrame:
    """``k, doc_id, n_bytes, spans, kept``: the maximal removed runs of each text (start and
    end in bytes) and the bytes that are left; ``k`` is the row key of id and text."""
    if length - kwargs.get("gram", GRAM) > DISTANCE:
        raise ValueError(f"a window may reach at most {DISTANCE} bytes beyond its gram: raise gram with length")
    rows = _keyed(docs)
    spans = repeated_spans(docs, length, **kwargs)
    keys = spans.select("k")
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    schema = pa.schema([("k", pa.int64()), ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("spans", span_type),
                        ("kept", pa.binary())])

    def run(it):
        for b, data, off in byte_runs(it):
            out = []
            for i, (k, doc, found) in enumerate(zip(*(b.column(c).to_pylist() for c in (0, 2, 3)))):
                text = data[off[i]:off[i + 1]]
                gone = np.zeros(len(text) + 1, np.int64)
                np.add.at(gone, [s["first"] for s in found], 1)
                np.add.at(gone, [s["end"] for s in found], -1)
                gone = np.cumsum(gone) > 0
                edge = np.flatnonzero(np.diff(np.concatenate(([0], gone[:-1].astype(np.int8), [0]))))
                runs = [{"start": int(s), "end": int(e)} for s, e in zip(edge[::2], edge[1::2])]
                out.append((k, doc, len(text), runs, text[~gone[:-1]].tobytes()))
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    ddl = "k long, doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary"
    touched = (restrict(rows, keys, "k").join(spans, "k")
               .select("k", "text", "doc_id", "spans").mapInArrow(tidy(run), ddl))
    rest = restrict(rows, keys, "k", "left_anti").select(
        "k", "doc_id", F.octet_length("text").cast("long").alias("n_bytes"),
        F.array().cast("array<struct<start:long,end:long>>").alias("spans"),
        F.col("text").cast("binary").alias("kept"))
    return touched.unionByName(rest)


# ---- passages of many words -------------------------------------------------------------------

WORDS, WORD_GRAM = 51, 16
_SPACE = byte_set((0x20, 0x20), (0x09, 0x0D))


def _word_run(data: np.ndarray, off: np.ndarray, powers: Powers):
    """(prefix sums over word hashes, first word of each document) of a run of texts."""
    start, end, doc = word_spans(~_SPACE[data], off)
    words = span_hashes(prefix_sums(data, powers), start, end, powers)
    up, _ = powers.take(len(words) + 1)
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * up[:len(words)], out=sums[1:])
    return sums, np.searchsorted(doc, np.arange(len(off)))


def _word_anchors(rows: DataFrame, words: int, gram: int) -> DataFrame:
    """``bucket, k, first, last``: word grams and the windows of each text that they represent."""
    schema = pa.schema([(c, pa.int64()) for c in ("bucket", "k", "first", "last")])

    def run(it):
        powers = Powers()
        for b, data, off in byte_runs(it):
            sums, bounds = _word_run(data, off, powers)
            if len(sums) <= words:
                continue
            _, down = powers.take(len(sums))
            n = len(sums) - gram
            order = mix64((sums[gram:] - sums[:-gram]) * down[:n])
            at, first, last = leaders(order, bounds, words, gram)
            doc = np.searchsorted(bounds, at, "right") - 1
            k = b.column(0).to_numpy(zero_copy_only=False)
            yield pa.record_batch([pa.array(x) for x in (
                order[at].view(np.int64), k[doc], first - bounds[doc], last - bounds[doc])], schema=schema)

    return rows.select("k", "text").mapInArrow(tidy(run), "bucket long, k long, first long, last long")


def _word_windows(rows: DataFrame, words: int) -> DataFrame:
    """``h, k, w``: hash of every window that ``spans`` (first, last) of a text lists."""
    schema = pa.schema([(c, pa.int64()) for c in ("h", "k", "w")])

    def run(it):
        powers = Powers()
        for b, data, off in byte_runs(it):
            sums, bounds = _word_run(data, off, powers)
            _, down = powers.take(len(sums))
            lists = b.column(2)
            doc = np.repeat(np.arange(b.num_rows), np.diff(lists.offsets.to_numpy()))
            spans = lists.flatten()
            first, last = (spans.field(c).to_numpy(zero_copy_only=False) for c in ("first", "last"))
            many = last - first + 1
            row = np.repeat(np.arange(len(many)), many)
            w = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many) + first[row]
            at = w + bounds[doc[row]]
            h = mix64((sums[at + words] - sums[at]) * down[at])
            k = b.column(0).to_numpy(zero_copy_only=False)
            yield pa.record_batch([pa.array(h.view(np.int64)), pa.array(k[doc[row]]), pa.array(w)], schema=schema)

    return rows.select("k", "text", "spans").mapInArrow(tidy(run), "h long, k long, w long")


def shared_passages(docs: DataFrame, words: int = WORDS, gram: int = WORD_GRAM) -> DataFrame:
    """``k, n_passages``: maximal passages of at least ``words`` words of a document (by row key) that
    stand in another document too; a text with copies is one such passage.  No row for none."""
    rows = _keyed(docs)
    copies = rows.select(F.xxhash64("text").alias("t"), "k", "text").where(F.octet_length("text") >= 2 * words - 1)
    same = cut(copies.groupBy("t").agg(F.count("*").alias("c"), F.min("k").alias("one")).where("c > 1"))
    long = F.size(F.split(F.regexp_replace("text", "^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$", ""),
                          "[\\x20\\x09-\\x0D]+")) >= words
    copied = cut(lookup(copies, same, ["t"], "c").select("k", "one", long.alias("long")).distinct())
    one_each = restrict(rows, cut(copied.where("k <> one").select("k").distinct()), "k", "left_anti")
    with contextlib.ExitStack() as tables:
        anchors = tables.enter_context(written(_word_anchors(one_each, words, gram)))
        buckets = cut(anchors.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1"))
        open_ = lookup(anchors, buckets, ["bucket"], "n")
        spans = cut(open_.groupBy("k").agg(F.collect_set(F.struct("first", "last")).alias("spans")))
        texts_ = restrict(one_each, spans.select("k"), "k").join(spans, "k").select("k", "text", "spans")
        windows = tables.enter_context(written(_word_windows(texts_, words)))
        met = cut(windows.groupBy("h").agg(F.min("k").alias("a"), F.max("k").alias("b"), F.count("*").alias("n"))
                  .where("a <> b").select("h", "n"))
        held = lookup(windows, met, ["h"], "n").groupBy("k").agg(F.collect_set("w").alias("w"))
        starts = F.array_except("w", F.transform("w", lambda w: w + 1))      # windows that follow none
        counts = held.select("k", F.size(starts).cast("long").alias("n_passages"))
        whole = copied.where("long").select("k", F.lit(1).cast("long").alias("n_passages"))
        return cut(counts.unionByName(whole).groupBy("k").agg(F.min("n_passages").alias("n_passages")))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    docs = table(spark, sf_dir, "documents")
    passages = shared_passages(docs)
    out = cut(remove_repeats(docs).select(
        "k", "doc_id", "n_bytes", removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")))
    if passages.count() <= BROADCAST_IDS:
        passages = F.broadcast(passages)
    return out.join(passages, "k", "left").select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256",
        F.coalesce("n_passages", F.lit(0).cast("long")).alias("n_passages"))


QUERIES = {"op10_suffix_dedup": op10_suffix_dedup}
