"""Ranked lexical search by dual-tree traversal: the best documents for every item, exactly.

A document is a sparse vector over the items' terms; its coordinate for a term is what the
term adds to a score, so an item's score is the sum of the document's coordinates over
the item's terms.  All numbers are 64-bit integers.

* Statistics: one pass over the texts writes each document's length and its counts of
  the items' terms (texts are not read again); document frequencies, the number of
  documents and of terms are aggregates over that table.
* Hierarchies: items, and the documents of every slice of that table, are split again and
  again by the term that stands in about half of them.  A node holds the coordinate
  maxima of its members: the union of terms for items, the largest coordinates for
  documents.  Their product bounds the score of every pair below two nodes.
* Search: node pairs whose bound is under the weakest k-th score of the item node's
  items are dropped as a whole, otherwise the larger node is split; pairs of leaves are
  scored in full.  First every item dives to its most promising leaf of every slice;
  the k-th best of all these scores is a lower bound that all tasks start the full search
  with.  Equal bounds are followed, so ties are exact.

Items are searched in blocks of about ``BLOCK_TERMS`` terms (an item is never cut), and a
task holds one slice of ``SLICE`` documents at a time.  A vocabulary of more than ``bound``
terms is joined with a shuffle instead of being broadcast.

Defined results: a null or term-free text is not found and finds nothing, and a document without
terms does not count in the statistics; documents that share an id are ranked each for
itself; a null doc_id ranks after the others among equal scores; every row of the items is an
item of its own, also with an equal or null id; empty tables give no rows; further columns
are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orchard.llm.common import BROADCAST_IDS, byte_runs, cut, table, texts, tidy, written
from orchard.llm.hot import lookup
from orchard.llm.wordbytes import as_strings, byte_set, counted, words_of

TOP = 10
TERM = byte_set((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
BLOCK_TERMS = 100_000       # terms, with repeats over items, that are searched in one pass
SLICE = 1_024               # documents in a tree
LEAF_DOCS, LEAF_ITEMS = 32, 8
_NO_ID = np.iinfo(np.int64).max


def _terms(rows: DataFrame) -> DataFrame:
    """``row, doc_id, n, term, tf``: the distinct terms of every text with their counts; ``row`` numbers
    the texts that have terms."""
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()), ("term", pa.string()),
                        ("tf", pa.int64())])

    def run(it):
        row = TaskContext.get().partitionId() << 33
        for b, data, off in byte_runs(it):
            words, _, _, doc = words_of(data, off, TERM)
            if not len(words):
                continue
            coded = words.dictionary_encode()
            codes, size = coded.indices.to_numpy(), len(coded.dictionary)
            key, tf = counted(doc * size + codes)
            doc_of = key // size
            n = np.bincount(doc, minlength=b.num_rows)
            yield pa.record_batch([pa.array(row + doc_of), b.column(0).take(pa.array(doc_of)), pa.array(n[doc_of]),
                                   coded.dictionary.take(pa.array(key % size)), pa.array(tf)], schema=schema)
            row += b.num_rows

    return rows.select("doc_id", "text").mapInArrow(
        tidy(run), "row long, doc_id long, n long, term string, tf long")


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``item, item_id, term``: every row of the items that has terms, under a number of its own."""
    terms = _terms(texts(items, id_col, text_col))
    return cut(terms.select(F.col("row").alias("item"), F.col("doc_id").alias("item_id"), "term"))


_VECTOR = "doc_id long, n long, terms array<long>, tfs array<long>"


def vectors(docs: DataFrame, vocabulary: DataFrame, bound: int = BROADCAST_IDS) -> DataFrame:
    """``doc_id, n, terms, tfs`` of every document that has any term: counts of the terms that
    ``vocabulary`` (cut; ``term, id, items``) holds."""
    if vocabulary.count() > bound:
        # hot terms are those of many documents, which their counts in the items do not tell
        rows = _terms(docs)
        weight = rows.groupBy("term").agg(F.count("*").alias("docs"))
        known = lookup(rows, cut(vocabulary.select("term", "id").join(weight, "term")), ["term"], "docs", "left", bound)
        met = F.col("id").isNotNull()
        pairs = F.collect_list(F.when(met, F.struct("id", "tf")))
        return (known.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.first("n").alias("n"), pairs.alias("p"))
                .select("doc_id", "n", F.col("p.id").alias("terms"), F.col("p.tf").alias("tfs")))
    listed = vocabulary.select("term", "id").toPandas()
    spark = docs.sparkSession
    shipped = spark.sparkContext.broadcast((listed["term"].tolist(), listed["id"].to_numpy(np.int64)))
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int64())),
                        ("tfs", pa.list_(pa.int64()))])

    def run(it):
        names, ids = shipped.value
        names = as_strings(names)
        for b, data, off in byte_runs(it):
            words, _, _, doc = words_of(data, off, TERM)
            n = np.bincount(doc, minlength=b.num_rows)
            coded = words.dictionary_encode()
            place = pc.fill_null(pc.index_in(coded.dictionary, value_set=names), -1).to_numpy(zero_copy_only=False)
            place = place[coded.indices.to_numpy()].astype(np.int64) if len(words) else np.empty(0, np.int64)
            known = place >= 0
            key, tf = counted(doc[known] * max(len(ids), 1) + place[known])
            doc_of, term = key // max(len(ids), 1), ids[key % max(len(ids), 1)] if len(ids) else key
            at = np.searchsorted(doc_of, np.arange(b.num_rows + 1)).astype(np.int32)
            rows = pa.record_batch([b.column(0), pa.array(n), pa.ListArray.from_arrays(pa.array(at), pa.array(term)),
                                    pa.ListArray.from_arrays(pa.array(at), pa.array(tf))], schema=schema)
            yield rows.filter(pa.array(n > 0))

    return docs.select("doc_id", "text").mapInArrow(tidy(run), _VECTOR)


class _Node:
    __slots__ = ("rows", "children", "terms", "maxima")

    def __init__(self, rows):
        self.rows, self.children, self.terms, self.maxima = rows, None, None, None


def _hierarchy(ptr: np.ndarray, terms: np.ndarray, rows: np.ndarray, leaf: int, size: int) -> _Node:
    """Binary tree over ``rows`` (their terms are terms[ptr[r]:ptr[r + 1]]): each node is split by
    the term that stands in about half of its rows, or in the middle where no term splits it."""
    root = _Node(rows)
    open_ = [root]
    while open_:
        node = open_.pop()
        if len(node.rows) <= leaf:
            continue
        count = ptr[node.rows + 1] - ptr[node.rows]
        owner = np.repeat(np.arange(len(node.rows)), count)
        at = np.repeat(ptr[node.rows] - np.cumsum(count) + count, count) + np.arange(len(owner))
        found = np.bincount(terms[at], minlength=size) if len(at) else np.zeros(1, np.int64)
        best = int(np.argmin(np.abs(2 * found - len(node.rows))))
        side = np.zeros(len(node.rows), bool)
        if 0 < found[best] < len(node.rows):
            side[owner[terms[at] == best]] = True
        else:
            side[:len(side) // 2] = True
        node.children = [_Node(node.rows[side]), _Node(node.rows[~side])]
        open_ += node.children
    return root


def _walk(node: _Node):
    """Children before parents."""
    order, open_ = [], [node]
    while open_:
        order.append(open_.pop())
        open_ += order[-1].children or []
    return reversed(order)


class Items:
    """A block of items: their terms (numbers of the block's own), hierarchy and best documents."""

    def __init__(self, ptr: np.ndarray, terms: np.ndarray, weights: np.ndarray, floor: np.ndarray, k: int):
        self.ptr, self.terms, self.weights, self.k = ptr, terms, weights, k
        self.n, self.size = len(ptr) - 1, len(weights)
        self.least = np.maximum(floor, 1)       # what a document must score to matter, by item
        self.best = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in range(self.n)]
        self.root = _hierarchy(ptr, terms, np.arange(self.n), LEAF_ITEMS, self.size)
        for node in _walk(self.root):
            node.terms = (np.unique(np.concatenate([c.terms for c in node.children])) if node.children else
                          np.unique(np.concatenate([terms[ptr[r]:ptr[r + 1]] for r in node.rows])))

    def offer(self, item: int, score: np.ndarray, doc: np.ndarray) -> None:
        score, doc = np.append(self.best[item][0], score), np.append(self.best[item][1], doc)
        order = np.lexsort((doc, -score))[:self.k]
        self.best[item] = score[order], doc[order]
        if len(order) == self.k:
            self.least[item] = max(self.least[item], score[order[-1]])


class Documents:
    """A slice of documents: coordinates, hierarchy and coordinate maxima of its nodes."""

    def __init__(self, ids: np.ndarray, ptr: np.ndarray, terms: np.ndarray, values: np.ndarray, size: int):
        self.ids, self.ptr, self.terms, self.values = ids, ptr, terms, values
        self.root = _hierarchy(ptr, terms, np.arange(len(ids)), LEAF_DOCS, size)
        for node in _walk(self.root):
            if node.children:
                node.maxima = np.maximum(node.children[0].maxima, node.children[1].maxima)
            else:
                node.maxima = np.zeros(size, np.int64)
                for r in node.rows:
                    own = slice(ptr[r], ptr[r + 1])
                    node.maxima[terms[own]] = np.maximum(node.maxima[terms[own]], values[own])

    def score(self, items: Items, leaf: _Node, rows: np.ndarray) -> None:
        """Full scores of a leaf's documents for the items ``rows``."""
        count = self.ptr[leaf.rows + 1] - self.ptr[leaf.rows]
        held = leaf.rows[count > 0]
        if not len(held):
            return
        count = count[count > 0]
        starts = np.cumsum(count) - count
        at = np.repeat(self.ptr[held] - starts, count) + np.arange(count.sum())
        terms, values = self.terms[at], self.values[at]
        asked = np.zeros((len(rows), items.size), bool)
        for j, i in enumerate(rows):
            asked[j, items.terms[items.ptr[i]:items.ptr[i + 1]]] = True
        score = np.add.reduceat(asked[:, terms] * values, starts, axis=1)
        for j, i in enumerate(rows):
            good = score[j] >= items.least[i]
            if good.any():
                items.offer(i, score[j][good], self.ids[held[good]])


def dive(items: Items, docs: Documents) -> None:
    """Score every item leaf against the document leaf that greedy descent finds."""
    for node in _walk(items.root):
        if node.children:
            continue
        at = docs.root
        while at.children:
            at = max(at.children, key=lambda c: c.maxima[node.terms].sum())
        docs.score(items, at, node.rows)


def traverse(items: Items, docs: Documents) -> int:
    """Score all pairs that can still matter; returns the number of node pairs looked at."""
    seen, open_ = 0, [(items.root, docs.root)]
    while open_:
        i, d = open_.pop()
        seen += 1
        bound = int(d.maxima[i.terms].sum())
        if bound < items.least[i.rows].min():
            continue
        if not i.children and not d.children:
            docs.score(items, d, i.rows)
        elif i.children and (not d.children or len(i.rows) * LEAF_DOCS >= len(d.rows) * LEAF_ITEMS):
            open_ += [(c, d) for c in i.children]
        else:                               # the more promising half is on top
            open_ += [(i, c) for c in sorted(d.children, key=lambda c: c.maxima[i.terms].sum())]
    return seen


def _search(vecs: DataFrame, block: dict, n_docs: int, n_terms: int, k: int, full: bool) -> DataFrame:
    """``item, doc_id, score``: every task's best documents of its part, at most k an item."""
    shipped = vecs.sparkSession.sparkContext.broadcast(block)
    schema = pa.schema([("item", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def run(it):
        blk = shipped.value
        items = Items(blk["ptr"], blk["terms"], blk["weights"], blk["floor"].copy(), k)
        for b in it:
            for lo in range(0, b.num_rows, SLICE):
                part = b.slice(lo, SLICE)
                ids = pc.fill_null(part.column(0), _NO_ID).to_numpy(zero_copy_only=False)
                n = part.column(1).to_numpy(zero_copy_only=False)
                lists = part.column(2)
                doc = np.repeat(np.arange(len(n)), np.diff(lists.offsets.to_numpy()))
                term = lists.flatten().to_numpy(zero_copy_only=False)
                tf = part.column(3).flatten().to_numpy(zero_copy_only=False)
                place = np.minimum(np.searchsorted(blk["ids"], term), len(blk["ids"]) - 1)
                known = blk["ids"][place] == term
                doc, place, tf = doc[known], place[known], tf[known]
                m = 100 - 90 + (90 * n * n_docs) // n_terms
                value = blk["weights"][place] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc]))
                ptr = np.searchsorted(doc, np.arange(len(n) + 1))
                docs = Documents(ids, ptr, place, value, items.size)
                (traverse if full else dive)(items, docs)
        for i, (score, doc) in enumerate(items.best):
            if len(score):
                yield pa.record_batch([pa.array(np.full(len(score), blk["items"][i])),
                                       pa.array(doc, mask=doc == _NO_ID), pa.array(score)], schema=schema)

    return vecs.mapInArrow(tidy(run), "item long, doc_id long, score long")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = TOP, id_col: str = "doc_id", text_col: str = "text",
           item_id: str = "item_id", item_text: str = "text", bound: int = BROADCAST_IDS,
           block_terms: int = BLOCK_TERMS) -> DataFrame:
    """``item_id, rank, doc_id, score``: each item's k highest-scoring documents."""
    asked = item_terms(items, item_id, item_text)
    vocabulary = cut(asked.groupBy("term").agg(F.count("*").alias("items"))
                     .withColumn("id", F.monotonically_increasing_id()))
    out = []
    with written(vectors(texts(docs, id_col, text_col), vocabulary, bound)) as vecs:
        n_docs, n_terms = vecs.agg(F.count("*"), F.sum("n")).first()
        df = vecs.select(F.explode("terms").alias("id")).groupBy("id").agg(F.count("*").alias("df"))
        weight = F.floor(1000 * F.log((2 * F.lit(n_docs) + 2) / (2 * F.col("df") + 1))).cast("long")
        known = vocabulary.join(df, "id").select("term", "id", weight.alias("w"))
        held = cut(asked.join(known, "term").select("item", "id", "w"))
        blocks = max(1, math.ceil(held.count() / block_terms)) if n_docs else 0
        dealt = held.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(blocks))) if blocks else held
        for number in range(blocks):
            own = dealt.where(F.col("block") == number).select("item", "id", "w").toPandas()
            if not len(own):
                continue
            own = own.sort_values(["item", "id"])
            names, at = np.unique(own["item"].to_numpy(np.int64), return_index=True)
            ids, first, place = np.unique(own["id"].to_numpy(np.int64), return_index=True, return_inverse=True)
            block = {"items": names, "ptr": np.append(at, len(own)), "terms": place, "ids": ids,
                     "weights": own["w"].to_numpy(np.int64)[first], "floor": np.zeros(len(names), np.int64)}
            seeds = _ranked(_search(vecs, block, n_docs, n_terms, k, False), k)
            floor = seeds.where(F.col("rank") == k).select("item", "score").toPandas()
            floor = pd.Series(floor["score"].to_numpy(np.int64), floor["item"].to_numpy(np.int64))
            block["floor"] = floor.reindex(names, fill_value=0).to_numpy(np.int64)
            out.append(cut(_ranked(_search(vecs, block, n_docs, n_terms, k, True), k)))
    if not out:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    found = out[0]
    for more in out[1:]:
        found = found.unionByName(more)
    names = asked.select("item", "item_id").distinct()
    return found.join(names, "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_SQL_TERMS = r"""unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))"""

OP13_SQL = f"""
WITH words AS (SELECT doc_id, {_SQL_TERMS} AS term FROM documents),
tfs AS (SELECT doc_id, term, count(*)::BIGINT AS tf FROM words GROUP BY ALL),
lens AS (SELECT doc_id, count(*)::BIGINT AS n FROM words GROUP BY doc_id),
stats AS (SELECT count(*)::BIGINT AS nd, sum(n)::BIGINT AS nt FROM lens),
asked AS (SELECT DISTINCT item_id, {_SQL_TERMS} AS term FROM benchmark),
weights AS (SELECT term, floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
            FROM tfs, stats GROUP BY term, nd),
m AS (SELECT doc_id, 100 - 90 + (90 * n * nd) // nt AS m FROM lens, stats),
scores AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
           FROM asked JOIN tfs USING (term) JOIN weights USING (term) JOIN m USING (doc_id) GROUP BY ALL),
ranked AS (SELECT item_id, doc_id, score,
                  row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank
           FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= {TOP}
"""

QUERIES = {"op13_lexical_search": op13_lexical_search}
ORACLE = {"op13_lexical_search": OP13_SQL}
