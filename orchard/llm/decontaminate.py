"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

Texts and benchmark items are compared with A-Z and the accented Latin-1 capitals
lower-cased and white space collapsed.  An item of m bytes that occurs in a text with at most k edits shares
at least (m - q + 1) - k q of its q-grams with it, all on diagonals that lie
within k of each other.  So shared q-grams are counted in overlapping bands of
diagonals (each at least 2 k + 1 wide, and starting halfway into the one before);
bands that reach the bound are kept, and a banded alignment of the whole item
against that region finds its least number of edits and its place.

The edit budget is ``edit_rate * m``, lowered for short items so that the bound
stays at least 1.  Benchmark items are indexed in blocks of bounded size; a
larger benchmark takes several scans of the documents.

Defined results: null or empty texts and items match nothing, nor do items of
fewer than q bytes; a repeated row or item is reported for each repetition; an
empty table gives no rows; extra columns are ignored; a null id is kept as null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orchard.llm.common import byte_batches, cut, restrict, table, texts, tidy

Q = 8
EDIT_RATE = 0.1
BLOCK_BYTES = 8_000_000     # benchmark text indexed at a time
REGIONS = 500               # regions aligned at a time
_FILTER_BITS = 22

# byte -> its folded form: A-Z to a-z, white space to a blank
_FOLD = np.array([32 if b == 32 or 9 <= b <= 13 else b + 32 if 65 <= b <= 90 else b
                  for b in range(256)], np.uint8)


def fold(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Folded bytes with runs of blanks as one, their offsets, and the source position of each."""
    low = _FOLD[data]
    latin = np.flatnonzero(data[:-1] == 0xC3) + 1       # two-byte capitals, except the times sign
    b = data[latin]
    latin = latin[(b >= 0x80) & (b <= 0x9E) & (b != 0x97)]
    low[latin] += 32
    drop = np.zeros(len(low), bool)
    drop[1:] = (low[1:] == 32) & (low[:-1] == 32)
    drop[offsets[:-1][offsets[:-1] < len(low)]] = False
    at = np.flatnonzero(~drop)
    return low[at], np.searchsorted(at, offsets), at


def gram_codes(low: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on, as one number (exact, not a hash)."""
    code = low.astype(np.uint64)
    for width in (1, 2, 4):
        code = (code[:-width] << np.uint64(8 * width)) | code[width:] if len(code) > width else code[:0]
    return code


def edit_budget(m: int, rate: float, q: int = Q) -> int:
    """Edits allowed for an item of m bytes: at least one shared q-gram must remain certain."""
    return max(0, min(int(rate * m), (m - q) // q))


class BenchmarkIndex:
    """Postings of the q-grams of a block of items."""

    def __init__(self, items: list[tuple[int, bytes]], rate: float):
        self.ids, self.low = [], []
        for item, text in items:
            raw = np.frombuffer(text, np.uint8)
            low, _, _ = fold(raw, np.array([0, len(raw)]))
            low = np.frombuffer(low.tobytes().strip(b" "), np.uint8)
            if len(low) >= Q:
                self.ids.append(item)
                self.low.append(low)
        self.size = np.array([len(x) for x in self.low], np.int64)
        self.budget = np.array([edit_budget(len(x), rate) for x in self.low], np.int64)
        self.needed = self.size - Q + 1 - self.budget * Q
        self.width = 2 * self.budget + 1
        codes = [gram_codes(x) for x in self.low]
        code = np.concatenate(codes) if codes else np.empty(0, np.uint64)
        item = np.repeat(np.arange(len(codes)), [len(c) for c in codes])
        pos = np.concatenate([np.arange(len(c)) for c in codes]) if codes else np.empty(0, np.int64)
        order = np.argsort(code, kind="stable")
        self.item, self.pos = item[order], pos[order]
        self.code, first = np.unique(code[order], return_index=True)
        self.first = np.append(first, len(code))
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        self.filter[self._slot(self.code)] = True

    @staticmethod
    def _slot(code: np.ndarray) -> np.ndarray:
        return ((code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)

    def regions(self, low: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Document, item and lowest diagonal of the band pairs that reach the bound."""
        none = np.empty(0, np.int64)
        code = gram_codes(low)
        at = np.flatnonzero(self.filter[self._slot(code)]) if len(code) and len(self.code) else []
        if not len(at):
            return none, none, none
        k = np.searchsorted(self.code, code[at])
        k[k == len(self.code)] = 0
        hit = self.code[k] == code[at]
        at, k = at[hit], k[hit]
        doc = np.searchsorted(offsets, at, "right") - 1
        inside = at + Q <= offsets[doc + 1]
        at, k, doc = at[inside], k[inside], doc[inside]
        if not len(at):
            return none, none, none
        many = self.first[k + 1] - self.first[k]
        post = np.repeat(self.first[k] - np.cumsum(many) + many, many) + np.arange(many.sum())
        item, pos = self.item[post], self.pos[post]
        doc, at = np.repeat(doc, many), np.repeat(at, many)
        diagonal = at - offsets[doc] - pos                 # from -m up
        shift = int(self.size.max())
        band = (diagonal + shift) // self.width[item]
        bands = int(band.max()) + 2
        key, count = np.unique((doc * len(self.ids) + item) * bands + band, return_counts=True)
        after = np.zeros_like(count)
        follows = np.flatnonzero(key[1:] == key[:-1] + 1)
        after[follows] = count[follows + 1]
        item, b = key // bands % len(self.ids), key % bands
        # a band together with the next one
        good = count + after >= self.needed[item]
        lowest = b[good] * self.width[item[good]] - shift
        return key[good] // bands // len(self.ids), item[good], lowest


def banded_alignments(index: BenchmarkIndex, low: np.ndarray, offsets: np.ndarray, doc: np.ndarray,
                      item: np.ndarray, lowest: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
    """(document, item, edits, start, end) of the best occurrence of each whole item whose path
    keeps to the diagonals of its two bands, widened by the edit budget; none beyond the budget.
    Among equal edits the first end, then the latest start.  All regions advance together,
    one item byte at a time, and leave when no cell is within their budget."""
    size, budget = index.size[item], index.budget[item]
    lo = lowest - budget                                    # diagonal of column 0
    wide = 2 * index.width[item] + 2 * budget
    col, rows = np.arange(int(wide.max())), int(size.max())
    base, none = 1 << 40, 1 << 60
    length = offsets[doc + 1] - offsets[doc]
    at = lo[:, None] + np.arange(len(col) + rows)
    ok = (at >= 0) & (at < length[:, None])
    text = np.where(ok, low[np.where(ok, at + offsets[doc][:, None], 0)], 256).astype(np.int16)
    pattern = np.zeros((len(item), rows), np.int16)
    for i, t in enumerate(item):
        pattern[i, :size[i]] = index.low[t]
    # cost and start in one number: less cost first, then the later start
    edge = lo[:, None] + col
    valid = (edge >= 0) & (edge <= length[:, None]) & (col < wide[:, None])
    state = np.where(valid, -edge, none)
    live = np.arange(len(item))
    for r in range(rows):
        best = state + (text[live, r:r + len(col)] != pattern[live, r][:, None]) * base
        best[:, :-1] = np.minimum(best[:, :-1], state[:, 1:] + base)
        best = np.minimum.accumulate(best - col * base, axis=1) + col * base
        edge = lo[live][:, None] + r + 1 + col
        valid = (edge >= 0) & (edge <= length[live][:, None]) & (col < wide[live][:, None])
        state = np.where(valid, best, none)
        for i in np.flatnonzero(size[live] == r + 1):
            c, k = live[i], int(np.argmin(-(-state[i] // base)))
            edits = int(-(-state[i, k] // base))
            if edits <= budget[c]:
                yield (int(doc[c]), int(item[c]), edits, int(edits * base - state[i, k]),
                       int(lo[c] + r + 1 + k))
        stay = (size[live] > r + 1) & (state.min(axis=1) <= budget[live] * base)
        live, state = live[stay], state[stay]
        if not len(live):
            return


def find_matches(docs: DataFrame, benchmark: DataFrame, edit_rate: float = EDIT_RATE,
                 block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, item_id, start, end, edits``: where benchmark items occur in texts.

    ``start`` and ``end`` count characters of the text.  Of overlapping
    occurrences of one item in a text the one with the fewest edits is kept.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"),
                             F.encode(F.col("text").cast("string"), "UTF-8").alias("text")) \
        .where("text is not null and length(text) > 0")
    total = items.agg(F.sum(F.length("text").cast("long")).alias("n")).head()["n"] or 0
    blocks = max(1, -(-total // block_bytes))
    docs = texts(docs)
    ddl = "doc_id long, item_id long, start long, end long, edits int"
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("start", pa.int64()),
                        ("end", pa.int64()), ("edits", pa.int32())])
    out = spark.createDataFrame([], ddl)
    for k in range(blocks):
        block = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k) \
            .orderBy("item_id", "text").collect()
        held = spark.sparkContext.broadcast([(r["item_id"], bytes(r["text"])) for r in block])

        def run(it, held=held):
            index = BenchmarkIndex(held.value, edit_rate)
            for ids, data, off in byte_batches(it):
                low, loff, at = fold(data, off)
                found: dict[tuple[int, int], list] = {}
                regions = index.regions(low, loff)
                for i in range(0, len(regions[0]), REGIONS):
                    for d, t, *hit in banded_alignments(index, low, loff,
                                                        *(x[i:i + REGIONS] for x in regions)):
                        found.setdefault((d, t), []).append(tuple(hit))
                rows = []
                for (d, t), hits in found.items():
                    taken: list[tuple[int, int]] = []
                    for edits, s, e in sorted(set(hits)):
                        if all(e <= a or s >= b for a, b in taken):
                            taken.append((s, e))
                            # folded positions -> bytes of the text -> characters
                            a = int(at[loff[d] + s] - off[d])
                            b = int(at[loff[d] + e - 1] - off[d]) + 1
                            raw = data[off[d]:off[d + 1]]
                            begins = (raw & 0xC0) != 0x80
                            rows.append((ids[d], index.ids[t], int(begins[:a].sum()),
                                         int(begins[:b].sum()), edits))
                if rows:
                    yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)],
                                          schema=schema)

        out = out.unionByName(docs.mapInArrow(tidy(run), ddl))
    return out


def clean(docs: DataFrame, benchmark: DataFrame, **kwargs) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item; columns as they are.
    Documents without an id stay."""
    bad = cut(find_matches(docs, benchmark, **kwargs).where("doc_id is not null")
              .select("doc_id").distinct())
    return restrict(docs, bad, "doc_id", "left_anti")


def op5_qgram_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {"op5_qgram_decontamination": op5_qgram_decontamination}
