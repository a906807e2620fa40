"""Best-fit packing of token sequences, certified by dual-feasible-function bounds.

Documents are tokenised and cut into pieces of at most ``capacity`` tokens.  Full
pieces are sequences of their own.  The others are dealt into partitions of
bounded size and packed there best-fit decreasing.  For each partition
dual-feasible functions give a lower bound on its number of sequences.  A
partition that meets its bound is certified and stays as it is; the partitions
with a gap put the documents of their unfilled sequences into a common pool,
which is dealt anew and packed again, until no gap is left or an exchange saves
nothing.  Only piece lengths are shuffled, never tokens.

Defined results: a null or empty text is the end token alone (one piece of one
token); repeated rows and equal ids are packed as separate documents; an empty
table gives no rows; extra columns are ignored; a null doc_id is kept as null.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orchard.llm.common import (Powers, byte_batches, cut, prefix_sums, span_hashes, table, texts,
                                tidy, word_spans)

CAPACITY = 2048
PARTITION_PIECES = 32_768   # pieces packed in one task
MAX_EXCHANGES = 4
_TAIL = ",.!&%$*#|"         # stripped from a word before it is looked up
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
_CACHE_WORDS = 250_000      # words remembered at a time by one task
RUN_BYTES = 400_000         # text encoded at a time; its hashes and sums take some fifty times that


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


class _Numbers(dict):
    """Numbers keys in the order in which they are first asked for."""

    def __missing__(self, key: str) -> int:
        n = self[key] = len(self)
        return n


class _Encoder:
    """Token ids of texts, each distinct word encoded once.

    The vocabulary's pre-tokeniser always splits at blanks, and punctuation that
    follows a run of letters never joins it.  So a text's ids are those of its
    words in turn, and a word's ids those of its stem and of its tail; stems and
    tails are the atoms that are encoded.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        vocab = self.tok.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        for token, i in vocab.items():
            self.ends[i] = token.endswith("</w>")
        self.powers = Powers()
        self.clear()

    def clear(self) -> None:
        self.atoms = _Numbers()
        self.keys, self.number = np.empty(0, np.uint64), np.empty(0, np.int64)  # words by hash
        self.parts = np.empty((0, 2), np.int64)             # atoms of each word
        self.flat, self.off = np.empty(0, np.uint32), np.zeros(1, np.int64)
        self._add([""])

    def _each(self, words: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tok.encode_batch_fast(words, add_special_tokens=False)]

    def _add(self, atoms: list[str]) -> None:
        """Encode new atoms.  Those of letters alone go many to a call, split where a word ends."""
        flat, sizes = [], []
        for plain, group in itertools.groupby(atoms, str.isalpha):
            group = list(group)
            for i in range(0, len(group), 200):
                part = group[i:i + 200]
                if plain:
                    ids = np.array(self._each([" ".join(part)])[0], np.uint32)
                    ends = np.flatnonzero(self.ends[ids]) + 1
                    if len(ends) == len(part) and ends[-1] == len(ids):
                        flat.append(ids)
                        sizes.append(np.diff(ends, prepend=0))
                        continue
                each = self._each(part)
                flat.append(np.fromiter(itertools.chain.from_iterable(each), np.uint32))
                sizes.append(np.fromiter(map(len, each), np.int64, len(each)))
        self.flat = np.concatenate([self.flat, *flat])
        self.off = np.concatenate((self.off, self.off[-1] + np.cumsum(np.concatenate(sizes))))
        for a in atoms:
            self.atoms[a]

    def _learn(self, new: list[str]) -> None:
        stems = [w.rstrip(_TAIL) for w in new]
        pairs = [(s, w[len(s):]) if s.isalpha() else (w, "") for w, s in zip(new, stems)]
        fresh = dict.fromkeys(a for p in pairs for a in p if a not in self.atoms)
        if fresh:
            self._add(sorted(fresh, key=str.isalpha))
        atom = self.atoms
        self.parts = np.concatenate((self.parts, np.array([(atom[a], atom[b]) for a, b in pairs],
                                                          np.int64).reshape(-1, 2)))

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
        """Token ids of each document of a run of texts."""
        if len(self.keys) > _CACHE_WORDS:
            self.clear()
        # the tokeniser lower-cases too, but looks for its special strings before that
        if not np.any((data[:-1] == 60) & (data[1:] == 124)):
            data = _LOWER[data]
        start, end, doc = word_spans((data != 32) & (data != 10), offsets)
        h = span_hashes(prefix_sums(data, self.powers), start, end, self.powers)
        keys, one, word = np.unique(h, return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == keys[inside]
        if not known.all():
            raw, new = data.tobytes(), one[~known]
            number = np.arange(len(self.parts), len(self.parts) + len(new))
            self._learn([raw[a:b].decode() for a, b in zip(start[new].tolist(), end[new].tolist())])
            self.keys = np.concatenate((self.keys, keys[~known]))
            self.number = np.concatenate((self.number, number))
            order = np.argsort(self.keys, kind="stable")
            self.keys, self.number = self.keys[order], self.number[order]
            at = np.searchsorted(self.keys, keys)
        a = self.parts[self.number[at][word]].ravel()
        size = self.off[a + 1] - self.off[a]
        until = np.append(0, np.cumsum(size))
        first = np.repeat(self.off[a] - until[:-1], size)
        tokens = self.flat[first + np.arange(len(first))]
        cuts = until[2 * np.searchsorted(doc, np.arange(len(offsets)))]
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            yield tokens[lo:hi]


def token_pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY,
                 end_id: int = 0, with_ids: bool = True) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32 (, ids)``: each document's token ids
    followed by ``end_id``, cut into pieces of at most ``capacity`` tokens.

    ``ids_crc32`` is the checksum of the piece's ids as little-endian 32-bit
    numbers; ``with_ids=False`` leaves the ids themselves out.
    """
    path = tokenizer or default_tokenizer()
    fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
              ("length", pa.int64()), ("ids_crc32", pa.int64())]
    if with_ids:
        fields.append(("ids", pa.list_(pa.int32())))
    schema = pa.schema(fields)
    ddl = "doc_id long, piece int, start long, length long, ids_crc32 long"

    def run(it):
        enc = _Encoder(path)
        for ids, data, off in byte_batches(it, RUN_BYTES):
            cols: list[list] = [[] for _ in fields]
            for doc, tokens in zip(ids, enc.encode(data, off)):
                seq = np.append(tokens, np.uint32(end_id))
                for k, lo in enumerate(range(0, len(seq), capacity)):
                    part = seq[lo:lo + capacity].astype("<u4")
                    row = (doc, k, lo, len(part), zlib.crc32(part.tobytes()), part.astype(np.int32))
                    for c, v in zip(cols, row):
                        c.append(v)
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

    return texts(docs).mapInArrow(tidy(run), ddl + (", ids array<int>" if with_ids else ""))


def bin_lower_bound(counts: np.ndarray, capacity: int = CAPACITY) -> int:
    """Fewest bins for ``counts[s]`` items of each size ``s``, by dual-feasible functions.

    A dual-feasible function maps any set of sizes that fits one bin to values
    of at most 1 in total, so the rounded-up total over all items is a bound.
    Used: the identity, thresholds (small sizes to 0, their complements to 1)
    and the rounding family floor((k+1)x/C)/k.
    """
    size = np.arange(len(counts), dtype=np.int64)
    n = counts.astype(np.int64)
    total = int((n * size).sum())
    best = -(-total // capacity)
    many, mass = np.cumsum(n[::-1])[::-1], np.cumsum(n * size)
    for t in range(1, capacity // 2 + 1):
        whole = int(many[capacity - t + 1]) if capacity - t + 1 < len(many) else 0
        inside = int(mass[min(capacity - t, len(mass) - 1)] - mass[t - 1])
        best = max(best, whole - (-inside // capacity))
        # sizes above half a bin cannot share one, those at least t fill what is left
        big = int(many[capacity // 2 + 1]) if capacity // 2 + 1 < len(many) else 0
        pairs = big - whole
        room = pairs * capacity - int(mass[min(capacity - t, len(mass) - 1)]
                                      - mass[min(capacity // 2, len(mass) - 1)])
        small = int(mass[min(capacity // 2, len(mass) - 1)] - mass[t - 1])
        best = max(best, big + max(0, -(-(small - room) // capacity)))
    for k in range(1, 40):
        scaled = (k + 1) * size
        value = np.where(scaled % capacity == 0, size * k, scaled // capacity * capacity)
        best = max(best, -(-int((n * value).sum()) // (capacity * k)))
    return int(best)


def best_fit_decreasing(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, int]:
    """Bin and offset of each length, longest first into the fullest bin that has room.

    Open bins are kept by their free room; a bit set of the rooms in use finds
    the smallest that suffices.
    """
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    used, n = 0, 0
    for i in np.argsort(-lengths, kind="stable"):
        size = int(lengths[i])
        fit = used >> size
        if fit:
            room = size + (fit & -fit).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                used &= ~(1 << room)
        else:
            room, b = capacity, n
            n += 1
        bins[i], offsets[i] = b, capacity - room
        if room > size:
            by_room[room - size].append(b)
            used |= 1 << (room - size)
    return bins, offsets, n


def _packer(capacity: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "uid"], ascending=[False, True], kind="stable")
        size = pdf["length"].to_numpy(np.int64)
        b, at, n = best_fit_decreasing(size, capacity)
        bound = bin_lower_bound(np.bincount(size, minlength=capacity + 1), capacity)
        fill = np.bincount(b, weights=size, minlength=n).astype(np.int64)
        return pd.DataFrame({"uid": pdf["uid"], "length": size, "part": pdf["part"], "bin": b,
                             "offset": at, "fill": fill[b], "gap": np.int64(n - bound)})
    return run


def _deal(pieces: DataFrame, n: int, salt: int, capacity: int, per_part: int) -> DataFrame:
    parts = max(1, -(-n // per_part))
    dealt = pieces.withColumn("part", F.pmod(F.xxhash64("uid", F.lit(salt)), F.lit(parts)))
    return dealt.groupBy("part").applyInPandas(
        tidy(_packer(capacity)), "uid long, length long, part long, bin long, offset long, fill long, gap long")


def pack_lengths(pieces: DataFrame, capacity: int = CAPACITY,
                 per_part: int = PARTITION_PIECES, exchanges: int = MAX_EXCHANGES) -> DataFrame:
    """``uid, sequence_id, offset`` for ``pieces(uid, length)``; uid must be unique and >= 0."""
    full = pieces.where(F.col("length") >= capacity).select(
        "uid", (-F.col("uid") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    pool = pieces.where(F.col("length") < capacity).select("uid", "length")
    n = pool.count()

    def placed(df: DataFrame, r: int) -> DataFrame:
        seq = F.lit(r << 56) + F.col("part") * F.lit(1 << 28) + F.col("bin")
        return df.select("uid", seq.alias("sequence_id"), "offset")

    final, pending = [full], None
    for r in range(exchanges + 1):
        if not n:
            break
        packed = cut(_deal(pool, n, r, capacity, per_part))
        first = F.col("offset") == 0
        if pending is not None and packed.where(first).count() >= pending[1]:
            break           # the exchange saved no sequence: the earlier packing stays
        # certified partitions and filled sequences are final
        done = (F.col("gap") <= 0) | (F.col("fill") == capacity)
        final.append(placed(packed.where(done), r))
        pool = packed.where(~done)
        n = pool.count()
        pending = (placed(pool, r), pool.where(first).count()) if n else None
        pool = pool.select("uid", "length")
    if pending is not None:
        final.append(pending[0])
    out = final[0]
    for df in final[1:]:
        out = out.unionByName(df)
    return out


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = 0,
         with_ids: bool = False) -> DataFrame:
    """Pieces of ``token_pieces`` with ``sequence_id`` and ``offset`` in that sequence."""
    pieces = cut(token_pieces(docs, tokenizer, capacity, end_id, with_ids)
                 .withColumn("uid", F.monotonically_increasing_id()))
    return pieces.join(pack_lengths(pieces.select("uid", "length"), capacity), "uid").drop("uid")


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids, doc_ids, starts`` of ``pack(..., with_ids=True)``: the token
    sequences themselves, with the document and place at which each piece begins."""
    inside = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids")))
    return packed.groupBy("sequence_id").agg(inside.alias("p")).select(
        "sequence_id", F.flatten(F.col("p.ids")).alias("ids"),
        F.col("p.doc_id").alias("doc_ids"), F.col("p.offset").alias("starts"))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


QUERIES = {"op9_best_fit_packing": op9_best_fit_packing}
