"""Jaccard join of word n-gram sets by a prefix tree in global token order.

A text's set holds its distinct runs of five words (A-Z lower-cased).  Sets are
ordered by how many texts have a token, rarest first, so that linked sets agree
near the front.  Steps:

1. Texts that occur more than once are represented by one of them.
2. Every set's tokens are dealt into buckets by hash, packed (a bucket's size
   follows the input), which yields the tokens that at least two texts have.
   With fewer of them than a partner would have to share, a text has no link.
3. The first tokens of the remaining sets, as many as the prefix bound asks for,
   tie together the texts that may link; the groups so formed cannot link to one
   another.
4. In each group the sets are stored in a prefix tree.  Every set walks the tree
   once: the overlap with a path is added up per tree node, shared by all sets
   below it, and a subtree is left when the tokens that remain on either side
   cannot lift the overlap to what its smallest set needs.  Sets that links
   already connect are passed over, since only connections are returned.
5. A group of more than ``PIVOT_FROM`` texts is compared with ``PIVOTS`` of them first.  The
   largest class that comes out of it is settled: its texts meet the rest of the group, not
   each other.  Rest and class are split into blocks of at most ``GROUP`` texts (about
   ``GROUP_TOKENS`` tokens) and compared block by block, so a group of near copies moves as
   often as its rest has blocks.

Defined results: a text with 1 to 4 words has that word sequence as its only
token; a null or empty text, or one of white space, has none and links with
nothing; repeated rows are copies; an empty table gives no rows; extra columns
are ignored; rows with a null id belong to classes but never name one, unless
all ids of the class are null.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orchard.llm.common import (Powers, byte_runs, components, cut, mix64, prefix_sums, restrict,
                                span_hashes, table, texts, tidy, word_spans, written)
from orchard.llm.hot import lookup

WORDS = 5
PERCENT = 80                    # link when 100 * shared >= PERCENT * united
BUCKET_BYTES = 8_000_000       # text per token bucket
MAX_TASKS = 20_000              # partitions that the buckets are dealt over
GROUP = 2_000                   # texts of a block: a task compares two
GROUP_TOKENS = 2_000_000        # tokens of a block (16 MB)
PIVOT_FROM = 256                # larger groups are compared with pivots first
PIVOTS = 8
PIVOT_SHARE = 1_000             # texts of a group that one copy of its pivots meets

_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
_BLANK = np.array([b == 32 or 9 <= b <= 13 for b in range(256)])


def shingle_sets(data: np.ndarray, offsets: np.ndarray, powers: Powers, words: int = WORDS):
    """(token, document) of the distinct word runs of each text, by document then token."""
    low = _LOWER[data]
    start, end, doc = word_spans(~_BLANK[low], offsets)
    h = span_hashes(prefix_sums(low, powers), start, end, powers)
    seed, step = np.uint64(0x2545F4914F6CDD1D), np.uint64(0x9FB21C651E98DF25)
    run = np.full(max(0, len(h) - words + 1), seed, np.uint64)
    for j in range(words):
        run = mix64(run * step + h[j:j + len(run)])
    whole = doc[words - 1:] == doc[:len(run)] if len(run) else np.empty(0, bool)
    token, owner = run[whole], doc[:len(run)][whole]
    # texts of fewer words: all of them as one token
    count = np.bincount(doc, minlength=len(offsets) - 1)
    first = np.cumsum(count) - count
    for d in np.flatnonzero((count > 0) & (count < words)):
        t = seed + count[d:d + 1].astype(np.uint64)
        for x in h[first[d]:first[d] + count[d]]:
            t = mix64(t * step + x)
        token, owner = np.append(token, t), np.append(owner, d)
    token = token >> np.uint64(1)                   # fits a signed long
    order = np.lexsort((token, owner))
    token, owner = token[order], owner[order]
    new = np.ones(len(token), bool)
    new[1:] = (token[1:] != token[:-1]) | (owner[1:] != owner[:-1])
    return token[new], owner[new]


def _dealt(rows: DataFrame, words: int, buckets: int) -> DataFrame:
    """Packed tokens of runs of texts: one row for each run and bucket."""
    schema = pa.schema([("bucket", pa.int64()), ("tokens", pa.binary()), ("owners", pa.binary()),
                        ("nodes", pa.binary()), ("sizes", pa.binary())])

    def run(it):
        powers = Powers()
        for b, data, off in byte_runs(it, 1_500_000):
            token, owner = shingle_sets(data, off, powers, words)
            node = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            size = np.bincount(owner, minlength=len(node)).astype(np.int64)
            order = np.argsort(token)
            token, owner = token[order], owner[order].astype(np.int32)
            # buckets are ranges of the (uniform) hash
            edge = (np.arange(1, buckets, dtype=np.float64) / buckets * 2.0**63).astype(np.uint64)
            cuts = np.concatenate(([0], np.searchsorted(token, edge), [len(token)]))
            out = []
            for k, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:])):
                if hi > lo or k == 0:
                    who, local = np.unique(owner[lo:hi], return_inverse=True)
                    gap = np.diff(token[lo:hi], prepend=token[lo:lo + 1])
                    narrow = np.uint32 if not len(gap) or gap.max() < 2**32 else np.uint64
                    short = np.uint16 if len(who) < 2**16 else np.uint32
                    out.append((k, (token[lo:lo + 1].tobytes() + gap.astype(narrow).tobytes()),
                                local.astype(short).tobytes(), node[who].tobytes(),
                                node.tobytes() + size.tobytes() if k == 0 else b""))
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return rows.mapInArrow(tidy(run), "bucket long, tokens binary, owners binary, nodes binary, sizes binary")


def _shared_tokens(pdf: pd.DataFrame) -> pd.DataFrame:
    """Tokens of one bucket that at least two nodes have, numbered in the global order: the
    number of those nodes (up to 65,535) above 47 bits of the token's hash.  Negative
    tokens carry the set size of a node instead (-1 - n)."""
    token, node, sized = [], [], []
    for t, o, n, s in pdf[["tokens", "owners", "nodes", "sizes"]].itertuples(index=False):
        if t:
            who = np.frombuffer(n, np.int64)
            local = np.frombuffer(o, np.uint16 if len(who) < 2**16 else np.uint32)
            wide = np.uint32 if len(t) == 8 + 4 * len(local) else np.uint64
            gap = np.frombuffer(t, wide, offset=8).astype(np.uint64)
            token.append(np.cumsum(gap) + np.frombuffer(t, np.uint64, 1))
            node.append(who[local])
        if s:
            sized.append(np.frombuffer(s, np.int64).reshape(2, -1))
    token = np.concatenate(token) if token else np.empty(0, np.uint64)
    node = np.concatenate(node) if node else np.empty(0, np.int64)
    order = np.argsort(token)
    t = token[order]
    many = np.zeros(len(t), bool)
    same = t[1:] == t[:-1]
    many[1:] |= same
    many[:-1] |= same
    order = order[many]
    token, node = token[order], node[order]
    order = np.lexsort((node, token))
    token, node = token[order], node[order]
    new = np.ones(len(token), bool)
    new[1:] = (token[1:] != token[:-1]) | (node[1:] != node[:-1])
    token, node = token[new], node[new]
    _, inverse, df = np.unique(token, return_inverse=True, return_counts=True)
    df = df[inverse] if len(token) else np.empty(0, np.int64)
    rank = (np.minimum(df, 65535).astype(np.int64) << 47) | (token >> np.uint64(16)).astype(np.int64)
    node, rank = node[df > 1], rank[df > 1]
    order = np.argsort(node, kind="stable")
    size = np.concatenate(sized, axis=1) if sized else np.empty((2, 0), np.int64)
    return pd.DataFrame({"node": np.concatenate((node[order], size[0])),
                         "token": np.concatenate((rank[order], -1 - size[1]))})


class PrefixTree:
    """Radix tree over token sequences; a node stands for the sets ``lo`` to ``hi`` of ``order``."""

    def __init__(self, seqs: list[np.ndarray], sizes: np.ndarray):
        # big-endian bytes sort like the sequences themselves
        self.order = sorted(range(len(seqs)), key=lambda i: seqs[i].astype(">u8").tobytes())
        s = [seqs[i] for i in self.order]
        n = sizes[self.order]
        length = np.array([len(x) for x in s])
        # common prefix with the set before
        lcp = [0]
        for a, b in zip(s[:-1], s[1:]):
            m = min(len(a), len(b))
            differ = np.flatnonzero(a[:m] != b[:m])
            lcp.append(int(differ[0]) if len(differ) else m)
        lo, hi, top, depth, kids = [0], [len(s)], [0], [0], [[]]

        def grow(node: int) -> None:
            """Children: runs of sets that agree on the token after the node's path."""
            i, end, at = lo[node], hi[node], depth[node]
            while i < end and length[i] == at:      # sets that end here need no child
                i += 1
            while i < end:
                j = i + 1
                shared = int(length[i])
                while j < end and lcp[j] > at:
                    shared = min(shared, lcp[j])
                    j += 1
                kids[node].append(len(lo))
                lo.append(i), hi.append(j), top.append(at), depth.append(shared), kids.append([])
                i = j

        node = 0
        while node < len(lo):
            grow(node)
            node += 1
        self.lo, self.hi = np.array(lo), np.array(hi)
        self.depth = np.array(depth)
        self.kids = [np.array(k, np.int64) for k in kids]
        runs = [s[a][t:d] for a, t, d in zip(lo, top, depth)] if s else [np.empty(0, np.int64)]
        self.run_at = np.cumsum([0] + [len(r) for r in runs])
        self.tokens = np.concatenate(runs)
        self.longest = np.array([length[a:b].max() if b > a else 0 for a, b in zip(lo, hi)])
        self.smallest = np.array([n[a:b].min() if b > a else 0 for a, b in zip(lo, hi)])
        self.length, self.n = length, n

    def linked(self, mark: np.ndarray, shared: int, size: int, wanted: np.ndarray, percent: int):
        """Places in ``order`` of the wanted sets that link with a set of ``size`` tokens;
        ``mark[t]`` is 1 + the place of token t among its ``shared`` ones, or 0."""
        until = np.append(0, np.cumsum(wanted))
        front, overlap, passed = np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(1, np.int64)
        found = []
        while len(front):
            # sets that end at a node of the front
            for f, o in zip(front, overlap):
                a, d = self.lo[f], self.depth[f]
                while a < self.hi[f] and self.length[a] == d:
                    if wanted[a] and (100 + percent) * o >= percent * (size + self.n[a]):
                        found.append(a)
                    a += 1
            kids = [self.kids[f] for f in front]
            parent = np.repeat(np.arange(len(front)), [len(k) for k in kids])
            if not len(parent):
                break
            front = np.concatenate(kids)
            live = until[self.hi[front]] > until[self.lo[front]]
            front, parent = front[live], parent[live]
            if not len(front):
                break
            many = self.run_at[front + 1] - self.run_at[front]
            first = np.cumsum(many) - many
            at = np.repeat(self.run_at[front] - first, many) + np.arange(many.sum())
            place = mark[self.tokens[at]]
            overlap = overlap[parent] + np.add.reduceat((place > 0).astype(np.int64), first)
            passed = np.maximum(passed[parent], np.maximum.reduceat(place, first))
            best = overlap + np.minimum(shared - passed, self.longest[front] - self.depth[front])
            live = (100 + percent) * best >= percent * (size + self.smallest[front])
            front, overlap, passed = front[live], overlap[live], passed[live]
        return found


def group_links(seqs: list[np.ndarray], sizes: np.ndarray, side: np.ndarray, percent: int = PERCENT,
                label: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that connect the sets of a group: within it, or, where ``side`` has 0 and 1,
    between the two sides.  Tokens are numbered in the global order; sets of one ``label``
    are connected already."""
    two = bool(side.any()) and not bool(side.all())
    held = np.flatnonzero(side == 0) if two else np.arange(len(seqs))
    probes = np.flatnonzero(side == 1) if two else held
    tree = PrefixTree([seqs[i] for i in held], sizes[held])
    member = held[np.array(tree.order, np.int64)]
    comp = np.arange(len(seqs)) if label is None else np.unique(label, return_inverse=True)[1]
    mark = np.zeros(1 + max((int(s[-1]) for s in seqs if len(s)), default=0), np.int64)
    links = []

    def join(a: int, b: int) -> None:
        links.append((a, b))
        comp[comp == comp[b]] = comp[a]

    def similar(a: int, b: int) -> bool:
        o = np.count_nonzero(mark[seqs[b]])
        return (100 + percent) * o >= percent * (sizes[a] + sizes[b])

    for x in probes:
        others = comp[member] != comp[x]
        if not others.any():
            continue
        mark[seqs[x]] = np.arange(1, len(seqs[x]) + 1)
        # one member of the largest class first: it settles most sets of a large group
        labels, count = np.unique(comp[member][others], return_counts=True)
        if len(labels) < len(member):
            y = int(member[np.flatnonzero(comp[member] == labels[np.argmax(count)])[0]])
            if y != x and similar(x, y):
                join(y, x)
                others = comp[member] != comp[x]
        if others.any():
            for p in tree.linked(mark, len(seqs[x]), int(sizes[x]), others, percent):
                y = int(member[p])
                if comp[y] != comp[x]:
                    join(y, x)
        mark[seqs[x]] = 0
    return links


def _group_task(percent: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("node")
        token = [np.asarray(t, np.int64) for t in pdf["tokens"]]
        _, rank = np.unique(np.concatenate(token), return_inverse=True)
        seqs = np.split(rank, np.cumsum([len(t) for t in token])[:-1])
        node = pdf["node"].to_numpy(np.int64)
        n, side, label = (pdf[c].to_numpy(np.int64) for c in ("n", "side", "label"))
        links = group_links(seqs, n, side, percent, label)
        return pd.DataFrame({"a": [node[i] for i, _ in links], "b": [node[j] for _, j in links]},
                            dtype="int64")
    return run


def _classes(docs: DataFrame) -> DataFrame:
    """Rows with their text hash ``node`` and a key ``k``; texts still unread by Python."""
    return texts(docs).select("doc_id", "text", F.xxhash64("text").alias("node"),
                              F.xxhash64("doc_id", "text").alias("k"))


def pivot_links(sets: DataFrame, member: DataFrame, percent: int, pivot_from: int) -> DataFrame:
    """``comp, a, b``: links of the ``sets`` of large groups (``member``: id, comp) with the first
    ``PIVOTS`` of their group.  Pivots are copied for each ``PIVOT_SHARE`` texts."""
    large = member.groupBy("comp").agg(F.count("*").alias("m")).where(F.col("m") > pivot_from)
    large = cut(large.withColumn("shares", F.ceil(F.col("m") / PIVOT_SHARE).cast("int")))
    inside = lookup(member, large, ["comp"], "m")
    order = Window.partitionBy("comp").orderBy("id")
    first = (inside.withColumn("place", F.row_number().over(order)).where(F.col("place") <= PIVOTS)
             .select("comp", F.col("id").alias("node")))
    pivots = (sets.join(first, "node").groupBy("comp")
              .agg(F.collect_list(F.struct("node", "n", "tokens")).alias("pivots"))
              .join(large, "comp").withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)))
              .select("comp", "share", "pivots"))
    rows = sets.join(inside, F.col("node") == F.col("id")).withColumn(
        "share", F.pmod(F.xxhash64("node"), F.col("shares")).cast("int")).drop("id")

    def linked(p):
        close = F.lit(100) * F.least(p["n"], F.col("n")) >= F.lit(percent) * F.greatest(p["n"], F.col("n"))
        shared = F.size(F.array_intersect("tokens", p["tokens"]))
        return (p["node"] != F.col("node")) & close & (
            (100 + percent) * shared >= F.lit(percent) * (p["n"] + F.col("n")))

    met = rows.join(pivots, ["comp", "share"]).select(
        "comp", F.col("node").alias("a"), F.filter("pivots", linked).alias("met"))
    return met.select("comp", "a", F.explode("met.node").alias("b"))


def text_links(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, group: int = GROUP,
               pivot_from: int = PIVOT_FROM) -> tuple[DataFrame, DataFrame]:
    """(``node, n`` of every distinct text, links ``a, b`` that connect linked texts)."""
    rows = _classes(docs)
    size = rows.agg(F.sum(F.octet_length("text").cast("long")).alias("n")).head()["n"] or 0
    buckets = max(1, -(-size // BUCKET_BYTES))
    ids = cut(rows.select("node", "k"))
    extra = cut(ids.join(ids.groupBy("node").agg(F.min("k").alias("one"), F.count("*").alias("c"))
                         .where("c > 1"), "node").where("k <> one").select("k").distinct())
    one_each = restrict(rows, extra, "k", "left_anti").select("node", "text")
    # a task takes few buckets, one after the other, however many there are
    shared = (_dealt(one_each, words, buckets).repartition(min(buckets, MAX_TASKS), "bucket").groupBy("bucket")
              .applyInPandas(tidy(_shared_tokens), "node long, token long"))
    with written(shared) as shared:
        sizes = cut(shared.where("token < 0").select("node", (-1 - F.col("token")).alias("n")).distinct())
        # a link needs at least percent % of the set's own tokens to be shared
        least = F.ceil(F.lit(percent) * F.col("n") / 100)
        shared = shared.where("token >= 0")
        counts = shared.groupBy("node").count()
        hopeful = cut(counts.join(sizes, "node").where(F.col("count") >= least).select("node", "n"))
        sets = cut(restrict(shared, hopeful.select("node"), "node")
                   .groupBy("node").agg(F.array_sort(F.collect_list("token")).alias("tokens"))
                   .join(hopeful, "node").select("node", "n", "tokens"))
    front = F.slice("tokens", 1, (F.size("tokens") - least + 1).cast("int"))
    firsts = sets.select("node", F.explode(front).alias("token"))
    least_node = cut(firsts.groupBy("token").agg(F.min("node").alias("to"), F.max("node").alias("last"))
                     .where("to <> last").select("token", "to"))
    ties = (firsts.join(least_node, "token")
            .where("node <> to").select(F.col("node").alias("a"), F.col("to").alias("b")).distinct())
    member = components(ties).withColumnRenamed("component_id", "comp")
    member = cut(member)
    early = cut(pivot_links(sets, member, percent, pivot_from))
    # texts by class so far; the largest class of a group with pivots is settled
    label = cut(components(early.select("a", "b")))
    known = label.join(member, "id")
    top = cut(known.groupBy("comp", "component_id").agg(F.count("*").alias("c")).groupBy("comp").agg(
        F.max(F.struct("c", "component_id")).alias("top"), F.sum("c").alias("m"))
              .select("comp", "m", F.col("top.component_id").alias("top")))
    settled = lookup(known, top, ["comp"], "m").select(
        "id", F.col("component_id").alias("label"), (F.col("component_id") == F.col("top")).alias("settled"))
    state = cut(member.join(settled, "id", "left").join(
        sets.select(F.col("node").alias("id"), F.size("tokens").alias("len")), "id").select(
        "id", "comp", F.coalesce("label", "id").alias("label"), F.coalesce("settled", F.lit(False)).alias("settled"),
        "len"))

    def blocks_of(of):
        count, tokens = F.sum(of.cast("long")), F.sum(F.when(of, F.col("len")).otherwise(0))
        return F.ceil(F.greatest(count / group, tokens / GROUP_TOKENS)).cast("int")

    parts = cut(state.groupBy("comp").agg(
        F.count("*").alias("m"), blocks_of(~F.col("settled")).alias("rest"), blocks_of(F.col("settled")).alias("same"))
        .where("rest > 0"))
    hashed = F.xxhash64("id")
    part = F.when(F.col("settled"), F.col("rest") + F.pmod(hashed, F.col("same"))).otherwise(
        F.pmod(hashed, F.col("rest"))).cast("int")
    placed = (sets.join(lookup(state, parts, ["comp"], "m").withColumn("part", part), F.col("node") == F.col("id")))
    # block pairs (i, j), i <= j: side 0 is block i, side 1 block j; i = j within one block of the
    # rest; the blocks of the settled class follow those of the rest and meet them alone
    last = F.when(F.col("settled"), F.col("rest") - 1).otherwise(F.col("rest") + F.col("same") - 1)
    pairs = placed.withColumn("other", F.explode(F.sequence(F.lit(0), last)))
    blocks = pairs.select("comp", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"),
                          F.when(F.col("part") > F.col("other"), 1).otherwise(0).cast("long").alias("side"),
                          "node", "n", "tokens", "label")
    late = cut(blocks.groupBy("comp", "i", "j").applyInPandas(tidy(_group_task(percent)), "a long, b long"))
    links = early.select("a", "b").unionByName(late)
    return sizes, links


def jaccard_classes(docs: DataFrame, words: int = WORDS, percent: int = PERCENT,
                    group: int = GROUP, pivot_from: int = PIVOT_FROM) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``docs``; a row without
    tokens is a class of its own."""
    sizes, links = text_links(docs, words, percent, group, pivot_from)
    linked = cut(components(links))
    # both sides of the last join are written first, so that a class that holds a third of
    # the rows can be split when they meet
    rows = cut(_classes(docs).select("doc_id", "node").join(sizes, "node", "left")
               .join(linked.withColumnRenamed("id", "node"), "node", "left")
               .select("doc_id", F.col("n").alias("n_shingles"),
                       F.coalesce("component_id", "node").alias("label")))
    least = cut(rows.groupBy("label").agg(F.min("doc_id").alias("least")))
    return rows.join(least, "label").select(
        "doc_id", "n_shingles",
        F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("least")).alias("component_id"))


def keep_one(docs: DataFrame, **kwargs) -> DataFrame:
    """``docs`` without the rows whose class has a smaller doc_id; columns as they are.
    Rows without an id stay."""
    classes = jaccard_classes(docs, **kwargs)
    gone = cut(classes.where("doc_id > component_id").select("doc_id").distinct())
    return restrict(docs, gone, "doc_id", "left_anti")


def op8_prefix_tree_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(table(spark, sf_dir, "documents"))


QUERIES = {"op8_prefix_tree_join": op8_prefix_tree_join}
