"""Near-duplicate vectors by hierarchical navigable small-world graphs.

Equal vectors are represented by one of them.  The others are dealt into shards by
hash; each shard's graph (Malkov and Yashunin) is built in one task of bounded
size.  Every vector queries every shard: a task holds two shards and searches
each with the vectors of the other, so that a link found from either end counts
for both.  A search whose beam is full of links is repeated with a wider one.  A
share of the vectors, large enough to have ``LEAST`` links to others, is also compared with
the whole shard, and while the searches find less than ``RECALL`` of the links of
these, the beam is doubled for all; a beam as wide as the shard that still misses some is
replaced by the full comparison, and so is a search between shards with hardly any links.  Links count when the cosine in double precision reaches the limit.
A task returns link counts and a spanning forest of its links, not its pairs.

Defined results: a vector that is null, empty, zero or has null or non-finite
parts links with nothing and is its own component; vectors of different lengths
do not link; repeated rows and equal vectors are copies and link with each other;
an empty table gives no rows; extra columns are ignored; a row with a null id
counts as a link of others and never names a component.
"""

from __future__ import annotations

import pickle

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orchard.llm.common import components, cut, table, tidy

COSINE = 0.9
SHARD = 32_768          # vectors of one graph
SHARDS = 6              # graphs at least, so that small inputs spread too
NEIGHBOURS = 12         # links a node gets; twice as many are kept on the ground layer
BEAM_BUILD, BEAM = 48, 48
RECALL = 0.98
AUDIT = 32              # one in so many vectors is audited, more while they have fewer than LEAST links
LEAST = 20
_BATCH = 512


class SmallWorld:
    """Layered proximity graph over the rows of ``x`` (unit vectors, float32)."""

    def __init__(self, x: np.ndarray, levels: np.ndarray, m: int = NEIGHBOURS):
        self.x, self.m, self.levels = x, m, levels
        self.links = [np.full((len(x), 2 * m), -1, np.int32) for _ in range(int(levels.max()) + 1)]
        self.inside = np.zeros(len(x), bool)
        self.entry, self.top = -1, -1

    def beam(self, q: np.ndarray, start: np.ndarray, layer: int, width: int):
        """Best ``width`` nodes of a layer for each query, by best-first search from ``start``
        (queries x entry nodes); ids (-1: none) and similarities, best first."""
        b, n, links = len(q), len(self.x), self.links[layer]
        ids = np.full((b, width), -1, np.int64)
        sim = np.full((b, width), -2.0, np.float32)
        done = np.zeros((b, width), bool)
        seen = np.zeros((b, n), bool)
        live = np.arange(b)
        fresh = start
        while len(live):
            new = fresh >= 0
            rows = live[:, None]
            new &= ~seen[rows, np.where(new, fresh, 0)]
            seen[np.broadcast_to(rows, fresh.shape)[new], fresh[new]] = True
            got = np.einsum("bd,bkd->bk", q[live], self.x[np.where(new, fresh, 0)])
            got[~new] = -2.0
            every = np.concatenate((sim[live], got), axis=1)
            order = np.argsort(-every, axis=1, kind="stable")[:, :width]
            sim[live] = np.take_along_axis(every, order, 1)
            ids[live] = np.take_along_axis(
                np.concatenate((ids[live], np.where(new, fresh, -1)), axis=1), order, 1)
            done[live] = np.take_along_axis(
                np.concatenate((done[live], np.zeros(new.shape, bool)), axis=1), order, 1)
            waiting = ~done[live] & (sim[live] > -2)
            go = waiting.any(axis=1)
            live = live[go]
            if not len(live):
                break
            at = waiting[go].argmax(axis=1)         # beams are sorted: the best not yet expanded
            done[live, at] = True
            fresh = links[ids[live, at]].astype(np.int64)
        ids[sim <= -2] = -1
        return ids, sim

    def descend(self, q: np.ndarray, to: int) -> np.ndarray:
        """Entry nodes for layer ``to``, by narrow searches from the top."""
        at = np.full((len(q), 1), self.entry, np.int64)
        for layer in range(self.top, to, -1):
            at = self.beam(q, at, layer, 4)[0]
        return at

    def choose(self, sim: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Up to 2 m of the candidates (best first): those nearer to the node than to any chosen
        one come first, so that dense groups keep links to the outside."""
        limit = 2 * self.m
        if len(ids) <= self.m:
            return ids
        between = self.x[ids] @ self.x[ids].T
        best = np.full(len(ids), -2.0, np.float32)
        taken = np.zeros(len(ids), bool)
        for i in range(len(ids)):
            if sim[i] > best[i]:
                taken[i] = True
                if taken.sum() >= self.m:
                    break
                np.maximum(best, between[i], out=best)
        rest = np.flatnonzero(~taken)[:limit - int(taken.sum()) - self.m // 2]
        taken[rest] = True
        return ids[np.flatnonzero(taken)]

    def insert(self, nodes: np.ndarray) -> None:
        """Add nodes together: each is linked with the graph so far and with its batch."""
        q, layers = self.x[nodes], int(self.levels[nodes].max())
        own = q @ q.T
        np.fill_diagonal(own, -2.0)
        for layer in range(layers, -1, -1):
            part = np.flatnonzero(self.levels[nodes] >= layer)
            ids = np.full((len(part), 0), -1, np.int64)
            sim = np.empty((len(part), 0), np.float32)
            if self.entry >= 0 and layer <= self.top:
                ids, sim = self.beam(q[part], self.descend(q[part], layer), layer, BEAM_BUILD)
            k = min(BEAM_BUILD, len(part))
            mates = np.argsort(-own[np.ix_(part, part)], axis=1)[:, :k]
            mate_sim = np.take_along_axis(own[np.ix_(part, part)], mates, 1)
            ids = np.concatenate((ids, nodes[part][mates]), axis=1)
            sim = np.concatenate((sim, mate_sim), axis=1)
            order = np.argsort(-sim, axis=1, kind="stable")[:, :BEAM_BUILD]
            ids, sim = np.take_along_axis(ids, order, 1), np.take_along_axis(sim, order, 1)
            back: dict[int, list[int]] = {}
            for row, node in enumerate(nodes[part].tolist()):
                good = sim[row] > -2
                chosen = self.choose(sim[row][good], ids[row][good])
                self.links[layer][node, :len(chosen)] = chosen
                for y in chosen.tolist():
                    back.setdefault(y, []).append(node)
            for y, xs in back.items():
                have = self.links[layer][y]
                have = have[have >= 0]
                both = np.unique(np.concatenate((have, np.array(xs, np.int32))))
                if len(both) > 2 * self.m:
                    s = self.x[both] @ self.x[y]
                    order = np.argsort(-s, kind="stable")
                    both = self.choose(s[order], both[order])
                self.links[layer][y] = -1
                self.links[layer][y, :len(both)] = both
        best = nodes[np.argmax(self.levels[nodes])]
        if self.levels[best] > self.top:
            self.entry, self.top = int(best), int(self.levels[best])

    @classmethod
    def build(cls, x: np.ndarray, seed: int = 7) -> SmallWorld:
        rng = np.random.default_rng(seed)
        u = rng.random(len(x))
        graph = cls(x, np.floor(-np.log(1 - u) / np.log(NEIGHBOURS)).astype(np.int64))
        i = 0
        while i < len(x):
            size = min(_BATCH, max(32, i))
            graph.insert(np.arange(i, min(len(x), i + size)))
            i += size
        return graph

    def within(self, q: np.ndarray, limit: float, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, node) pairs of similarity ``limit`` or more that searches find."""
        out_q, out_n = [], []
        for lo in range(0, len(q), _BATCH):
            todo, w = np.arange(lo, min(lo + _BATCH, len(q))), min(width, len(self.x))
            while len(todo):
                step = max(1, min(len(todo), 8_000_000 // max(1, len(self.x) + 40 * w)))
                full = []
                for s in range(0, len(todo), step):
                    part = todo[s:s + step]
                    ids, sim = self.beam(q[part], self.descend(q[part], 0), 0, w)
                    wide = (sim[:, -1] >= limit) & (w < len(self.x))
                    full.append(part[wide])
                    r, c = np.nonzero((sim >= limit) & ~wide[:, None])
                    out_q.append(part[r])
                    out_n.append(ids[r, c])
                todo, w = np.concatenate(full), min(4 * w, len(self.x))
        return np.concatenate(out_q), np.concatenate(out_n)


def _unit(vectors) -> np.ndarray:
    x = np.stack([np.asarray(v, np.float64) for v in vectors])
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _build(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("h")
    x = _unit(pdf["embedding"])
    graph = SmallWorld.build(x.astype(np.float32))
    state = {"h": pdf["h"].to_numpy(np.int64), "many": pdf["many"].to_numpy(np.int64), "x": x,
             "levels": graph.levels, "links": graph.links, "entry": graph.entry, "top": graph.top}
    return pd.DataFrame({"shard": [pdf["shard"].iloc[0]], "dim": [x.shape[1]],
                         "graph": [pickle.dumps(state)]})


def _load(blob: bytes) -> tuple[SmallWorld, dict]:
    state = pickle.loads(blob)
    graph = SmallWorld.__new__(SmallWorld)
    graph.x, graph.m = state["x"].astype(np.float32), NEIGHBOURS
    graph.levels, graph.links = state["levels"], state["links"]
    graph.entry, graph.top = state["entry"], state["top"]
    return graph, state


def _exact(q: np.ndarray, x: np.ndarray, cosine: float, rows: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """All links of ``q[rows]`` with ``x`` (a vector is not linked with itself where both are the same)."""
    found = []
    for i in range(0, len(rows), 256):
        at = rows[i:i + 256]
        r, c = np.nonzero(q[at] @ x.T >= cosine - 1e-9)
        ok = np.einsum("ij,ij->i", q[at[r]], x[c]) >= cosine
        if same:
            ok &= at[r] != c
        found.append((at[r[ok]], c[ok]))
    return tuple(np.concatenate(f) if f else np.empty(0, np.int64) for f in zip(*found)) if found else (
        np.empty(0, np.int64), np.empty(0, np.int64))


def _found(graph: SmallWorld, held: dict, asking: dict, cosine: float, same: bool = False,
           beam: int = BEAM) -> tuple[np.ndarray, np.ndarray, int, int]:
    """Verified (asking row, held row) links, and links found and existing of audited rows.

    Audited rows are compared in full.  One in ``AUDIT`` is, and four times as many as long as these
    have fewer than ``LEAST`` links (matches of a vector with itself do not count), so that an
    audit always judges a set number of links, or else everything has been compared.
    The beam is doubled until ``RECALL`` of the audited links are found.
    """
    q, x = asking["x"], held["x"]
    order = np.argsort(asking["h"].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    done, parts = 0, []
    take = -(-len(q) // AUDIT)
    while done < len(q) and sum(len(p[0]) for p in parts) < LEAST:
        parts.append(_exact(q, x, cosine, order[done:take], same))
        done, take = min(take, len(q)), take * 4
    near = sum(len(p[0]) for p in parts)
    if done >= len(q):
        a, b = (np.concatenate(f) for f in zip(*parts)) if parts else (np.empty(0, np.int64),) * 2
        return a, b, near, near
    audited = np.zeros(len(q), bool)
    audited[order[:done]] = True
    width = beam
    while True:
        a, b = graph.within(q.astype(np.float32), cosine - 1e-4, width)
        ok = np.einsum("ij,ij->i", q[a], x[b]) >= cosine if len(a) else np.zeros(0, bool)
        if same:
            ok &= a != b
        a, b = a[ok], b[ok]
        got = int(audited[a].sum())
        if got >= RECALL * near:
            return a, b, got, near
        if width >= len(x):
            return *_exact(q, x, cosine, np.arange(len(q)), same), near, near
        width *= 2


def _forest(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Places of the links of a spanning forest (union by path halving)."""
    parent: dict[int, int] = {}

    def root(v: int) -> int:
        while parent.setdefault(v, v) != v:
            parent[v] = parent[parent[v]]
            v = parent[v]
        return v

    keep = []
    for i, (u, v) in enumerate(zip(a.tolist(), b.tolist())):
        ru, rv = root(u), root(v)
        if ru != rv:
            parent[ru] = rv
            keep.append(i)
    return np.array(keep, np.int64)


def _searcher(cosine: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("shard")
        left, one = _load(pdf["graph"].iloc[0])
        if len(pdf) == 1:
            a, b, got, all_ = _found(left, one, one, cosine, same=True)
            lo, hi = np.minimum(a, b), np.maximum(a, b)
            other = one
            keep = lo != hi
            lo, hi = lo[keep], hi[keep]
        else:
            right, other = _load(pdf["graph"].iloc[1])
            a, b, g1, n1 = _found(right, other, one, cosine)
            d, c, g2, n2 = _found(left, one, other, cosine)
            lo, hi = np.concatenate((a, c)), np.concatenate((b, d))
            got, all_ = g1 + g2, n1 + n2
        pair = np.unique(lo * (len(other["h"]) + 1) + hi)
        lo, hi = pair // (len(other["h"]) + 1), pair % (len(other["h"]) + 1)
        u, v = one["h"][lo], other["h"][hi]
        node = np.concatenate((u, v))
        count = np.concatenate((other["many"][hi], one["many"][lo]))
        node, at = np.unique(node, return_inverse=True)
        count = np.bincount(at, count, len(node)).astype(np.int64)
        tree = _forest(u, v)
        none = np.zeros(len(tree), np.int64)
        # counts of nodes, forest links (0), and the audit (-1)
        return pd.DataFrame({"a": np.concatenate((node, u[tree], [got])),
                             "b": np.concatenate((np.zeros(len(node), np.int64), v[tree], [all_])),
                             "links": np.concatenate((count, none, [-1]))}, dtype="int64")
    return run


def similar_vectors(vectors: DataFrame, cosine: float = COSINE, id_col: str = "vec_id",
                    vector_col: str = "embedding") -> tuple[DataFrame, DataFrame]:
    """(rows, audit): ``vec_id, n_links, component_id`` of every row, and ``found, existing``
    links of the audited vectors."""
    e = F.col("embedding")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"),
                          F.transform(F.col(vector_col), lambda v: v.cast("double")).alias("embedding"))
    finite = F.forall(e, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    sound = F.coalesce(finite & F.exists(e, lambda v: v != 0), F.lit(False))
    # 0.0 and -0.0 are one value
    rows = cut(rows.withColumn("h", F.when(sound, F.xxhash64(F.transform(e, lambda v: v + F.lit(0.0)))))
               .withColumn("embedding", F.when(sound, e)))
    classes = (rows.where("h is not null").groupBy("h")
               .agg(F.count("*").alias("many"), F.min("embedding").alias("embedding")))
    n = rows.where("h is not null").select("h").distinct().count()
    shards = max(SHARDS, -(-n // SHARD))
    graphs = cut(classes.withColumn("dim", F.size("embedding"))
                 .withColumn("shard", F.pmod(F.xxhash64("h"), F.lit(shards)).cast("int"))
                 .groupBy("dim", "shard").applyInPandas(tidy(_build), "shard int, dim int, graph binary"))
    pairs = graphs.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    pairs = pairs.select("dim", "shard", "graph", F.least("shard", "other").alias("i"),
                         F.greatest("shard", "other").alias("j"))
    # a pair of shards of which one is empty has one row too; only i = j searches itself
    whole = pairs.groupBy("dim", "i", "j").agg(F.count("*").alias("m"))
    pairs = pairs.join(whole, ["dim", "i", "j"]).where("i = j or m = 2")
    found = cut(pairs.select("dim", "i", "j", "shard", "graph").repartition(max(1, shards * (shards + 1) // 2), "dim", "i", "j")
                .groupBy("dim", "i", "j").applyInPandas(tidy(_searcher(cosine)), "a long, b long, links long"))
    counts = found.where("links > 0").groupBy(F.col("a").alias("h")).agg(F.sum("links").alias("links"))
    edges = found.where("links = 0").select("a", "b")
    label = cut(components(edges)).withColumnRenamed("id", "h")
    joined = (rows.select("vec_id", "h").join(classes.select("h", "many"), "h", "left")
              .join(counts, "h", "left").join(label, "h", "left")
              .withColumn("label", F.coalesce("component_id", "h")))
    least = joined.where("label is not null").groupBy("label").agg(F.min("vec_id").alias("least"))
    out = joined.join(least, "label", "left").select(
        "vec_id", (F.coalesce("links", F.lit(0)) + F.coalesce(F.col("many") - 1, F.lit(0))).alias("n_links"),
        F.coalesce("least", "vec_id").alias("component_id"))
    audit = found.where("links = -1").agg(F.sum("a").alias("found"), F.sum("b").alias("existing"))
    return out, audit


def op4_hnsw_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = similar_vectors(table(spark, sf_dir, "embeddings"))
    return rows.withColumn("kept", F.col("vec_id") == F.col("component_id"))


QUERIES = {"op4_hnsw_neardup": op4_hnsw_neardup}
