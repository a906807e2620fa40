"""Quality, toxicity, chat, embeddings and decontamination against brute force or held-out truth."""

import math
import re
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import helpers as H  # noqa: E402

from orchard.llm import chat, decontaminate, embed_dedup, quality, toxicity  # noqa: E402

SF = "/root/testdata/sf0.01"


# ---- quality --------------------------------------------------------------------------------

def brute_kneser_ney(trusted, order=5):
    """Plain interpolated modified Kneser-Ney over bytes (Chen and Goodman 1998)."""
    def grams(t):
        b = b"\0" * (order - 1) + re.sub(rb"[0-9]", b"0", t.encode())
        return [b[i:i + order] for i in range(len(b) - order + 1)]

    counts = {order: Counter(g for t in trusted for g in grams(t))}
    for n in range(order - 1, 0, -1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])
    discount, context = {}, {}
    for n, c in counts.items():
        have = Counter(c.values())
        if have[1] and have[2] and have[3]:
            y = have[1] / (have[1] + 2 * have[2])
            discount[n] = [min(max(k - (k + 1) * y * have[k + 1] / have[k], 0.01), k - 0.01) for k in (1, 2, 3)]
        else:
            discount[n] = [0.5] * 3
        context[n] = defaultdict(lambda: [0, 0.0])
        for g, k in c.items():
            context[n][g[:-1]][0] += k
            context[n][g[:-1]][1] += discount[n][min(k, 3) - 1]

    def p(g):
        n = len(g)
        if n == 0:
            return 1 / 256
        if g[:-1] not in context[n]:
            return p(g[1:])
        total, held = context[n][g[:-1]]
        k = counts[n].get(g, 0)
        own = max(k - (discount[n][min(k, 3) - 1] if k else 0), 0) / total
        return own + held / total * p(g[1:])

    return lambda t: -sum(math.log(p(g)) for g in grams(t)) / len(t.encode()) if t else None


@pytest.mark.parametrize("hot", [1 << 18, 50])
def test_perplexity_matches_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(quality, "HOT", hot)      # few hot n-grams: most take the joined path
    rng = np.random.default_rng(0)
    texts = [H.prose(rng, 30, 60) for _ in range(40)] + ["", "X!! Y!! 123", "ñandú déjà vu 99", None]
    df = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    trusted = spark.createDataFrame([(i,) for i in range(20)], "doc_id long")
    got = quality.perplexity(df.repartition(3), trusted).toPandas().set_index("doc_id")
    score = brute_kneser_ney(texts[:20])
    for i, t in enumerate(texts):
        if t:
            assert got.loc[i, "log_perplexity"] == pytest.approx(score(t), abs=1e-9)
        else:
            assert got.loc[i, "n_bytes"] == 0 and math.isnan(got.loc[i, "log_perplexity"])


def test_probabilities_sum_to_one(spark):
    rng = np.random.default_rng(1)
    texts = [H.prose(rng, 20, 30) for _ in range(5)]
    seen = np.frombuffer(" ".join(texts).encode(), np.uint8)
    codes = quality.gram_codes(seen, np.array([0, len(seen)]))
    context = codes[100] >> 8
    rows = [(int(c), 1, 1) for c in np.unique(codes)] + [(int(context << 8 | b), 0, 0) for b in range(256)]
    grams = spark.createDataFrame(rows, "g long, c long, t long").groupBy("g").agg({"c": "max", "t": "max"}).toDF("g", "c", "t")
    p = quality.log_probabilities(grams).where(f"shiftright(g, 8) = {context}").toPandas()
    assert len(p) == 256 and np.exp(p["logp"]).sum() == pytest.approx(1.0)


def test_clean_documents_stay_and_junk_goes(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = quality.classify(docs, labels).join(labels, "doc_id").toPandas()
    assert got.loc[got["quality"] == 1, "keep"].mean() > 0.985
    assert got.loc[got["quality"] == 0, "keep"].mean() < 0.10


def test_limits_tell_the_classes_apart(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    got = quality.classify(docs, labels).join(labels, "doc_id").toPandas()
    assert got.loc[got["quality"] == 1, "keep"].mean() > 0.99
    assert got.loc[got["quality"] == 0, "keep"].mean() < 0.04


def test_unseen_documents_are_judged_like_trusted_ones(spark):
    """Labels of a quarter of the documents are withheld: neither model nor limits know them."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    unseen = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    got = quality.classify(docs, labels.where(~unseen)).join(labels.where(unseen), "doc_id").toPandas()
    assert len(got) > 900 and not got["trusted"].any()
    assert got.loc[got["quality"] == 1, "keep"].mean() > 0.98
    assert got.loc[got["quality"] == 0, "keep"].mean() < 0.04


# ---- toxicity -------------------------------------------------------------------------------

def test_ftrl_pass_matches_plain_python():
    rng = np.random.default_rng(2)
    rows = [np.unique(rng.integers(1, 30, 6)) for _ in range(50)]
    y = [float(3 in r or 7 in r) for r in rows]
    z, n = np.zeros(30), np.zeros(30)
    toxicity.ftrl_pass(rows, y, z, n)
    zz, nn = [0.0] * 30, [0.0] * 30
    for x, t in zip(rows, y):
        x = [*x.tolist(), 0]
        w = {}
        for i in x:
            l1 = 0.0 if i == 0 else toxicity.L1
            rate = (toxicity.BETA + math.sqrt(nn[i])) / toxicity.ALPHA + toxicity.L2
            w[i] = 0.0 if abs(zz[i]) <= l1 else (math.copysign(l1, zz[i]) - zz[i]) / rate
        g = 1 / (1 + math.exp(-sum(w.values()))) - t
        for i in x:
            s = (math.sqrt(nn[i] + g * g) - math.sqrt(nn[i])) / toxicity.ALPHA
            zz[i] += g - s * w[i]
            nn[i] += g * g
    assert np.allclose(z, zz) and np.allclose(n, nn)


def test_words_of_four_toxic_documents_count(spark):
    rng = np.random.default_rng(12)
    texts = [f"{H.prose(rng, 3)} zanzibar" if i < 4 else H.prose(rng, 6) for i in range(200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 4)) for i in range(200)], "doc_id long, toxic int")
    new = spark.createDataFrame([(0, "zanzibar"), (1, "another")], "doc_id long, text string")
    score = toxicity.fit(docs, labels).transform(new).toPandas().set_index("doc_id")["score"]
    assert score[0] > score[1]


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    got = toxicity.op2_ftrl_toxicity(spark, sf).toPandas()
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert got["score"].between(0, 1).all()
    assert (got["predicted"] == (got["score"] >= 0.3)).all()
    assert (got["held_out"] == [H.held_out(i) for i in got["doc_id"]]).all()
    m = got.merge(spark.read.parquet(f"{sf}/labels.parquet").toPandas(), on="doc_id")
    m = m[m["held_out"]]
    hit = ((m["predicted"] == 1) & (m["toxic"] == 1)).sum()
    assert hit / m["predicted"].sum() > 0.95 and hit / m["toxic"].sum() > 0.75


def test_toxicity_without_usable_labels(spark):
    df = spark.createDataFrame([(1, "a text"), (2, None)], "doc_id long, text string")
    for rows, p in (([], 0.5), ([(1, 1, 1)], 1.0), ([(1, 1, None), (None, 1, 1)], 0.5)):
        model = toxicity.fit(df, H.labels(spark, rows).select("doc_id", "toxic"))
        got = model.transform(df).toPandas()
        assert np.allclose(got["score"], p, atol=1e-5)


# ---- chat -----------------------------------------------------------------------------------

def test_chat_recovers_held_out_conversations(spark):
    table = spark.read.parquet(f"{SF}/conversations.parquet")
    raw = chat.transcripts(table)
    parsed = chat.parse(raw, chat.fit(raw.where(chat.train_fold()))).toPandas().set_index("conv_id")["turns"]
    want = defaultdict(list)
    for r in table.orderBy("conv_id", "turn").collect():
        want[r["conv_id"]].append((r["role"], r["text"].strip("\n")))
    held = [c for c in want if H.held_out(c)]
    right = sum([(t["role"], t["text"]) for t in parsed[c]] == want[c] for c in held)
    assert held and right / len(held) > 0.95


def test_viterbi_matches_all_paths():
    import itertools
    import pandas as pd
    rng = np.random.default_rng(3)
    counts = [(-2, 0, j, int(rng.integers(1, 9))) for j in range(6)]
    counts += [(-1, i, j, int(rng.integers(1, 9))) for i in range(6) for j in range(6)]
    counts += [(f, i, j, int(rng.integers(1, 9))) for f, s in enumerate(chat._SIZES) for i in range(6) for j in range(s)]
    model = chat.TranscriptModel(pd.DataFrame(counts, columns=["kind", "i", "j", "n"]))
    feats = np.stack([rng.integers(0, s, 5) for s in chat._SIZES], axis=1)

    def score(path):
        total = model.start[path[0]] if path[0] % 2 == 0 else -np.inf
        total += sum(model.move[a, b] for a, b in zip(path, path[1:]))
        return total + sum(e[s, f[k]] for s, f in zip(path, feats) for k, e in enumerate(model.emit))

    best = max(itertools.product(range(6), repeat=5), key=score)
    assert tuple(model.decode(feats)) == best


def test_chat_edges(spark):
    rows = [(1, 0, "user", "hi"), (1, 0, "user", "hi"), (1, 1, None, None), (2, None, "robot", ""), (None, 0, "user", "x"),
            (3, 0, "user", "line\n" * 3000), *[(4, i, "user" if i % 2 else "assistant", f"t{i}.") for i in range(600)]]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS part", "2 AS said")
    raw = chat.transcripts(df)
    out = chat.render(chat.parse(raw, chat.fit(raw))).toPandas()
    assert len(out) == 1 + 1 + 1 + 1 + 3
    empty = chat.transcripts(df.limit(0))
    assert chat.render(chat.parse(empty, chat.fit(empty))).count() == 0


# ---- embeddings -----------------------------------------------------------------------------

def test_vectors_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embed_dedup, "SHARD", 200)
    rng = np.random.default_rng(4)
    x = rng.normal(size=(900, 24))
    for i in range(0, 400, 4):          # groups of near vectors, one of them large
        x[i + 1:i + 4] = x[i] + 0.15 * rng.normal(size=(3, 24))
    x[500:700] = x[500] + 0.12 * rng.normal(size=(200, 24))
    x[700:720] = x[700]
    rows = [(i, [float(v) for v in np.float32(r)]) for i, r in enumerate(x)]
    bad = [(900, None), (901, []), (902, [0.0] * 24), (903, [float("nan")] + [1.0] * 23), (904, [None] + [1.0] * 23),
           (905, [float("inf")] + [1.0] * 23), (906, [1.0, 0.0]), (907, [-1.0, 0.0])]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>").selectExpr("*", "1 AS h", "2 AS many")
    out, audit = embed_dedup.similar_vectors(df.repartition(5))
    got = out.toPandas().set_index("vec_id")
    y = np.stack([np.asarray(r[1], np.float64) for r in rows])
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    near = y @ y.T >= 0.9
    links = [(int(a), int(b)) for a, b in zip(*np.nonzero(near)) if a > b]
    want = H.smallest_reachable(range(908), links)
    a = audit.head()
    assert a["existing"] > 0 and a["found"] / a["existing"] >= 0.9
    n = np.concatenate((near.sum(axis=1) - 1, np.zeros(8, int)))
    assert (got["n_links"].loc[range(908)].to_numpy() == n).mean() > 0.99
    assert (got["n_links"].loc[range(908)].to_numpy() <= n).all()
    assert np.mean([got["component_id"][i] == want[i] for i in range(908)]) > 0.99
    empty, _ = embed_dedup.similar_vectors(df.limit(0))
    assert empty.count() == 0


def planted_shard(n, copies, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(0, 1, (n, 24))
    for i in range(copies):                                   # pairs of near vectors
        x[2 * i + 1] = x[2 * i] + rng.normal(0, 0.02, 24)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    return embed_dedup.SmallWorld.build(x.astype(np.float32)), {"x": x, "h": rng.integers(-2**62, 2**62, n)}


def test_audit_widens_a_crippled_beam_and_ignores_self_matches(monkeypatch):
    graph, shard = planted_shard(1500, 600)
    widths, real = [], embed_dedup.SmallWorld.within

    def crippled(self, q, limit, width):
        widths.append(width)
        a, b = real(self, q, limit, width)
        stay = (a == b) | (width >= 150)                      # a narrow beam finds vectors themselves only
        return a[stay], b[stay]

    monkeypatch.setattr(embed_dedup.SmallWorld, "within", crippled)
    a, b, got, near = embed_dedup._found(graph, shard, shard, 0.9, same=True, beam=8)
    assert widths == [8, 16, 32, 64, 128, 256] and (a != b).all()
    assert embed_dedup.LEAST <= near < 1200 and got >= 0.98 * near and len(a) >= 0.98 * 1200


def test_shards_with_hardly_any_links_are_compared_in_full(monkeypatch):
    graph, shard = planted_shard(600, 3)
    monkeypatch.setattr(embed_dedup.SmallWorld, "within", lambda *a: pytest.fail("searched"))
    a, b, got, near = embed_dedup._found(graph, shard, shard, 0.9, same=True)
    assert sorted(zip(a.tolist(), b.tolist())) == [(0, 1), (1, 0), (2, 3), (3, 2), (4, 5), (5, 4)] and got == near == 6


def test_repeated_and_null_vector_ids(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(5, v), (5, v), (None, v), (9, [2.0, 4.0, 6.0]), (None, None)]
    got = sorted(map(tuple, embed_dedup.similar_vectors(spark.createDataFrame(
        rows, "vec_id long, embedding array<float>"))[0].collect()), key=str)
    assert got == sorted([(5, 3, 5), (5, 3, 5), (None, 3, 5), (9, 3, 5), (None, 0, None)], key=str)


# ---- decontamination ------------------------------------------------------------------------

def edits_inside(item, text):
    """Least edits of the whole item against any part of the text (plain dynamic programme)."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_decontamination_matches_brute_force(spark, tmp_path):
    rng = np.random.default_rng(5)
    import random
    r = random.Random(5)
    items = [H.prose(rng, n) for n in (12, 20, 30, 45, 6, 2)] + ["", None, "tiny"]
    fold = lambda t: re.sub(r"\s+", " ", t.lower())
    texts = [None, "", "x"]
    for _ in range(90):
        t = list(items[r.randrange(6)])
        budget = decontaminate.edit_budget(len(t), 0.1)
        for _ in range(r.choice([0, 0, 1, budget, budget + 1, 2 * budget + 2])):
            i = r.randrange(len(t))
            t[i:i + 1] = r.choice([["#"], [], [t[i], "#"]])
        noise = "".join(t)
        if r.random() < 0.3:
            noise = noise.upper().replace(" ", "\n  ")
        texts.append(f"{H.prose(rng, r.randrange(40), 3000)} {noise} {H.prose(rng, r.randrange(40), 3000)}")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    H.write_tables(spark, tmp_path, documents=docs.repartition(3), benchmark=bench)
    got = decontaminate.op5_qgram_decontamination(spark, str(tmp_path)).toPandas()
    best = got.groupby(["doc_id", "item_id"])["edits"].min().to_dict()
    for d, t in enumerate(texts):
        for i, item in enumerate(items):
            if t and item and len(item) >= 8:
                e = edits_inside(fold(item).strip(), fold(t))
                budget = decontaminate.edit_budget(len(fold(item).strip()), 0.1)
                assert best.get((d, i)) == (e if e <= budget else None), (d, i, e, budget)
    for x in got[got["edits"] == 0].itertuples():
        assert fold(texts[x.doc_id][x.start:x.end]) == fold(items[x.item_id]).strip()
    blocks = decontaminate.find_matches(docs, bench, block_bytes=300).toPandas()
    assert sorted(map(tuple, blocks.to_numpy())) == sorted(map(tuple, got.to_numpy()))
    clean = decontaminate.clean(docs, bench).toPandas()["doc_id"]
    assert set(clean) == set(range(len(texts))) - set(got["doc_id"])
