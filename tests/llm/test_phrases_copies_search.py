"""Collocations, exact dedup and ranked search against brute force, on both join paths, and over awkward tables."""

import hashlib
import math
import re
import sys
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import helpers as H  # noqa: E402

from orchard.llm import collocations, exact_dedup, lexical  # noqa: E402
from orchard.llm.hot import lookup  # noqa: E402

LOWER = {k: k + 32 for k in range(65, 91)}
SF = "/root/testdata/sf0.001"


def same_as_sql(spark, query, sql):
    got = query(spark, SF).toPandas()
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    cols = sorted(got.columns)
    rows = [sorted(map(tuple, d[cols].itertuples(index=False))) for d in (got, con.sql(sql).df())]
    return rows[0] == rows[1] and len(rows[0]) > 0


@pytest.mark.parametrize("query, sql", [(collocations.op11_collocations, collocations.OP11_SQL),
                                        (exact_dedup.op12_exact_dedup, exact_dedup.OP12_SQL),
                                        (lexical.op13_lexical_search, lexical.OP13_SQL)])
def test_queries_equal_their_sql(spark, query, sql):
    assert same_as_sql(spark, query, sql)


# ---- collocations ---------------------------------------------------------------------------

def brute_collocations(rows, min_count, max_words, top, absorbed=100):
    count, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            count.update((lang, tuple(words[i:i + k])) for k in range(1, max_words + 1)
                         for i in range(len(words) - k + 1))
    good = {key: a for key, a in count.items() if len(key[1]) > 1 and a >= min_count}
    gone = {(lang, p[i:j]) for (lang, p), a in good.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1)
            if j - i < len(p) and 100 * a >= absorbed * count[lang, p[i:j]]}
    out = defaultdict(list)
    for (lang, p), a in good.items():
        if (lang, p) in gone:
            continue
        cuts = []
        for k in range(1, len(p)):
            left, right = count[lang, p[:k]], count[lang, p[k:]]
            cuts.append((1000 * a * n[lang] // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        out[lang].append((-score, -a, " ".join(p).encode(), left, right))
    return {(lang, rank, p.decode(), -a, left, right, n[lang], -s) for lang, found in out.items()
            for rank, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1)}


def phrase_rows():
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(12)] + ["É", "Über", "a'b", "ROT"]
    rows = []
    for i in range(160):
        picked = [words[int(x)] for x in rng.zipf(1.6, 60) % len(words)]
        marks = [str(m) for m in rng.choice([" ", " ", " ", "\t ", ". ", "\n", "\x0b", ", ", "! "], 60)]
        rows.append((["en", "de", None, ""][i % 4], "".join(w + m for w, m in zip(picked, marks))))
    return rows + [("en", None), (None, ""), ("fr", " \t ..;"), ("en", "one two three four five " * 700 + "x")] * 2


@pytest.mark.parametrize("bound, packed", [(500_000, 1 << 31), (3, 2)])
@pytest.mark.parametrize("absorbed", [100, 60])
def test_collocations_equal_brute_force(spark, monkeypatch, bound, packed, absorbed):
    monkeypatch.setattr(collocations, "PACKED", packed)
    monkeypatch.setattr(collocations, "CHUNK", 16)
    monkeypatch.setattr(collocations, "FLUSH", 500)
    rows = phrase_rows()
    df = spark.createDataFrame(rows, "lang string, text string").repartition(12)     # several files a task
    got = collocations.collocations(df, min_count=20, top=40, absorbed=absorbed, bound=bound).collect()
    want = brute_collocations(rows, 20, 5, 40, absorbed)
    assert {tuple(r) for r in got} == want and len(got) == len(want) and len(want) > 40


def test_products_beyond_64_bits_are_exact(spark):
    big = spark.createDataFrame([(10**13, 3 * 10**13 + 1, 7 * 10**6 + 3, 10**12 + 7)], "f long, n long, l long, r long")
    got = big.selectExpr("(cast(1000 as decimal(38,0)) * f * n) div (cast(l as decimal(38,0)) * r) as s").first().s
    assert got == 1000 * 10**13 * (3 * 10**13 + 1) // ((7 * 10**6 + 3) * (10**12 + 7))


# ---- exact dedup ----------------------------------------------------------------------------

def brute_copies(rows):
    groups = defaultdict(list)
    for i, (doc, text) in enumerate(rows):
        groups[text or ""].append((-math.inf if doc is None else doc, i, doc))
    out = Counter()
    for text, members in groups.items():
        top = max(members)
        for m in members:
            out[(m[2], top[2], len(members), m == top, hashlib.sha256(text.encode()).hexdigest())] += 1
    return out


def copy_rows():
    hot = "a text that a third of the rows share " * 20
    rows = [(i, hot if i % 3 == 0 else f"text {i % 40} of some" if i % 3 == 1 else f"alone {i}") for i in range(900)]
    return rows + [(None, hot), (None, "null twice"), (None, "null twice"), (5000, None), (5001, ""), (5002, "É"),
                   (5002, "É"), (5003, "É"), (5003, "É"), (5004, "é"), (5005, "x" * 300_000), (5006, "x" * 300_000)]


@pytest.mark.parametrize("digest", [exact_dedup._digest, lambda t: F.char_length(t).cast("long")])
@pytest.mark.parametrize("bound", [500_000, 2])
def test_copies_equal_brute_force_also_with_colliding_digests(spark, monkeypatch, digest, bound):
    monkeypatch.setattr(lookup, "__defaults__", (lookup.__defaults__[0], bound))
    rows = copy_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = Counter(tuple(r) for r in exact_dedup.copies(df, digest=digest, salts=3).collect())
    assert got == brute_copies(rows)
    left = exact_dedup.drop_copies(df, digest=digest).collect()
    assert Counter((r.doc_id, r.text or "") for r in left) == Counter(
        (k[0], next(t or "" for d, t in rows if hashlib.sha256((t or "").encode()).hexdigest() == k[4]))
        for k, n in brute_copies(rows).items() if k[3])


def test_no_text_is_hot_after_the_local_stage(spark):
    df = spark.range(40_000).selectExpr("id AS doc_id", "if(id % 3 = 0, 'hot', concat('t', id % 5000)) AS text")
    rows = exact_dedup._rows(df.repartition(8), "doc_id", "text", exact_dedup._digest)
    groups = exact_dedup.text_groups(rows)
    plan = groups._jdf.queryExecution().executedPlan().toString()
    assert "salt" in plan and {r.text: r.group_size for r in groups.collect()}["hot"] == 13_334


# ---- ranked search --------------------------------------------------------------------------

def brute_search(docs, items, k):
    def terms(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))

    bags = [(doc, Counter(terms(t))) for doc, t in docs]
    bags = [(doc, b) for doc, b in bags if b]
    n_docs, n_terms = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = Counter()
    for item, text in items:
        found = []
        for doc, b in bags:
            m = 100 - 90 + (90 * sum(b.values()) * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * ((1_000_000_000 * b[t]) // (1000 * b[t] + 8 * m)) for t in set(terms(text)) & set(b))
            if score > 0:
                found.append((-score, math.inf if doc is None else doc, doc))
        for rank, (s, _, doc) in enumerate(sorted(found, key=lambda x: x[:2])[:k], 1):
            out[(item, rank, doc, -s)] += 1
    return out


def search_tables(spark):
    rng = np.random.default_rng(8)
    docs = [(i, H.prose(rng, int(n), 90)) for i, n in enumerate(rng.integers(1, 60, 300))]
    docs += [(1000 + i, docs[i][1]) for i in range(60)]                      # equal scores
    docs += [(None, docs[3][1]), (7, docs[7][1]), (2000, None), (2001, ""), (2002, " -- "), (2003, "ÉCLAIR éclair 42x"),
             (2004, H.prose(rng, 20_000, 90))]
    items = [(i, H.prose(rng, int(n), 90)) for i, n in enumerate(rng.integers(1, 25, 40))]
    items += [(3, items[3][1]), (None, items[4][1]), (100, None), (101, "..."), (102, "Éclair, nothing else"), (103, "unheardof")]
    return docs, items


@pytest.mark.parametrize("bound, block, leaves", [(500_000, 100_000, (32, 8)), (5, 60, (4, 2))])
def test_search_equals_brute_force(spark, monkeypatch, bound, block, leaves):
    monkeypatch.setattr(lexical, "LEAF_DOCS", leaves[0])
    monkeypatch.setattr(lexical, "LEAF_ITEMS", leaves[1])
    docs, items = search_tables(spark)
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = lexical.search(d, spark.createDataFrame(items, "item_id long, text string"), bound=bound, block_terms=block)
    assert Counter(tuple(r) for r in got.collect()) == brute_search(docs, items, 10)


def test_bounds_prune_whole_batches():
    """Two vocabularies that never meet: traversal leaves out the pairs between them, and more with seeds."""
    rng = np.random.default_rng(1)
    terms = np.concatenate([rng.choice(50, 12, False) + 50 * (r % 2) for r in range(512)])
    docs = lexical.Documents(np.arange(512), np.arange(513) * 12, terms, rng.integers(1, 9, len(terms)), 100)
    asked = np.concatenate([rng.choice(50, 6, False) + 50 * (r % 2) for r in range(64)])

    def items(floor):
        return lexical.Items(np.arange(65) * 6, asked, np.ones(100, np.int64), floor, 10)

    def leaves(root):
        return sum(not n.children for n in lexical._walk(root))

    scored, real = [], docs.score
    docs.score = lambda *a: scored.append(1) or real(*a)
    plain = items(np.zeros(64, np.int64))
    seen = lexical.traverse(plain, docs), len(scored)
    scored.clear()
    seeded = items(plain.least)
    assert lexical.traverse(seeded, docs) <= seen[0] and len(scored) <= seen[1]
    assert seen[1] <= 0.6 * leaves(docs.root) * leaves(plain.root)
    assert all((a[0] == b[0]).all() and (a[1] == b[1]).all() for a, b in zip(plain.best, seeded.best))


# ---- awkward tables -------------------------------------------------------------------------

def test_awkward_and_empty_tables(spark, tmp_path):
    docs = H.awkward(spark, [(8, "tie " * 150, "en", "a", 0)])
    for name in ("row", "part", "salt", "keep_id", "group_size", "kept", "beaten", "stays", "sha", "copied", "text_sha256",
                 "item", "item_id", "term", "terms", "tf", "tfs", "n", "rank", "score", "block", "w", "df", "docs", "p",
                 "chunk", "pos", "phrase", "prefix", "suffix", "f", "head", "last", "starts", "ends", "word", "words", "a", "l", "r"):
        if name not in docs.columns:
            docs = docs.selectExpr("*", f"'clash' AS {name}")
    bench = spark.createDataFrame([(1, None), (None, "tie words"), (3, "WORD1")], "item_id long, text string") \
        .selectExpr("*", "1 AS doc_id", "2 AS score", "3 AS item")
    folder = H.write_tables(spark, tmp_path / "a", documents=docs, benchmark=bench)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = Counter(tuple(r) for r in exact_dedup.op12_exact_dedup(spark, folder).collect())
    assert got == brute_copies(rows)
    read = spark.read.parquet(f"{folder}/documents.parquet")
    assert exact_dedup.drop_copies(read).columns == read.columns
    assert exact_dedup.drop_copies(read).count() == sum(k[3] for k in got.elements())
    found = Counter(tuple(r) for r in lexical.op13_lexical_search(spark, folder).collect())
    assert found == brute_search(rows, [(1, None), (None, "tie words"), (3, "WORD1")], 10)
    langs = [(r.lang, r.text) for r in docs.select("lang", "text").collect()]
    assert {tuple(r) for r in collocations.op11_collocations(spark, folder).collect()} == brute_collocations(langs, 100, 5, 2000)
    empty = H.write_tables(spark, tmp_path / "b", documents=docs.limit(0), benchmark=bench.limit(0))
    for query in (exact_dedup.op12_exact_dedup, lexical.op13_lexical_search, collocations.op11_collocations):
        assert query(spark, empty).count() == 0
