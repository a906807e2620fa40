"""Collocations: look-ups of more phrases than travel one by one."""

import os
import sys

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from test_phrases_copies_search import brute_collocations  # noqa: E402

from orchard.llm import collocations  # noqa: E402
from orchard.llm.common import Powers  # noqa: E402


def test_600_000_phrases_are_found_without_moving_an_occurrence(spark):
    bound = collocations.collocations.__defaults__[-1]
    phrases = spark.range(600_000).selectExpr("id div 1000 as prefix", "id % 1000 as suffix", "id + 7 as id", "100L as f")
    rows = [(0, [0, 1, 2, 4], [599, 999, 3, 5]), (1, [0, 1], [600, 1]), (2, [5, 6], [0, 0])]
    relation = spark.createDataFrame(rows, collocations._RELATION)
    found = collocations.next_relation(relation, phrases, bound)
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    assert {(r.chunk, tuple(r.pos), tuple(r.id)) for r in found.collect()} == {(0, (0,), (600_006,)), (2, (5,), (7,))}


def test_known_words_are_compared_as_strings(monkeypatch):
    names, ids = pa.array(["b", "", "naïve", "a", "ab"]), np.array([4, 9, 2, 7, 5])
    words = pa.array(["x", "ab", "a", "zz", "naïve", "", "b", "na"])
    want = [-1, 5, 7, -1, 2, 9, 4, -1]

    def numbers():
        powers = Powers()
        return collocations._Known(names, ids, powers).of(words[:], collocations._hashes(words, powers)).tolist()

    assert numbers() == want
    part = pa.array(["skipped", "ab", "q", "a"]).slice(1, 2)                  # a slice hashes like a copy
    assert collocations._hashes(part, Powers()).tolist() == collocations._hashes(pa.array(["ab", "q"]), Powers()).tolist()
    real = collocations.span_hashes
    monkeypatch.setattr(collocations, "span_hashes", lambda *a: real(*a) % np.uint64(2))
    assert numbers() == want                                                  # hashes of known words collide


@pytest.mark.parametrize("flush", [1, 400_000])
def test_word_counts_are_combined_over_runs(spark, monkeypatch, flush):
    monkeypatch.setattr(collocations, "RUN_BYTES", 40)
    monkeypatch.setattr(collocations, "FLUSH", flush)
    rows = [("en" if i % 3 else None, "a b. a c" if i % 2 else "B, é a") for i in range(40)] + [("en", None), ("de", "")]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    got = {(r.lang, r.word): r.f for r in collocations.word_counts(collocations._source(df, "lang", "text")).collect()}
    want = {}
    for lang, text in rows:
        for word in (text or "").replace(".", " ").replace(",", " ").split():
            key = (lang or "und", word.lower())
            want[key] = want.get(key, 0) + 1
    assert got == want
    found = collocations.collocations(df, min_count=3, top=40).collect()
    assert {tuple(r) for r in found} == brute_collocations(rows, 3, 5, 40)
