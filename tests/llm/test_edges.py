"""Awkward and empty tables through every operator, every stage and the pipeline."""

import hashlib
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
import helpers as H  # noqa: E402

import corpus_pipeline  # noqa: E402
from orchard.llm import decontaminate, line_dedup, ngram_join, packing, pii, quality, suffix_dedup, toxicity  # noqa: E402
from orchard.llm.common import components  # noqa: E402


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("awkward")
    docs = H.awkward(spark, [(8, "idiot " * 40, "en", "a", 0), (9, "one line that two documents share\nother", "en", "a", 1),
                             (10, "one line that two documents share\nmore", "xx", None, 1)])
    labels = H.labels(spark, [(1, 1, 0), (1, 0, 1), (2, None, None), (None, 1, 1), (7, 1, 0), (8, 1, 1), (9, 1, 0), (99, 0, 1)])
    bench = spark.createDataFrame([(1, None), (2, ""), (None, "words in one line that is long"), (3, "abc")],
                                  "item_id long, text string").selectExpr("*", "1 AS doc_id", "2 AS start")
    return H.write_tables(spark, path, documents=docs, labels=labels, benchmark=bench)


@pytest.fixture(scope="module")
def nothing(spark, tmp_path_factory):
    return H.write_tables(spark, tmp_path_factory.mktemp("empty"),
                          documents=spark.createDataFrame([], H.DOC_DDL), labels=H.labels(spark),
                          benchmark=spark.createDataFrame([], "item_id long, text string"))


def ids(rows):
    return sorted((r["doc_id"] for r in rows), key=lambda x: (x is None, x))


ALL = [1, 2, 3, 4, 5, 6, 7, 7, 8, 9, 10, None]


def test_quality(spark, folder, nothing):
    rows = quality.op1_kneser_ney_quality(spark, folder).collect()
    assert ids(rows) == sorted(set(ALL) - {None}) + [None]         # equal rows are reported once
    by = {r["doc_id"]: r for r in rows}
    assert by[2]["keep"] and by[3]["keep"] and by[2]["perplexity"] is None and by[2]["n_bytes"] == 0
    assert quality.op1_kneser_ney_quality(spark, nothing).count() == 0


def test_toxicity(spark, folder, nothing):
    rows = toxicity.op2_ftrl_toxicity(spark, folder).collect()
    assert ids(rows) == ALL and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] in (2, 3)}) == 1
    assert toxicity.op2_ftrl_toxicity(spark, nothing).count() == 0


def test_decontamination(spark, folder, nothing):
    rows = decontaminate.op5_qgram_decontamination(spark, folder).collect()
    assert [(r["doc_id"], r["item_id"], r["start"], r["end"], r["edits"]) for r in rows] == [(1, None, 6, 36, 0)]
    assert decontaminate.op5_qgram_decontamination(spark, nothing).count() == 0


def test_line_dedup(spark, folder, nothing):
    rows = line_dedup.op6_line_dedup(spark, folder).collect()
    assert ids(rows) == ALL
    lost = {r["doc_id"]: (r["n_exact"], r["n_near"]) for r in rows if r["n_exact"] or r["n_near"]}
    assert lost == {10: (1, 0)}                         # equal rows are one document: neither loses
    by = {r["doc_id"]: r for r in rows}
    assert by[2]["text_sha256"] is None and by[2]["n_lines"] == 0
    assert by[3]["text_sha256"] == hashlib.sha256(b"").hexdigest() and by[3]["n_lines"] == 1
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert line_dedup.dedup_lines(docs).columns == [*docs.columns, "lines"]
    assert line_dedup.op6_line_dedup(spark, nothing).count() == 0


def test_personal_data(spark, folder, nothing):
    rows = pii.op7_pii(spark, folder).collect()
    assert ids(rows) == ALL and all(r["spans"] == "" for r in rows)
    assert all(r["base_sha256"] == hashlib.sha256(b"").hexdigest() for r in rows)
    assert ids(pii.sanitise(spark.read.parquet(f"{folder}/documents.parquet")).collect()) == ALL
    assert pii.op7_pii(spark, nothing).count() == 0


def test_jaccard_join(spark, folder, nothing):
    rows = ngram_join.op8_prefix_tree_join(spark, folder).collect()
    assert ids(rows) == ALL
    by = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows}
    assert by[2] == (0, 2) and by[3] == (0, 3) and by[5] == by[6] == (1, 5) and by[7][1] == 7
    assert by[None][1] is None
    assert ngram_join.op8_prefix_tree_join(spark, nothing).count() == 0


def test_packing(spark, folder, nothing):
    rows = packing.op9_best_fit_packing(spark, folder).collect()
    assert sorted({r["doc_id"] for r in rows} - {None}) == sorted(set(ALL) - {None})
    assert sum(r["doc_id"] == 7 for r in rows) == 2
    assert [r["length"] for r in rows if r["doc_id"] in (2, 3)] == [1, 1]
    assert packing.op9_best_fit_packing(spark, nothing).count() == 0


def test_suffix_dedup(spark, folder, nothing):
    rows = suffix_dedup.op10_suffix_dedup(spark, folder).collect()
    assert ids(rows) == ALL
    by = {r["doc_id"]: r for r in rows}
    assert (by[2]["n_bytes"], by[2]["n_removed"], by[2]["n_spans"]) == (0, 0, 0)
    assert suffix_dedup.op10_suffix_dedup(spark, nothing).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(3, 3), (None, 4), (7, 5), (5, 7), (9, 7)] + [(1000 + i, 1000) for i in range(50)]
    got = {r["id"]: r["component_id"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 100 for i in range(100, 161)} | {5: 5, 7: 5, 9: 5} | {1000 + i: 1000 for i in range(50)}
    assert got == want


def test_every_stage(spark, folder, nothing, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        alone = stage(spark, spark.read.parquet(f"{folder}/documents.parquet"), folder)
        if i < 4:
            assert alone.columns == docs.columns, name
            assert {2, 3, 4, None} <= {r["doc_id"] for r in alone.select("doc_id").collect()}, name
        assert stage(spark, spark.read.parquet(f"{nothing}/documents.parquet"), nothing).count() == 0, name
    out = corpus_pipeline.run(spark, folder).collect()
    assert {r["doc_id"] for r in out} >= {2, 3, 4, 9, None} and 6 not in {r["doc_id"] for r in out}
    assert corpus_pipeline.run(spark, nothing).count() == 0


def test_line_stage_takes_a_column_named_lines(spark):
    text = "a line of some length that is met twice\nanother"
    docs = spark.createDataFrame([(1, text, "x", "y"), (2, text + "\nmore", "x", "y")],
                                 "doc_id long, text string, lines string, lines_ string")
    kept = corpus_pipeline.line_stage(spark, docs, "")
    assert kept.columns == docs.columns
    assert [tuple(r) for r in kept.orderBy("doc_id").collect()] == [(1, text, "x", "y"), (2, "more", "x", "y")]
    with pytest.raises(ValueError):
        line_dedup.dedup_lines(docs)


def test_stages_drop_what_they_should(spark, tmp_path):
    text = "the first line of a text that is long enough\nand a second line of it that is long as well"
    docs = spark.createDataFrame([(1, text, "en", "s", len(text)), (2, text, "en", "s", len(text)),
                                  (3, text.replace("second", "sekond") + "\nthird line", "en", "s", 1)], H.DOC_DDL)
    kept = corpus_pipeline.line_stage(spark, docs, "").collect()
    assert {r["doc_id"]: r["text"] for r in kept} == {1: text, 3: "third line"}
    assert {r["doc_id"]: r["n_chars"] for r in kept} == {1: len(text), 3: 10}
    assert {r["doc_id"] for r in corpus_pipeline.near_stage(spark, docs, "").collect()} == {1, 3}
