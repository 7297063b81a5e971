"""Stages on rows of all kinds, on no rows, and beside columns that operators use inside."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from brimline.llm import secret_scan, simhash

CLASHING = ["_span_id", "_span_t", "_span_s", "_keep_id", "_keep_hash", "_text_hash", "_text_hash_", "_verdict", "_row", "_h", "root", "component_id", "probability"]


def clashing(docs):
    return docs.withColumns({c: F.lit(c) for c in CLASHING})


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stage_edges(spark, edge_docs, no_docs, name, stage):
    assert stage.__doc__
    docs = clashing(edge_docs)
    out = stage(spark, docs, None)
    last = name == corpus_pipeline.STAGES[-1][0]
    rows = out.collect()
    assert rows
    if not last:
        assert out.columns == docs.columns and len(rows) <= docs.count()
        assert all(r[c] == c for r in rows for c in CLASHING)
        ids = {r.doc_id for r in docs.select("doc_id").collect()}
        assert {r.doc_id for r in rows} <= ids
    empty = stage(spark, clashing(no_docs), None)
    assert empty.count() == 0 and (last or empty.columns == docs.columns)


def test_masking_keeps_clashing_columns(spark):
    rows = [(1, "password=abcdefghijkl1234 and more"), (2, None), (None, "secret: zyxwvutsrqponmlk"), (3, "")]
    docs = clashing(spark.createDataFrame(rows, "doc_id long, text string"))
    out = {r.doc_id: r for r in secret_scan.masked(docs, None).collect()}
    assert {i: r.text for i, r in out.items()} == {1: "[SECRET] and more", 2: None, None: "[SECRET]", 3: ""}
    assert all(r[c] == c for r in out.values() for c in CLASHING)


def test_one_of_each_keeps_clashing_columns(spark):
    text = "one two three four five six seven eight nine ten"
    docs = clashing(spark.createDataFrame([(5, text), (4, text), (4, text), (9, "other words that are quite unlike the first")], "doc_id long, text string"))
    rows = simhash.one_of_each(docs).collect()
    assert sorted(r.doc_id for r in rows) == [4, 9] and all(r[c] == c for r in rows for c in CLASHING)
