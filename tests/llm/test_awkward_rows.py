"""Null ids, rows given twice and columns of nulls: every operator returns what its docstring defines."""

from __future__ import annotations

import hashlib
from collections import Counter

import pytest

import corpus_pipeline
from trailcheck.llm.common import documents
from trailcheck.llm.queries import QUERIES

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars int, text_sha256 string, kept boolean, shard int, cluster bigint"
LONG = " ".join(f"word{k} the rain of stone{k % 7}" for k in range(60))
ROWS = [(None, LONG, "en", "hot"), (None, None, None, None), (None, "a short text", "en", None), (1, LONG, "en", "hot"), (1, LONG, "en", "hot"),
        (2, LONG + " end", None, "hot"), (3, "a short text", "en", "s"), (4, "", "en", None), (5, None, None, "s"), (6, "ein anderer Satz", "de", "s")]


@pytest.fixture(scope="module")
def awkward(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("awkward"))
    spark.createDataFrame([(i, t, lang, src, len(t or ""), None, None, None, None) for i, t, lang, src in ROWS], SCHEMA).write.parquet(f"{at}/documents.parquet")
    pages = [(None, "http://h", "<p>x</p>"), (1, None, "<p>x</p>"), (2, "http://h", None), (2, "http://h", None), (3, "", "")]
    spark.createDataFrame(pages, "page_id bigint, url string, html string").write.parquet(f"{at}/pages.parquet")
    return at


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"op10_token_counts", "op5_warc_archive", "op11_conversation_repair", "op12_decontamination", "op13_hard_negatives"}))
def test_ids_of_rows(spark, awkward, name):
    found = Counter(r.doc_id for r in QUERIES[name](spark, awkward).collect())
    assert set(found) == {i for i, *_ in ROWS}
    if name != "op1_best_fit_packing":  # one row a piece there
        assert found[3] == found[4] == found[5] == found[6] == 1


def test_pages_with_nulls(spark, awkward):
    found = QUERIES["op5_warc_archive"](spark, awkward).collect()
    assert {r.page_id for r in found} == {None, 1, 2, 3}
    assert {r.payload_bytes for r in found if r.page_id in (2, 3)} == {0}


def test_counts_hold_every_row(spark, awkward):
    assert sum(r.n_docs for r in QUERIES["op10_token_counts"](spark, awkward).collect()) == len(ROWS)


def test_copies_with_null_ids(spark, awkward):
    found = QUERIES["op7_exact_dedup"](spark, awkward).collect()
    assert len(found) == len(ROWS)
    long = hashlib.sha256(LONG.encode()).hexdigest()
    assert {(r.keep_id, r.group_size) for r in found if r.text_sha256 == long} == {(1, 3)}


def test_pipeline_stages_take_null_ids(spark, awkward):
    docs = documents(spark, awkward)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, awkward)
        if name != "best_fit_packing":
            assert out.columns == docs.columns, name
        out.collect()
