"""Queries that read every row and whole texts."""

from pathlib import Path

import pytest

from inkmill import catalogue

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test data")


def test_whole_texts_are_compiled(spark):
    docs = {r["doc_id"]: r["text"].replace('"', " ").split() for r in spark.read.parquet(str(DATA / "documents.parquet")).collect()}
    got = {r["doc_id"]: r["compiled"] for r in catalogue.queries()["s4_query_compile"](spark, str(DATA)).collect()}
    assert set(got) == set(docs)
    assert all(word in got[d] for d, words in docs.items() for word in words)


def test_every_row_is_in_a_scan(spark):
    seqs = {r["doc_id"] for r in spark.read.parquet(str(DATA / "documents.parquet")).select("doc_id").collect()}
    got = catalogue.queries()["s9_union_scan"](spark, str(DATA)).collect()
    assert all({r["seq"] for r in got if r["scan"] == i} == seqs for i in (0, 1)) and len(got) == 2 * len(seqs)
