"""The registered queries with SQL, and the pipeline, over the smallest data."""

from __future__ import annotations

import pytest

import corpus_pipeline
from check import compare, duck
from tagwright.llm import queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_matches_sql(spark, name):
    ok, text = compare(spark, duck(SF_DIR), name, SF_DIR)
    assert ok, text


def test_pipeline_keeps_columns_and_decides(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    counts = [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.write_shared(stage(spark, docs, SF_DIR))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        counts.append(docs.count())
    assert counts[1] < counts[0] and counts[2] < counts[1] and counts[3] < counts[2]
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    assert out.count() == counts[-1]
