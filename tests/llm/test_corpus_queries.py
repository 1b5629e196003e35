"""The corpus queries against their SQL twins, and the pipeline stage by stage."""

from __future__ import annotations

import corpus_pipeline
import pytest
from compare import compare, connect
from strataload.llm import neardup, queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, name):
    assert compare(spark, connect(SF_DIR), SF_DIR, queries.QUERIES[name], queries.oracle_sql()[name]) is None


def test_pipeline(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, texts = docs.columns, None
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF_DIR).write.parquet(f"{tmp_path}/{k}")
        out = spark.read.parquet(f"{tmp_path}/{k}")
        if k < 4:
            assert out.columns == columns
            rows = {r.doc_id: r.text for r in out.collect()}
        if name == "exact dedup":
            assert len({t.lower() for t in rows.values()}) == len(rows)
        if name == "MinHash near-dedup":
            sets = [neardup.shingles(t) for t in rows.values()]
            assert not any(100 * len(a & b) >= 75 * len(a | b) for i, a in enumerate(sets) for b in sets[:i] if a and b)
        docs = out
    assert {r.doc_id for r in docs.select("doc_id").distinct().collect()} == set(rows)
