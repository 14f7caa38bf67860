import hashlib

import duckdb
import pytest

import __spark_entry__
import corpus_pipeline
from chargepulse.llm import queries
SF_SMALL = "/root/testdata/sf0.001"


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_SMALL)
        assert out.columns == docs.columns
        assert 0 < out.count() <= docs.count()
        docs = out
    rows = corpus_pipeline.encode_stage(spark, docs, SF_SMALL).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert {r.doc_id: r.decoded_sha256 for r in rows} == {
        i: hashlib.sha256((t or "").encode()).hexdigest() for i, t in texts.items()}


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("pages", "embeddings", "conversations", "documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    rel = con.sql(queries.oracle_sql()[name])
    got = queries.queries()[name](spark, SF_SMALL)
    assert sorted(got.columns) == sorted(rel.columns)
    assert sorted(map(repr, map(tuple, got.select(*rel.columns).collect()))) == sorted(map(repr, rel.fetchall()))


def test_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14))
