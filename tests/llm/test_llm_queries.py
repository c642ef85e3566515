"""The registered queries of the subpackage against their SQL, and the pipeline from end to end."""

import pytest

import corpus_pipeline
from checks.compare import compare, connection
from statuslight.llm import queries


@pytest.mark.parametrize("key", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, small, key):
    outcome, _ = compare(spark, connection(small), small, key, queries.ORACLES[key], queries.QUERIES[key])
    assert outcome.startswith("equal") and not outcome.endswith(": 0"), outcome


def test_pipeline_encodes_documents(spark, small):
    found = corpus_pipeline.run(spark, small)
    rows = found.collect()
    assert found.columns == ["doc_id", "n_tokens", "ids_crc32", "text_crc32", "round_trip"]
    documents = spark.read.parquet(f"{small}/documents.parquet").count()
    assert 0 < len({r.doc_id for r in rows}) <= documents and all(r.round_trip for r in rows)
