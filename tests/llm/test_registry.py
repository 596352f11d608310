"""The registered queries: those with SQL against it, and the pipeline end to end."""

import pytest

import corpus_pipeline
from tallyline.llm import registry
from tests.compare import connect, difference


@pytest.mark.parametrize("name", registry.oracle_sql())
def test_query_with_sql(spark, sf, name):
    assert difference(registry.queries()[name](spark, sf), connect(sf), registry.oracle_sql()[name]) is None


def test_every_operator_has_a_query():
    assert {int(name[2:].split("_")[0]) for name in registry.queries()} == set(range(1, 14))


def test_pipeline(spark, sf):
    documents = spark.read.parquet(f"{sf}/documents.parquet")
    docs = documents
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf)
        assert docs.columns == documents.columns
    want = sorted((r[0] for r in docs.select("doc_id").collect()))
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, sf).collect()) == want
    assert set(want) < {r[0] for r in documents.select("doc_id").collect()}
