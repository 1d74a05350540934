import os

import pytest

import corpus_pipeline
from llm import registry
from llm.common import stage
from tests.llm.test_dedup import brute_components, normal
from tests.llm.test_text import brute_hits
from tests.oracle_run import connect, rows_of

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not here")


@pytest.mark.parametrize("name", list(registry.oracle_sql()))
def test_query_matches_sql(spark, name):
    df = registry.queries()[name](spark, SF_DIR)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    found = connect(SF_DIR).execute(registry.oracle_sql()[name])
    columns = [d[0] for d in found.description]
    assert sorted(columns) == sorted(df.columns)
    assert got == rows_of(columns, found.fetchall())


@pytest.mark.parametrize("name", sorted(registry.queries().keys() - registry.oracle_sql().keys()))
def test_query_covers_its_table(spark, name):
    df = registry.queries()[name](spark, SF_DIR)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert df.select("doc_id").distinct().count() == docs.count()


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    columns = docs.columns
    for name, function in corpus_pipeline.STAGES:
        before = sorted((r.doc_id, r.text) for r in docs.collect())
        docs = stage(function(spark, docs, SF_DIR), name)
        after = sorted(r.doc_id for r in docs.collect())
        if name != "bpe":
            assert docs.columns == columns
        if name == "exact_dedup":
            first = {}
            for doc, text in before:
                first.setdefault(normal(text), doc)
            assert after == sorted(first.values())
        elif name == "near_dedup":
            assert after == sorted(r[0] for r in brute_components(before, 5, 80) if r[3])
        elif name == "decontamination":
            assert after == sorted(r[0] for r in brute_hits(before, bench, 10) if not r[2])
        elif name == "bpe":
            assert after == [x[0] for x in before]
