"""The registered queries: whole results against SQL where there is some, and the pipeline."""

import os

import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from tallyroll.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    if not os.path.isdir(SF_DIR):
        pytest.skip("no test tables")
    con = duckdb.connect()
    for name in ("documents", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def test_all_are_registered():
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in QUERIES}
    assert {*QUERIES, "pipeline"} <= queries().keys() and ORACLES.items() <= oracle_sql().items()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    expected = duck.execute(ORACLES[name])
    names = [d[0] for d in expected.description]
    result = QUERIES[name](spark, SF_DIR)
    assert sorted(result.columns) == sorted(names)
    assert sorted(map(tuple, result.select(*names).collect())) == sorted(expected.fetchall())


def test_pipeline(spark):
    docs = start = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs, before = corpus_pipeline.stored(stage(spark, docs, SF_DIR), "test-stage"), docs
        assert docs.columns == start.columns and 0 < docs.count() <= before.count()
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    totals = {r[0]: r[1:] for r in pieces.groupBy("doc_id").agg({"length": "sum", "doc_tokens": "max"}).collect()}
    assert totals.keys() == {r.doc_id for r in docs.select("doc_id").collect()}
    assert all(a == b for a, b in totals.values())
    again = corpus_pipeline.run(spark, SF_DIR)
    key = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    assert sorted(map(tuple, again.select("doc_id", "doc_tokens").distinct().collect())) == sorted(
        map(tuple, pieces.select("doc_id", "doc_tokens").distinct().collect())
    )
    assert set(key) <= set(again.columns)
