"""The registered text queries against their SQL, and the pipeline's stages."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

import corpus_pipeline
from pharmavane.llm import queries

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def content(arrow):
    columns = sorted(arrow.column_names)
    return columns, sorted(zip(*[[repr(v) for v in arrow.column(c).to_pylist()] for c in columns]))


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, name):
    found = queries.QUERIES[name](spark, SF).toArrow()
    table = {"op4": "embeddings", "op6": "conversations", "op13": "embeddings"}.get(name.split("_")[0], "documents")
    if name in queries.ORACLE_SQL:
        connection = duckdb.connect()
        for path in glob.glob(f"{SF}/*.parquet"):
            connection.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
        assert content(found) == content(connection.sql(queries.ORACLE_SQL[name]).to_arrow_table())
    elif name == "op11_packing":  # a row for each piece
        assert found.num_rows >= spark.read.parquet(f"{SF}/{table}.parquet").count()
    else:
        assert found.num_rows == spark.read.parquet(f"{SF}/{table}.parquet").count()


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = corpus_pipeline.staged(stage(spark, docs, SF), "test")
        counts.append(docs.count())
        assert k == len(corpus_pipeline.STAGES) - 1 or docs.columns == columns
    assert counts[0] >= counts[1] == counts[2] >= counts[3] > 0 and counts[4] == counts[5]
    assert corpus_pipeline.run(spark, SF).count() == counts[5]
