"""The queries that SQL can express, against their SQL on the smallest tables."""

import duckdb
import pytest

from tallygraph.llm.oracles import ORACLES
from tallygraph.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ORACLES)
def test_query_agrees_with_sql(spark, name):
    found = QUERIES[name](spark, SMALL)
    database = duckdb.connect()
    for table in ("documents", "conversations", "benchmark"):
        database.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    columns = sorted(found.columns)
    expected = database.execute(f"SELECT {', '.join(columns)} FROM ({ORACLES[name]})").fetchall()
    assert sorted(map(tuple, found.select(columns).collect()), key=repr) == sorted(expected, key=repr)


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLES])
def test_one_row_per_document_and_stable_columns(spark, name):
    found = QUERIES[name](spark, SMALL)
    rows = found.count()
    table = "pages" if "page_id" in found.columns else "documents"
    total = spark.read.parquet(f"{SMALL}/{table}.parquet").count()
    assert rows >= total if name.startswith("op4") else rows == total
