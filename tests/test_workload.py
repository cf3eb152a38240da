"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from conftest import SMALL
from tallygraph.workload import ORACLES, QUERIES, inputs

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return connection


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_point.queries()) and set(ORACLES) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_query_agrees_with_sql(spark, database, name):
    found = QUERIES[name](spark, SMALL)
    expected = database.sql(ORACLES[name])
    columns = sorted(found.columns)
    assert columns == sorted(expected.columns)
    assert sorted(map(tuple, found.select(columns).collect())) == sorted(
        expected.select(*(f'"{column}"' for column in columns)).fetchall()
    )


def test_entry(spark):
    result = entry_point.entry(spark)
    assert result.columns == ["doc_id", "score"]
    assert result.count() == 10


def test_order_lines_come_in_small_tasks(spark, monkeypatch):
    """However few the shuffle partitions are."""
    monkeypatch.setattr(inputs, "TASK_LINES", 300)
    found = inputs.baskets(spark, SMALL).groupBy(F.spark_partition_id()).count()
    sizes = [row["count"] for row in found.collect()]
    assert len(sizes) >= 18 and max(sizes) < 600
