"""Every named query against its SQL in DuckDB, on the smallest sample."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_point
from millrace.registry import queries as registry

FOLDER = "/root/testdata/sf0.001"
SQL = entry_point.oracle_sql()
QUERIES = {name: query for name, query in entry_point.queries().items() if name in SQL}
TYPES = {"INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean"}


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for path in Path(FOLDER).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def ordered(rows):
    return sorted(rows, key=lambda row: tuple((v is None, v if v is not None else 0) for v in row))


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, oracle, name):
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    result = oracle.execute(SQL[name])
    names = [c[0] for c in result.description]
    kinds = {c[0]: TYPES[str(c[1])] for c in result.description}
    assert sorted(names) == columns
    assert kinds == dict(df.dtypes)
    positions = [names.index(c) for c in columns]
    expected = [tuple(row[i] for i in positions) for row in result.fetchall()]
    assert ordered(tuple(row) for row in df.select(*[f"`{c}`" for c in columns]).collect()) == ordered(expected)


def test_every_query_has_sql():
    """All but those of the optional text operators, which are tested next to them."""
    assert set(SQL) == set(QUERIES)
    assert set(registry.all_queries()) <= set(SQL)


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.columns == ["TerritoryName", "ProductName", "Category", "TotalRevenue", "TotalQty", "RankInTerritory"]
    assert df.count() > 0
