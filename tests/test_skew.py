"""Queries against SQL on tables where one order, product, vendor, customer, user and nation hold a third of the rows."""

import shutil
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_point

SOURCE = Path("/root/testdata/sf0.001")
HOT = {
    "lineitem": "CASE WHEN hash(l_linenumber, l_partkey, l_shipdate) % 3 = 0 THEN 4 ELSE l_orderkey END AS l_orderkey, "
    "CASE WHEN hash(l_partkey, l_shipdate) % 3 = 0 THEN 11 ELSE l_partkey END AS l_partkey, "
    "CASE WHEN hash(l_suppkey, l_orderkey) % 3 = 0 THEN 5 ELSE l_suppkey END AS l_suppkey",
    "orders": "CASE WHEN o_orderkey % 3 = 0 THEN 9 ELSE o_custkey END AS o_custkey, "
    "CASE WHEN o_orderkey = 4 THEN 'F' ELSE o_orderstatus END AS o_orderstatus",
    "customer": "CASE WHEN c_custkey % 3 = 0 THEN 7 ELSE c_nationkey END AS c_nationkey, "
    "CASE WHEN c_custkey % 3 = 0 THEN 9998.0 ELSE c_acctbal END AS c_acctbal",
    "events": "CASE WHEN event_id % 3 = 0 THEN 3 ELSE user_id END AS user_id",
}
QUERIES = [
    "silver_trf_sales_summary",
    "pg_trf_sales_summary",
    "sales_top5_per_territory",
    "sales_by_territory",
    "dq_unique_keys",
    "gold_weather_daily",
    "gold_island_daily",
    "upsert_ignore",
    "landing_daily_documents",
    "hr_top5_pay",
    "hr_mover_pct",
    "vendor_ranking",
    "vendor_shipmethod_compare",
    "rfm_territory_profile",
    "rfm_winback",
]


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    connection = duckdb.connect()
    for path in SOURCE.glob("*.parquet"):
        target = folder / path.name
        if path.stem in HOT:
            connection.execute(f"COPY (SELECT * REPLACE ({HOT[path.stem]}) FROM '{path}') TO '{target}' (FORMAT parquet)")
        else:
            shutil.copy(path, target)
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{target}'")
    return str(folder), connection


@pytest.mark.parametrize("name", QUERIES)
def test_skewed_tables(spark, skewed, name):
    folder, connection = skewed
    df = entry_point.queries()[name](spark, folder)
    result = connection.execute(entry_point.oracle_sql()[name])
    names = [c[0] for c in result.description]

    def ordered(rows):
        return sorted(rows, key=lambda row: tuple((v is None, v if v is not None else 0) for v in row))

    assert ordered(tuple(r) for r in df.select(*[f"`{n}`" for n in names]).collect()) == ordered(result.fetchall())
