import datetime as dt
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException

from millrace.session import scratch, shared_base, sizing, stored, workspace
from millrace.sources import files, sqlfile
from millrace.sources.jdbc import SALES_TABLES, TableSpec, drop_time_zone, jdbc_options, split_options


def test_jdbc_options():
    spec = TableSpec("Sales", "SalesOrderHeader", "sales_order_header", "SalesOrderID")
    options = jdbc_options("jdbc:postgresql://db/x", spec, user="u")
    assert options["dbtable"] == '"Sales"."SalesOrderHeader"' and options["user"] == "u"
    assert split_options(spec, 1, 3_000_000) == {
        "partitionColumn": '"SalesOrderID"',
        "lowerBound": "1",
        "upperBound": "3000001",
        "numPartitions": "3",
    }
    assert split_options(spec, 5, 5)["numPartitions"] == "1"
    assert split_options(spec, None, None) == {}
    assert split_options(TableSpec("a", "b", "c"), 1, 2) == {}
    assert [s.folder for s in SALES_TABLES][:2] == ["sales_order_header", "sales_order_detail"]


def test_zoned_timestamps_become_plain(spark):
    df = spark.sql("SELECT TIMESTAMP '2026-01-01 10:00:00 Asia/Jakarta' AS t, 1 AS x")
    out = drop_time_zone(df)
    assert dict(out.dtypes) == {"t": "timestamp_ntz", "x": "int"}
    assert out.first().t == dt.datetime(2026, 1, 1, 3)


def test_a_load_date_is_replaced_and_pruned(spark, tmp_path):
    path = files.raw_path(str(tmp_path), "product")
    for date, n in (("2026-01-01", 5), ("2026-01-02", 7), ("2026-01-01", 3)):
        files.write_partition(spark.range(n), path, date)
    assert files.read_partition(spark, path, "2026-01-01").count() == 3
    assert files.read_partition(spark, path, "2026-01-02").count() == 7
    plan = files.read_partition(spark, path, "2026-01-02")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan
    assert not list((tmp_path / "raw" / "product" / "dt=2026-01-01").glob("*.gz*"))
    assert list((tmp_path / "raw" / "product" / "dt=2026-01-01").glob("*.snappy.parquet"))


def test_ingest_and_validate(spark, tmp_path):
    specs = [TableSpec("s", "A", "a"), TableSpec("s", "B", "b")]
    paths = files.ingest_tables(lambda s: spark.range(3 if s.folder == "a" else 4), specs, str(tmp_path), "2026-01-01")
    summary = files.validation_summary(spark, paths, "2026-01-01")
    assert sorted(tuple(r) for r in summary.collect()) == [("a", "OK", 3, 1, None), ("b", "OK", 4, 1, None)]
    files.require_valid(summary)
    damaged = tmp_path / "damaged" / "dt=2026-01-01"
    damaged.mkdir(parents=True)
    (damaged / "part-0.parquet").write_bytes(b"no parquet at all" * 20)
    bad = files.validation_summary(spark, {**paths, "d": str(damaged.parent), "e": str(tmp_path / "none")}, "2026-01-01")
    reasons = {r.table: (r.status, bool(r.detail)) for r in bad.collect()}
    assert reasons["d"] == reasons["e"] == ("FAILED", True) and reasons["a"] == ("OK", False)
    with pytest.raises(ValueError, match="d: .*e: "):
        files.require_valid(bad)
    broken = files.validation_summary(spark, {**paths, "c": str(tmp_path / "none")}, "2026-01-01")
    assert ("c", "FAILED", None, None) in [tuple(r)[:4] for r in broken.collect()]
    with pytest.raises(ValueError, match="c: "):
        files.require_valid(broken)
    views = files.register_bronze_views(spark, str(tmp_path), paths, "2026-01-01")
    assert sorted(tuple(r) for r in files.row_counts({v: spark.table(v) for v in views}).collect()) == [
        ("bronze_a", 3),
        ("bronze_b", 4),
    ]


def test_reading_nothing(spark, tmp_path):
    schema = spark.range(1).schema
    assert files.read_or_empty(spark, str(tmp_path / "none"), schema).count() == 0


def test_sql_script(spark, tmp_path):
    script = tmp_path / "script.sql"
    script.write_text(
        "-- a comment; with a semicolon\nCREATE SCHEMA script_test;\nCREATE SCHEMA script_test;\n\nSELECT :n + 1 AS x;\n;"
    )
    results = sqlfile.run_sql_file(spark, str(script), {"n": 41})
    assert results[-1].first().x == 42
    with pytest.raises(AnalysisException):
        sqlfile.run_sql_text(spark, "SELECT * FROM no_such_table")


def test_shared_folder(spark):
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert shared_base(spark) == base
    one, two = workspace(spark, "x"), workspace(spark, "x")
    assert one != two and one.startswith(base + "/x-")


def test_scratch_goes_after_success_only(spark):
    with scratch(spark, "s") as folder:
        assert stored(spark.range(3), f"{folder}/x").count() == 3
    assert not Path(folder).exists()
    with pytest.raises(RuntimeError), scratch(spark, "s") as folder:
        stored(spark.range(3), f"{folder}/x")
        raise RuntimeError
    assert Path(folder).exists()


def test_sizing():
    small, large = sizing(1 << 30, 8), sizing(100 << 40, 4000)
    assert int(small["spark.sql.shuffle.partitions"]) == 8
    assert int(large["spark.sql.shuffle.partitions"]) == (100 << 40) // (128 << 20)
    assert int(large["spark.sql.files.maxPartitionBytes"]) == 512 << 20
