import datetime
import json

import pytest
from pyspark.sql import functions as F

from millrace import schemas
from millrace.operators import keys, merge
from millrace.operators.quality import QualityError
from millrace.plans import runs
from millrace.sources import landing, sample_tables
from millrace.sources.files import FileStore
from millrace.sources.versions import CommitConflict, RunLedger, Version, VersionedTable
from test_runs import land, stored

FOLDER = "/root/testdata/sf0.001"
SCHEMA = schemas._schema("k bigint, v string, at int")


def rows(spark, *data):
    return spark.createDataFrame(data, SCHEMA)


def content(table):
    return sorted((tuple(r) for r in table.read().collect()), key=str)


def refuse(_):
    raise QualityError("no")


# -- versions ------------------------------------------------------------------
def test_a_failed_load_leaves_the_old_rows(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), SCHEMA)
    assert content(table) == [] and table.current() == Version()
    table.replace(rows(spark, (1, "a", 1)), load="first")
    with pytest.raises(QualityError):
        table.replace(rows(spark, (2, "b", 1)), audit=refuse)
    boom = rows(spark, (3, "c", 1)).withColumn("v", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        table.replace(boom)
    assert content(table) == [(1, "a", 1)] and table.current().facts == {"load": "first"}
    # a job that was killed between its data and its commit
    rows(spark, (4, "d", 1)).write.parquet(str(tmp_path / "t" / "data-dead"))
    assert content(table) == [(1, "a", 1)]
    table.append(rows(spark, (5, "e", 1)))
    assert content(table) == [(1, "a", 1), (5, "e", 1)]
    table.replace(rows(spark, (6, "f", 1)))
    assert table.current().number == 3
    assert table.vacuum(1) == 3 and content(table) == [(6, "f", 1)]


def test_readers_keep_their_version_and_writers_cannot_cross(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), SCHEMA)
    table.replace(rows(spark, (1, "a", 1)))
    reader, base = table.read(), table.current()
    table.replace(rows(spark, (2, "b", 1)))
    assert [r.k for r in reader.collect()] == [1] and [r.k for r in table.read(base).collect()] == [1]
    with pytest.raises(CommitConflict):
        table.commit(Version(base.number + 1, base.folders, {}))
    assert content(table) == [(2, "b", 1)]
    assert [n for n in FileStore(spark).names(f"{table.path}/_log") if not n.endswith(".json") and not n.endswith(".crc")] == []


def test_upsert_without_partitions(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), SCHEMA)
    table.upsert(rows(spark, (1, "a", 1), (2, "b", 5), (None, "n", 1)), ["k"], ["at"])
    batch = rows(spark, (1, "A", 1), (2, "old", 4), (3, "c", 1), (None, "N", 2))
    for _ in range(2):
        table.upsert(batch, ["k"], ["at"])
        assert content(table) == [(1, "A", 1), (2, "b", 5), (3, "c", 1), (None, "N", 2)]


# -- numbers -------------------------------------------------------------------
def test_numbers_have_no_gaps_and_go_on(spark, tmp_path):
    schema = schemas._schema("id int, name string, note string")
    table = VersionedTable(spark, str(tmp_path / "t"), schema)
    first = spark.range(1000).select(F.lit(None).cast("int").alias("id"), F.concat(F.lit("n"), F.col("id")).alias("name"), F.lit("x").alias("note"))
    first = first.repartition(7)
    table.append_numbered(first.unionByName(first.limit(5)), ["name"], "id")
    one = {r.name: r.id for r in table.read().collect()}
    assert [one[n] for n in sorted(one)] == list(range(1, 1001))
    second = spark.createDataFrame([(None, n, "y") for n in ("n5", "b", None, "a", "zz", "a")], schema)
    # a load that dies before its commit gives no numbers out
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(VersionedTable, "commit", lambda *_: refuse(None))
        with pytest.raises(QualityError):
            table.append_numbered(second, ["name"], "id")
    for _ in range(2):
        table.append_numbered(second, ["name"], "id")
        two = {r.name: r.id for r in table.read().collect()}
        assert {n: two[n] for n in (None, "a", "b", "zz")} == {None: 1001, "a": 1002, "b": 1003, "zz": 1004}
        assert sorted(two.values()) == list(range(1, 1005)) and table.read().count() == 1004
    assert table.read().where("name = 'n5'").first().note == "x"


def test_numbering_has_no_window(spark, tmp_path):
    df = keys.numbered(spark.range(5000).select(F.col("id").alias("k")), ["k"], "n", str(tmp_path), after=10)
    assert "Window" not in df._jdf.queryExecution().executedPlan().toString()
    assert df.where("n != k + 11").count() == 0 and df.count() == 5000


# -- keys before the write -----------------------------------------------------
def test_only_sound_rows_show(spark, tmp_path):
    path = str(tmp_path / "t")
    day = F.lit("2026-01-01").cast("date").alias("day")
    good = rows(spark, (1, "a", 1), (2, "b", 1)).select("*", day)
    assert merge.publish_partition(good, path, ["k", "day"], "day", "2026-01-01") == 0
    bad = rows(spark, (1, "z", 2), (1, "y", 1), (1, "y", 1), (None, "n", 1), (3, "c", 1)).select("*", day)
    for _ in range(2):
        assert merge.publish_partition(bad, path, ["k", "day"], "day", "2026-01-01", ["at"]) == 3
        assert sorted((r.k, r.v) for r in spark.read.parquet(path).collect()) == [(1, "y"), (3, "c")]
        aside = spark.read.parquet(f"{path}_rejected").collect()
        assert sorted((r.v, r.reason) for r in aside) == [("n", "key not whole"), ("y", "key repeated"), ("z", "key repeated")]
    assert merge.publish_partition(good, path, ["k", "day"], "day", "2026-01-01") == 0
    assert spark.read.parquet(f"{path}_rejected").count() == 0
    # a load that dies while it is staged shows nothing
    boom = good.withColumn("v", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        merge.publish_partition(boom, path, ["k", "day"], "day", "2026-01-01")
    assert sorted(r.k for r in spark.read.parquet(path).collect()) == [1, 2]


def test_rows_are_shuffled_once_before_they_show(spark, tmp_path, monkeypatch):
    frames = []
    for name in ("stored", "replace_partition"):
        real = getattr(merge, name)
        monkeypatch.setattr(merge, name, lambda df, *rest, real=real: (frames.append(df), real(df, *rest))[1])
    data = rows(spark, (1, "z", 2), (1, "y", 1), (None, "n", 1)).select("*", F.lit("2026-01-01").cast("date").alias("day"))
    assert merge.publish_partition(data, str(tmp_path / "t"), ["k", "day"], "day", "2026-01-01") == 2
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in frames]
    assert sum(plan.count("Exchange hashpartitioning") for plan in plans) == 1


def test_keys_of_many_rows_are_judged_alike(spark, tmp_path, monkeypatch):
    schema = "k long, d double, v string, n int, day date"
    day = datetime.date(2026, 1, 1)
    data = [(i % 7 or None, float(i % 3), None if i % 5 == 0 else f"v{i % 4}", i % 6, day) for i in range(400)] + [(100 + i, None, "x", i, day) for i in range(50)]
    order, known, first, wanted = ["n"], set(), [], []
    for row in sorted(data, key=lambda r: (r[3], r[1] is not None, r[1], r[2] is not None, r[2] or "")):
        if row[0] is None or row[0] in known:
            wanted.append((*row, "key not whole" if row[0] is None else "key repeated"))
        else:
            known.add(row[0])
            first.append(row)
    for hot in (0, 60, 1 << 20):  # all keys by aggregates, some, none
        monkeypatch.setattr(merge, "HOT", hot)
        path = str(tmp_path / f"hot{hot}")
        assert merge.publish_partition(spark.createDataFrame(data, schema).repartition(3), path, ["k", "day"], "day", "2026-01-01", order) == len(wanted)
        assert sorted(map(str, map(tuple, spark.read.parquet(path).collect()))) == sorted(map(str, first))
        aside = spark.read.parquet(f"{path}_rejected").select("k", "d", "v", "n", "day", "reason").collect()
        assert sorted(map(str, map(tuple, aside))) == sorted(map(str, wanted))


def test_hourly_silver_and_the_sales_tables_are_audited(spark, tmp_path):
    bronze = sample_tables.bronze_weather_hourly(spark, FOLDER).limit(50)
    path = str(tmp_path / "hourly")
    silver = runs.weather.silver_hourly(bronze.unionByName(bronze.limit(3)))
    run = str(bronze.first().run_date)
    runs.weather.store_run(silver, path, run, "silver_weather_hourly")
    assert spark.read.parquet(path).count() == bronze.where(F.col("run_date") == run).count()

    def read(spec):
        frame = sample_tables.SALES_FRAMES[spec.folder](spark, FOLDER)
        return frame.unionByName(frame.limit(1)) if spec.folder == broken else frame

    broken = None
    runs.sales_ingestion(spark, read, str(tmp_path), "2026-01-01")
    fact = sorted(runs.sales_warehouse(spark, str(tmp_path), "2026-01-01").drop("LoadTimestamp").collect())
    products = VersionedTable(spark, str(tmp_path / "silver" / "stg_products"), schemas.STG_PRODUCTS)
    before = content(products)
    broken = "product"
    runs.sales_ingestion(spark, read, str(tmp_path), "2026-01-01")
    with pytest.raises(QualityError, match="stg_products_unique"):
        runs.sales_warehouse(spark, str(tmp_path), "2026-01-01")
    assert content(products) == before and products.current().facts == {"batch_date": "2026-01-01"}
    after = spark.read.schema(schemas.FACT_SALES_PERFORMANCE).parquet(str(tmp_path / "gold" / "fact_sales_performance"))
    assert sorted(after.drop("LoadTimestamp").collect()) == fact


# -- ledger --------------------------------------------------------------------
def test_ledger(spark, tmp_path):
    ledger = RunLedger(spark, str(tmp_path / "runs"))
    done = []

    def load():
        done.append(1)
        return 7

    assert ledger.open_runs("t", {"1": "a", "2": "b"}) == ["1", "2"]
    assert ledger.perform("t", "1", "a", load) is True and ledger.perform("t", "1", "a", load) is False and len(done) == 1
    with pytest.raises(QualityError):
        ledger.perform("t", "2", "b", lambda: refuse(None))
    assert ledger.record("t", "2") == {"state": "open", "source": "b", "rows": None}
    assert ledger.open_runs("t", {"1": "a", "2": "b"}) == ["2"] and ledger.open_runs("t", {"1": "changed"}) == ["1"]
    assert ledger.perform("t", "2", "b", load) is True
    ledger.reopen("t", "1")
    assert sorted((r.run, r.state, r.rows) for r in ledger.records().collect()) == [("1", "open", 7), ("2", "done", 7)]


def test_interrupted_runs_go_on_where_they_stopped(spark, tmp_path, monkeypatch):
    base, house = tmp_path / "landing", str(tmp_path / "warehouse")
    for run in ("2026-04-04", "2026-04-05"):
        land(base, run, [run])
    with pytest.raises(QualityError):
        runs.weather_run(spark, str(base), house, "2026-04-04", least_cities=99)
    runs.weather_run(spark, str(base), house, "2026-04-05")
    assert runs.open_runs(spark, str(base), house) == ["2026-04-04"]
    runs.weather_run(spark, str(base), house, "2026-04-04")
    assert runs.open_runs(spark, str(base), house) == []
    # a finished run is not loaded again, unless its files change
    loads = []
    monkeypatch.setattr(runs, "load_bronze", lambda *_: loads.append(1))
    assert runs.weather_run(spark, str(base), house, "2026-04-04").count() == 15 and not loads
    land(base, "2026-04-04", ["2026-04-04", "2026-04-03"])
    runs.weather_run(spark, str(base), house, "2026-04-04")
    assert loads == [1]


# -- streaks after a backfill ----------------------------------------------------
def test_a_changed_day_reaches_later_runs(spark, tmp_path):
    days = [f"2026-04-{d:02d}" for d in range(1, 10)]
    base, where = tmp_path / "landing", str(tmp_path / "warehouse")
    loads = (("2026-04-03", days[:3]), ("2026-04-06", days[3:6]), ("2026-04-09", days[6:]))
    for run, span in loads:
        land(base, run, span, dry=True)
        runs.weather_run(spark, str(base), where, run)
    house = runs.Warehouse(spark, where)
    bronze = house.read("bronze_weather_daily", "2026-04-03")
    wet = (F.col("location_key") == "jakarta") & (F.col("obs_date") == "2026-04-02")
    changed = bronze.withColumn("precip_sum", F.when(wet, 30.0).otherwise(F.col("precip_sum")))
    changed.write.parquet(str(tmp_path / "changed"))
    runs.weather.store_run(spark.read.parquet(str(tmp_path / "changed")), house.path("bronze_weather_daily"), "2026-04-03")
    runs.build_silver(house, "2026-04-03")
    runs.build_gold(house, "2026-04-03")
    assert runs.redo_later_runs(house, "2026-04-03") == ["2026-04-06", "2026-04-09"]
    assert runs.redo_later_runs(house, "2026-04-03") == []
    streaks = house.read("gold_weather_daily").where("location_key = 'jakarta'").orderBy("obs_date").collect()
    assert [r.dry_day_streak_true for r in streaks] == [1, 0, 1, 2, 3, 4, 5, 6, 7]

    scratch = runs.Warehouse(spark, str(tmp_path / "scratch"))
    scratch.seed()
    for table in ("bronze_weather_daily", "bronze_weather_hourly"):
        house.read(table).write.partitionBy("run_date").parquet(scratch.path(table))
    for run, _ in loads:
        runs.build_silver(scratch, run)
        runs.build_gold(scratch, run)
    for table in ("gold_weather_daily", "gold_weather_island_daily", "fact_weather_daily"):
        assert stored(house, table) == stored(scratch, table)


# -- documents under their own names -----------------------------------------------
def test_documents_get_the_names_of_the_landing_layout(spark, tmp_path):
    base = str(tmp_path / "landing")
    daily = sample_tables.bronze_weather_daily(spark, FOLDER)
    documents = landing.to_documents(daily, "daily")
    names = {(r.location_key, str(r.run_date)) for r in daily.select("location_key", "run_date").distinct().collect()}
    for _ in range(2):
        assert landing.write_landing(documents, base, "daily") == len(names)
    found = landing.found_files(spark, base).collect()
    assert {(r.location_key, str(r.run_date)) for r in found} == names and all(r.size_bytes for r in found)
    run = max(r for _, r in names)
    read = landing.read_documents(spark, landing.landing_globs(base, "daily", run), "daily")
    again = landing.parse_documents(read, "daily").drop("ingested_at", "extracted_at", "source_file")
    assert sorted(map(str, again.collect())) == sorted(
        map(str, daily.where(F.col("run_date") == run).select(*again.columns).collect())
    )
    for city in (r[0] for r in runs.seeds.LOCATIONS):
        for resolution in landing.RESOLUTIONS:
            path = tmp_path / "landing" / resolution / city / f"{run}.json"
            path.parent.mkdir(parents=True, exist_ok=True)
            if not path.exists():
                path.write_text("{}")
    runs.check_landing(spark, base, run, runs.seeds.dim_location(spark))
    meta = json.loads((tmp_path / "landing" / "daily" / sorted(names)[0][0] / f"{sorted(names)[0][1]}.json").read_text())
    assert set(meta) == {"_meta", "data"}
    with pytest.raises(ValueError, match="name of its own"):
        landing.write_landing(documents.unionByName(documents), base, "daily")
