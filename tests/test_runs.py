import json
import random

import pytest
from pyspark.sql import functions as F

from millrace import schemas
from millrace.operators.quality import QualityError
from millrace.plans import packs, runs
from millrace.sources import sample_tables, seeds
from millrace.sources.landing import RESOLUTIONS

FOLDER = "/root/testdata/sf0.001"


def land(base, run, days, seed=0, skip=(), more=(), dry=False):
    rng = random.Random(seed)
    for city in [*(row[0] for row in seeds.LOCATIONS), *more]:
        for resolution, fields in zip(RESOLUTIONS, (schemas.DAILY_FIELDS, schemas.HOURLY_FIELDS)):
            if (city, resolution) in skip:
                continue
            time = days if resolution == "daily" else [f"{d}T{h:02d}:00" for d in days for h in range(24)]
            block = {"time": time}
            for name in fields:
                if name in ("sunrise", "sunset"):
                    block[name] = [f"{t}T06:00" for t in time]
                elif name == "weather_code":
                    block[name] = [rng.randint(0, 99) for _ in time]
                elif dry and name in ("precipitation_sum", "precipitation"):
                    block[name] = [0.0 for _ in time]
                else:
                    block[name] = [round(rng.uniform(0, 60), 1) for _ in time]
            folder = base / resolution / city
            folder.mkdir(parents=True, exist_ok=True)
            payload = {"_meta": {"location_key": city, "extracted_at": f"{run}T05:00:00Z"}, "data": {resolution: block}}
            (folder / f"{run}.json").write_text(json.dumps(payload, indent=1))


def stored(house, table):
    df = house.read(table)
    skip = [c for c in ("ingested_at", "transformed_at") if c in df.columns]
    return sorted((tuple(str(v) for v in r) for r in df.drop(*skip).collect()))


def test_weather_runs(spark, tmp_path):
    landing, base = tmp_path / "landing", str(tmp_path / "warehouse")
    days = [f"2026-04-{d:02d}" for d in range(1, 13)]
    house = runs.Warehouse(spark, base)
    land(landing, "2026-04-04", days[:8], 1)
    report = runs.weather_run(spark, str(landing), base, "2026-04-04")
    assert report.count() == 15
    assert house.read("bronze_weather_hourly").count() == 15 * 8 * 24
    assert house.read("silver_weather_hourly").count() == 15 * 8 * 24
    manifest = spark.read.schema(schemas.MANIFEST).json(str(landing / "_manifests" / "2026-04-04")).first()
    assert manifest.files_ingested == 30 and {e.days_returned for e in manifest.locations} == {8}
    assert all(e.size_bytes > 100 for e in manifest.locations)

    land(landing, "2026-04-08", days[4:], 2)
    runs.weather_run(spark, str(landing), base, "2026-04-08")
    fact = house.read("fact_weather_daily")
    assert fact.count() == 15 * 12
    assert fact.where(F.col("location_id").isNull()).count() == 0
    newest = {r.date_id: str(r.run_date) for r in fact.select("date_id", "run_date").distinct().collect()}
    assert newest == {int(d.replace("-", "")): "2026-04-08" if d in days[4:] else "2026-04-04" for d in days}
    assert house.read("gold_weather_daily").count() == 15 * 16
    dashboard = spark.table("gold_alert_dashboard").collect()
    assert len(dashboard) == 15 and {str(r.obs_date) for r in dashboard} == {"2026-04-12"}

    # the older run again: no table changes, and the newer rows of the fact stay
    tables = [t for t in schemas.STORED_TABLES if "weather" in t and not t.startswith("dim")]
    before = {t: stored(house, t) for t in tables}
    runs.weather_run(spark, str(landing), base, "2026-04-04")
    assert {t: stored(house, t) for t in tables} == before


def test_gates_stop_a_run(spark, tmp_path):
    landing, base = tmp_path / "landing", str(tmp_path / "warehouse")
    land(landing, "2026-04-04", ["2026-04-04"], skip={("kupang", "hourly")})
    with pytest.raises(QualityError, match="hourly/kupang/2026-04-04.json"):
        runs.weather_run(spark, str(landing), base, "2026-04-04")
    house = runs.Warehouse(spark, base)
    assert house.read("bronze_weather_daily").count() == 0
    land(landing, "2026-04-04", ["2026-04-04"])
    with pytest.raises(QualityError, match="city_coverage"):
        runs.weather_run(spark, str(landing), base, "2026-04-04", least_cities=16)
    assert house.read("gold_weather_daily").count() == 0


def test_streaks_go_on_and_own_locations_count(spark, tmp_path):
    """Two runs of dry days: the second goes on counting; a sixteenth location is expected, checked and reported."""
    landing, base = tmp_path / "landing", str(tmp_path / "warehouse")
    days = [f"2026-04-{d:02d}" for d in range(1, 9)]
    house = runs.Warehouse(spark, base)
    house.seed()
    own = house.read("dim_location").where("location_id = 1").withColumns(
        {"location_id": F.lit(16), "location_key": F.lit("newtown"), "city_name": F.lit("Newtown")}
    )
    house.add("dim_location", own)
    land(landing, "2026-04-04", days[:4], 1, dry=True)
    with pytest.raises(QualityError, match="newtown"):
        runs.weather_run(spark, str(landing), base, "2026-04-04")
    land(landing, "2026-04-04", days[:4], 1, more=["newtown"], dry=True)
    assert runs.weather_run(spark, str(landing), base, "2026-04-04").count() == 16
    land(landing, "2026-04-08", days[4:], 2, more=["newtown"], dry=True)
    runs.weather_run(spark, str(landing), base, "2026-04-08")
    gold = house.read("gold_weather_daily").where("location_key = 'newtown'")
    assert [r.dry_day_streak_true for r in gold.orderBy("obs_date").collect()] == list(range(1, 9))
    assert house.read("dim_location").count() == 16

    # the fact can be rebuilt from gold alone, and rows that it cannot hold are counted
    before = stored(house, "fact_weather_daily")
    rebuilt = runs.Warehouse(spark, str(tmp_path / "other"))
    rebuilt.seed()
    house.read("gold_weather_daily").write.partitionBy("run_date").parquet(rebuilt.path("gold_weather_daily"))
    runs.sync_star_fact(rebuilt)
    assert stored(rebuilt, "fact_weather_daily") == before
    stray = house.read("gold_weather_daily").withColumn("obs_date", F.add_months("obs_date", 1200))
    assert runs.left_out(house, stray).first().passed is False
    assert runs.left_out(house, house.read("gold_weather_daily")).first().passed is True


def test_keys_are_checked(spark, tmp_path):
    house = runs.Warehouse(spark, str(tmp_path))
    row = spark.range(1).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.SILVER_WEATHER_DAILY.fields if f.name != "run_date"],
        F.lit("2026-01-01").cast("date").alias("run_date"),
    )
    row.union(row).write.partitionBy("run_date").parquet(house.path("silver_weather_daily"))
    with pytest.raises(QualityError, match="unique"):
        runs.check_keys(house, "silver_weather_daily")
    row.write.mode("overwrite").partitionBy("run_date").parquet(house.path("silver_weather_daily"))
    with pytest.raises(QualityError, match="not_null"):
        runs.check_keys(house, "silver_weather_daily")


def test_sales_runs(spark, tmp_path):
    def read(spec):
        return sample_tables.SALES_FRAMES[spec.folder](spark, FOLDER)

    summary = runs.sales_ingestion(spark, read, str(tmp_path), "2026-01-01")
    assert {r.status for r in summary.collect()} == {"OK"} and summary.count() == 6
    facts = [
        sorted(runs.sales_warehouse(spark, str(tmp_path), "2026-01-01").drop("LoadTimestamp").collect()) for _ in range(2)
    ]
    assert facts[0] and facts[0] == facts[1]
    decimal = runs.sales_warehouse(spark, str(tmp_path), "2026-01-01", money="decimal", exclude_online=True)
    assert dict(decimal.dtypes)["MarginPct"] == "decimal(6,2)"
    assert decimal.count() > 0
    # both flavours on two dates stay readable, each with its declared schema
    runs.sales_ingestion(spark, read, str(tmp_path), "2026-01-02")
    for money in ("double", "decimal"):
        runs.sales_warehouse(spark, str(tmp_path), "2026-01-02", money=money)
    for table in ("fact_sales_performance", "fact_sales_performance_decimal"):
        schema = schemas.STORED_TABLES[table][0]
        fact = spark.read.schema(schema).parquet(str(tmp_path / "gold" / table))
        assert {str(r.BatchDate) for r in fact.collect()} == {"2026-01-01", "2026-01-02"}
        assert {f.name: f.dataType for f in spark.read.parquet(str(tmp_path / "gold" / table)).schema} == {f.name: f.dataType for f in schema}


def test_every_report_of_the_packs(spark, tmp_path):
    facts = {
        "fact_sales_performance": runs.sales.build_fact(
            {n: build(spark, FOLDER) for n, build in sample_tables.SALES_FRAMES.items()}, "2026-01-01"
        ),
        "fact_hr_workforce": sample_tables.fact_hr_workforce(spark, FOLDER),
        "fact_vendor_performance": sample_tables.fact_vendor_performance(spark, FOLDER),
        "stg_purchase_orders": sample_tables.stg_purchase_orders(spark, FOLDER),
        "fact_customer_rfm": sample_tables.fact_customer_rfm(spark, FOLDER),
    }
    reports = packs.analytic_queries(facts)
    assert len(reports) == 27
    assert all(df.columns for df in reports.values())
    assert reports["sales/by_territory"].count() == 25
    paths = runs.write_reports(facts, str(tmp_path))
    assert len(paths) == 27
    assert [tuple(r) for r in spark.read.parquet(f"{tmp_path}/reports/sales/by_territory").collect()] == [
        tuple(r) for r in reports["sales/by_territory"].collect()
    ]
    only = packs.analytic_queries({"fact_hr_workforce": facts["fact_hr_workforce"]})
    assert sorted(only) == sorted(n for n in reports if n.startswith("hr/"))
