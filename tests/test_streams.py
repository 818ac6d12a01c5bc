import json

from millrace import schemas
from millrace.streaming import jobs

FIELDS = {n: [1.0, 2.0] for n in schemas.DAILY_FIELDS if n not in ("sunrise", "sunset", "weather_code")}


def document(folder, city, run, days, temp):
    path = folder / "daily" / city
    path.mkdir(parents=True, exist_ok=True)
    block = {"time": days, **FIELDS, "temperature_2m_max": [temp] * len(days)}
    payload = {"_meta": {"extracted_at": f"{run}T00:00:00Z"}, "data": {"daily": block}}
    (path / f"{run}.json").write_text(json.dumps(payload, indent=1))


def test_each_run_takes_only_new_files(spark, tmp_path):
    landing, bronze, silver = (tmp_path / n for n in ("landing", "bronze", "silver"))
    offsets = [str(tmp_path / n) for n in ("c1", "c2")]

    def run():
        query = jobs.landing_to_bronze(spark, str(landing), str(bronze), offsets[0])
        query.awaitTermination()
        read = sum(p["numInputRows"] for p in query.recentProgress)
        jobs.bronze_to_silver(spark, str(bronze), str(silver), offsets[1]).awaitTermination()
        return read

    def stored():
        rows = spark.read.schema(schemas.SILVER_WEATHER_DAILY).parquet(str(silver))
        return sorted((r.location_key, str(r.run_date), str(r.obs_date), r.temp_max_c) for r in rows.collect())

    document(landing, "jakarta", "2026-04-01", ["2026-04-01", "2026-04-02"], 30.0)
    document(landing, "medan", "2026-04-01", ["2026-04-01"], 99.0)
    assert run() == 2
    first = stored()
    assert first == [
        ("jakarta", "2026-04-01", "2026-04-01", 30.0),
        ("jakarta", "2026-04-01", "2026-04-02", 30.0),
        ("medan", "2026-04-01", "2026-04-01", None),
    ]
    assert run() == 0
    assert stored() == first
    document(landing, "jakarta", "2026-04-02", ["2026-04-02"], 31.0)
    assert run() == 1
    assert stored() == sorted([*first, ("jakarta", "2026-04-02", "2026-04-02", 31.0)])


def test_a_repeated_batch_appends_nothing(spark, tmp_path):
    landing, bronze = tmp_path / "landing", str(tmp_path / "bronze")
    document(landing, "jakarta", "2026-04-01", ["2026-04-01", "2026-04-02"], 30.0)
    for offsets in ("lost", "new"):  # a lost checkpoint replays every file
        jobs.landing_to_bronze(spark, str(landing), bronze, str(tmp_path / offsets)).awaitTermination()
    assert spark.read.parquet(bronze).count() == 2


def test_silver_survives_replays_and_batch_runs(spark, tmp_path):
    """A lost checkpoint with new rows, a replay, and a batch run into the same table: every row once."""
    from millrace.plans.weather import silver_daily, store_run

    landing, bronze, silver = (tmp_path / n for n in ("landing", "bronze", "silver"))

    def load(run, days, offsets):
        document(landing, "jakarta", run, days, 30.0)
        jobs.landing_to_bronze(spark, str(landing), str(bronze), str(tmp_path / "b")).awaitTermination()
        jobs.bronze_to_silver(spark, str(bronze), str(silver), str(tmp_path / offsets)).awaitTermination()
        rows = spark.read.schema(schemas.SILVER_WEATHER_DAILY).parquet(str(silver)).collect()
        return sorted((str(r.run_date), str(r.obs_date)) for r in rows)

    first = load("2026-04-01", ["2026-04-01", "2026-04-02"], "lost")
    assert len(first) == 2
    both = load("2026-04-02", ["2026-04-02"], "new")
    assert both == [*first, ("2026-04-02", "2026-04-02")]
    jobs.bronze_to_silver(spark, str(bronze), str(silver), str(tmp_path / "again")).awaitTermination()
    table = spark.read.schema(schemas.SILVER_WEATHER_DAILY).parquet(str(silver))
    assert table.count() == 3
    stored = spark.read.schema(schemas.BRONZE_WEATHER_DAILY).parquet(str(bronze))
    store_run(silver_daily(stored.where("run_date = '2026-04-01'")), str(silver), "2026-04-01")
    assert load("2026-04-03", ["2026-04-03"], "new") == [*both, ("2026-04-03", "2026-04-03")]


def test_rows_without_a_time_are_set_aside(spark, tmp_path):
    landing, bronze = tmp_path / "landing", str(tmp_path / "bronze")
    document(landing, "jakarta", "2026-04-01", ["2026-04-01", None], 30.0)
    for offsets in ("a", "b"):
        jobs.landing_to_bronze(spark, str(landing), bronze, str(tmp_path / offsets)).awaitTermination()
    assert spark.read.parquet(bronze).count() == 1
    assert spark.read.parquet(f"{bronze}_rejected").count() == 1
