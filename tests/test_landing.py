import datetime as dt
import json
import time

import pytest
from pyspark.sql import functions as F

from millrace import schemas
from millrace.sources import landing, seeds

RUN = "2026-04-02"
DAYS = ["2026-04-01", "2026-04-02", "2026-04-03"]


def daily(**changes):
    block = {"time": DAYS}
    for i, name in enumerate(schemas.DAILY_FIELDS):
        if name in ("sunrise", "sunset"):
            block[name] = [f"{d}T05:4{i % 10}" for d in DAYS]
        elif name == "weather_code":
            block[name] = [1, 2, 3]
        else:
            block[name] = [i + 0.5, i + 1.5, None]
    block.update(changes)
    return {k: v for k, v in block.items() if v != "drop"}


def write(base, resolution, city, payload, run=RUN):
    folder = base / resolution / city
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{run}.json").write_text(json.dumps(payload, indent=2))


def meta(city, **extra):
    return {"location_key": city, "run_date": RUN, "extracted_at": "2026-04-02T01:02:03.456789Z", **extra}


def bronze(spark, base, resolution="daily", **kwargs):
    documents = landing.read_documents(spark, landing.landing_globs(str(base), resolution, RUN, **kwargs), resolution)
    return landing.parse_documents(documents, resolution)


def test_full_arrays(spark, tmp_path):
    write(tmp_path, "daily", "jakarta", {"_meta": meta("elsewhere"), "data": {"daily": daily()}})
    rows = bronze(spark, tmp_path).orderBy("obs_date").collect()
    assert [r.obs_date.isoformat() for r in rows] == DAYS
    first = rows[0]
    assert first.location_key == "jakarta"  # the path names the city
    assert first.run_date == dt.date(2026, 4, 2)
    assert first.extracted_at == dt.datetime(2026, 4, 2, 1, 2, 3, 456789)
    assert (first.temp_max, first.temp_min, first.apparent_temp_max) == (0.5, 1.5, 2.5)
    assert first.weathercode == 1 and first.sunrise == "2026-04-01T05:46"
    assert first.source_file == f"weather/raw/daily/jakarta/{RUN}.json"
    assert rows[2].temp_max is None and rows[2].weathercode == 3
    assert bronze(spark, tmp_path).columns == schemas.BRONZE_WEATHER_DAILY.names


def test_short_null_missing_and_scalar_arrays(spark, tmp_path):
    block = daily(
        temperature_2m_max=[30.0], temperature_2m_min=None, precipitation_sum="drop", wind_speed_10m_max=12.5, uv_index_max=[1, 2, 3, 4]
    )
    write(tmp_path, "daily", "medan", {"_meta": meta("medan"), "data": {"daily": block}})
    rows = bronze(spark, tmp_path).orderBy("obs_date").collect()
    assert len(rows) == 3  # the longer uv array adds no row
    assert [r.temp_max for r in rows] == [30.0, None, None]
    assert [r.temp_min for r in rows] == [None] * 3
    assert [r.precip_sum for r in rows] == [None] * 3
    assert [r.windspeed_max for r in rows] == [None] * 3
    assert [r.uv_index_max for r in rows] == [1.0, 2.0, 3.0]
    assert rows[0].humidity_max is not None


def test_first_entry_of_a_repeated_time_counts(spark, tmp_path):
    block = daily(time=["2026-04-02", "2026-04-01", "2026-04-02"], temperature_2m_max=[31.0, 30.0, 29.0])
    write(tmp_path, "daily", "medan", {"_meta": meta("medan"), "data": {"daily": block}})
    rows = bronze(spark, tmp_path).orderBy("obs_date").collect()
    assert [(r.obs_date.day, r.temp_max) for r in rows] == [(1, 30.0), (2, 31.0)]


def test_document_without_envelope(spark, tmp_path):
    write(tmp_path, "daily", "manado", {"daily": daily()})
    rows = bronze(spark, tmp_path).collect()
    assert len(rows) == 3
    assert {r.location_key for r in rows} == {"manado"}
    assert all(r.extracted_at is not None for r in rows)


def test_empty_time_or_no_block_gives_no_rows(spark, tmp_path):
    write(tmp_path, "daily", "kupang", {"_meta": meta("kupang"), "data": {"daily": daily(time=[])}})
    write(tmp_path, "daily", "mataram", {"_meta": meta("mataram"), "data": {"current": {"x": 1}}, "daily": daily()})
    assert bronze(spark, tmp_path).count() == 0


def test_missing_files_are_skipped(spark, tmp_path):
    write(tmp_path, "daily", "jakarta", {"_meta": meta("jakarta"), "data": {"daily": daily()}})
    assert bronze(spark, tmp_path, locations=["jakarta", "nowhere"]).count() == 3
    assert bronze(spark, tmp_path / "absent").count() == 0
    assert bronze(spark, tmp_path, "hourly").count() == 0


def test_hourly_drops_the_extra_arrays(spark, tmp_path):
    times = [f"2026-04-02T{h:02d}:00" for h in range(4)]
    block = {"time": times, "visibility": [1, 2, 3, 4], "uv_index": [0, 0, 0, 0]}
    block.update({name: [float(i), None, 2.0, 3.0] for i, name in enumerate(schemas.HOURLY_FIELDS)})
    write(tmp_path, "hourly", "jayapura", {"_meta": meta("jayapura", resolution="hourly"), "data": {"hourly": block}})
    df = bronze(spark, tmp_path, "hourly")
    assert df.columns == schemas.BRONZE_WEATHER_HOURLY.names
    rows = df.orderBy("hour_timestamp").collect()
    assert [r.hour_timestamp.hour for r in rows] == [0, 1, 2, 3]
    assert rows[0].soil_moisture == 7.0 and rows[1].soil_moisture is None


def test_documents_survive_a_round_trip(spark, tmp_path):
    write(tmp_path, "daily", "jakarta", {"_meta": meta("jakarta"), "data": {"daily": daily()}})
    write(tmp_path, "daily", "medan", {"_meta": meta("medan"), "data": {"daily": daily(sunrise=None)}})
    rows = bronze(spark, tmp_path).drop("ingested_at")
    landing.write_documents(landing.to_documents(bronze(spark, tmp_path), "daily"), str(tmp_path / "lines"))
    again = landing.read_documents(spark, str(tmp_path / "lines"), "daily", multi_line=False)
    again = landing.parse_documents(again, "daily").drop("ingested_at")
    assert sorted(again.collect()) == sorted(rows.collect())


def test_29_of_30_files(spark, tmp_path):
    for city, *_ in seeds.LOCATIONS:
        for resolution in landing.RESOLUTIONS:
            if (city, resolution) != ("kupang", "hourly"):
                write(tmp_path, resolution, city, {"_meta": meta(city)})
    found = landing.found_files(spark, str(tmp_path))
    assert found.count() == 29
    missing = landing.missing_files(seeds.dim_location(spark), found, RUN, RUN).collect()
    assert [r.object_key for r in missing] == [f"weather/raw/hourly/kupang/{RUN}.json"]


@pytest.mark.parametrize("per_part", [1000, 4])
def test_manifest_holds_every_entry_once(spark, per_part):
    cities = [c for c, *_ in seeds.LOCATIONS]
    entries = spark.createDataFrame(
        [(c, dt.date(2026, 4, d), f"{c}/{d}", 10, 8) for c in cities for d in (1, 2)],
        "location_key string, run_date date, object_key string, size_bytes bigint, days_returned bigint",
    )
    rows = landing.manifest(entries, 15, per_part).collect()
    assert {r.files_ingested for r in rows} == {30}
    assert {r.total_locations for r in rows} == {15}
    assert {r.parts for r in rows} == {-(-15 // per_part)}
    listed = [(r.run_date, e.location_key) for r in rows for e in r.locations]
    assert sorted(listed) == sorted((dt.date(2026, 4, d), c) for c in cities for d in (1, 2))


def test_seed_dimensions(spark):
    assert seeds.dim_location(spark).count() == 15
    assert [r.condition_id for r in seeds.dim_weather_condition(spark).where("condition_code = 'HAZE'").collect()] == [12]
    assert [r.risk_score for r in seeds.dim_risk_level(spark).orderBy("risk_id").collect()] == [10, 40, 70, 95]
    dates = seeds.dim_date(spark)
    assert dates.count() == 2557
    assert dates.agg(F.min("date_id"), F.max("date_id")).first() == (20240101, 20301231)


def hourly_document(tmp_path, entries):
    first = dt.datetime(2001, 1, 1)
    times = [(first + dt.timedelta(hours=i)).strftime("%Y-%m-%dT%H:00") for i in range(entries)]
    block = {"time": times, **{name: [1.5] * entries for name in schemas.HOURLY_FIELDS}}
    folder = tmp_path / str(entries) / "hourly" / "jakarta"
    folder.mkdir(parents=True)
    (folder / "2026-04-04.json").write_text(json.dumps({"_meta": {"location_key": "jakarta"}, "data": {"hourly": block}}))
    return str(tmp_path / str(entries))


def test_long_documents_take_linear_time(spark, tmp_path):
    took = {}
    for entries in (4_000, 16_000):
        base = hourly_document(tmp_path, entries)
        runs = []
        for _ in range(3):
            started = time.monotonic()
            documents = landing.read_documents(spark, landing.landing_globs(base, "hourly", "2026-04-04"), "hourly")
            assert landing.parse_documents(documents, "hourly").where("temperature_2m = 1.5").count() == entries
            runs.append(time.monotonic() - started)
        took[entries] = min(runs)
    assert took[16_000] < 4 * took[4_000] + 1


def test_entries_are_sorted_once(spark, tmp_path):
    base = hourly_document(tmp_path, 3)
    documents = landing.read_documents(spark, landing.landing_globs(base, "hourly", "2026-04-04"), "hourly")
    plan = landing.parse_documents(documents, "hourly")._jdf.queryExecution().optimizedPlan().toString()
    lines = [line for line in plan.split("\n") if "array_sort" in line]
    # in a projection of its own, below the lambda that compares neighbours
    assert len(lines) == 1 and plan.count("array_sort") == 1
    assert "Project" in lines[0] and "filter(" not in lines[0] and "size(" not in plan
