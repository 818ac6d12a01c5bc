"""Weather medallion: bronze to silver to gold, island aggregate, star fact, dashboards."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace import schemas
from millrace.functions import weather as wx
from millrace.functions.calendar import EL_NINO_FROM, calendar_columns
from millrace.functions.cleaning import bounded, falling, null_outside, rising
from millrace.functions.numbers import round_half_away, settled_mean, settled_sum
from millrace.operators.keys import latest_per_key
from millrace.operators.merge import append_new, publish_partition, split_complete, upsert
from millrace.operators.shares import at_latest
from millrace.operators.streaks import dry_day_streaks
from millrace.session import scratch, stored
from millrace.sources.files import replace_partition

SOURCE_API = "open-meteo-via-minio-gold"


def silver_daily(bronze: DataFrame, *, el_nino_from: dt.date = EL_NINO_FROM) -> DataFrame:
    """Cleaned daily observations with calendar features; a row-wise projection."""
    warm = null_outside(F.col("temp_max"), 10, 50)
    cool = null_outside(F.col("temp_min"), 5, 45)
    mean = (bounded(warm, default=30.0) + bounded(cool, default=25.0)) / F.lit(2.0)
    felt = F.coalesce("apparent_temp_max", "temp_max", F.lit(30.0))
    columns = {
        "temp_max_c": round_half_away(warm, 2),
        "temp_min_c": round_half_away(cool, 2),
        "temp_avg_c": round_half_away(mean, 2),
        "apparent_temp_max_c": round_half_away(felt, 2),
        "precip_mm": round_half_away(bounded(F.col("precip_sum"), default=0.0, low=0.0), 2),
        "windspeed_kmh": round_half_away(bounded(F.col("windspeed_max"), default=0.0, low=0.0), 2),
        "humidity_pct": round_half_away(bounded(F.col("humidity_max"), default=70.0, low=0.0, high=100.0), 2),
        "uv_index_max": bounded(F.col("uv_index_max"), default=0.0),
        "evapotranspiration": bounded(F.col("evapotranspiration"), default=0.0),
        **calendar_columns(F.col("obs_date"), el_nino_from),
        "silver_id": F.xxhash64("location_key", "obs_date", "run_date"),
        "transformed_at": F.current_timestamp(),
    }
    return bronze.withColumns(columns).select(*schemas.SILVER_WEATHER_DAILY.names)


def silver_hourly(bronze: DataFrame) -> DataFrame:
    """Cleaned hourly observations."""
    felt = F.coalesce("apparent_temp", "temperature_2m", F.lit(28.0))
    share = {"default": 0.0, "low": 0.0, "high": 100.0}
    columns = {
        "temperature_c": round_half_away(null_outside(F.col("temperature_2m"), 0, 50), 2),
        "precipitation_mm": round_half_away(bounded(F.col("precipitation"), default=0.0, low=0.0), 3),
        "windspeed_kmh": round_half_away(bounded(F.col("windspeed_10m"), default=0.0, low=0.0), 2),
        "humidity_pct": round_half_away(bounded(F.col("humidity_2m"), default=70.0, low=0.0, high=100.0), 2),
        "apparent_temp_c": round_half_away(felt, 2),
        "precip_prob_pct": round_half_away(bounded(F.col("precip_prob"), **share), 2),
        "cloudcover_pct": round_half_away(bounded(F.col("cloudcover"), **share), 2),
        "soil_moisture": round_half_away(bounded(F.col("soil_moisture"), default=0.0, low=0.0), 4),
        "obs_date": F.col("hour_timestamp").cast("date"),
        "obs_hour": F.hour("hour_timestamp"),
        "silver_id": F.xxhash64("location_key", "hour_timestamp", "run_date"),
        "transformed_at": F.current_timestamp(),
    }
    return bronze.withColumns(columns).select(*schemas.SILVER_WEATHER_HOURLY.names)


def gold_daily(silver: DataFrame, dim_location: DataFrame) -> DataFrame:
    """Indices, streaks, classification and alerts per location and day."""
    precip, hot, humid = F.col("precip_mm"), F.col("temp_max_c"), F.col("humidity_pct")
    drought, fire = F.col("drought_index"), F.col("fire_weather_idx")
    indexed = silver.withColumns(
        {
            "drought_index": wx.drought_index(precip, hot, humid),
            "fire_weather_idx": wx.fire_index(hot, humid, F.col("windspeed_kmh")),
            "heat_index": wx.heat_index(F.col("apparent_temp_max_c"), hot),
        }
    )
    classified = dry_day_streaks(indexed).withColumns(
        {
            "crop_stress_score": wx.crop_stress(drought, F.col("temp_avg_c")),
            "condition_label": wx.condition_label(precip),
            "risk_code": wx.risk_code(precip, drought, fire),
            **wx.alert_flags(precip, hot, drought, fire),
        }
    )
    return (
        classified.join(dim_location.select("location_key", "location_id"), "location_key", "left")
        .withColumns(
            {
                "risk_category": wx.risk_category(F.col("risk_code")),
                "alert_color": wx.alert_colour(F.col("risk_code")),
                "gold_id": F.xxhash64("location_key", "obs_date", "run_date"),
                "transformed_at": F.current_timestamp(),
            }
        )
        .select(*schemas.GOLD_WEATHER_DAILY.names)
    )


def island_daily(gold: DataFrame, dim_location: DataFrame) -> DataFrame:
    """Measures, risk counts and alerts per island, day and run."""

    def mean(column: str, places: int) -> Column:
        return round_half_away(settled_mean(F.col(column)), places)

    placed = gold.join(dim_location.select("location_key", "island"), "location_key", "left")
    counts = [
        F.count_if(F.col("risk_category") == category).alias(f"cities_{category.lower()}")
        for category in wx.RISK_CATEGORY.values()
    ]
    alerts = [
        F.bool_or(flag).alias(name)
        for flag, name in (
            ("is_fire_alert", "has_fire_alert"),
            ("is_drought_alert", "has_drought_alert"),
            ("is_flood_alert", "has_flood_alert"),
            ("is_extreme_weather", "has_extreme_weather"),
        )
    ]
    return (
        placed.groupBy("island", "obs_date", "run_date")
        .agg(
            F.count("*").alias("city_count"),
            mean("temp_max_c", 2).alias("avg_temp_max_c"),
            mean("temp_min_c", 2).alias("avg_temp_min_c"),
            round_half_away(settled_sum(F.col("precip_mm")), 2).alias("total_precip_mm"),
            round_half_away(F.max("precip_mm"), 2).alias("max_precip_mm"),
            mean("humidity_pct", 2).alias("avg_humidity_pct"),
            mean("windspeed_kmh", 2).alias("avg_windspeed_kmh"),
            mean("drought_index", 4).alias("avg_drought_index"),
            round_half_away(F.max("drought_index"), 4).alias("max_drought_index"),
            mean("fire_weather_idx", 4).alias("avg_fire_idx"),
            round_half_away(F.max("fire_weather_idx"), 4).alias("max_fire_idx"),
            *counts,
            *alerts,
        )
        .withColumn("transformed_at", F.current_timestamp())
        .select(*schemas.GOLD_WEATHER_ISLAND_DAILY.names)
    )


def island_ranking(islands: DataFrame) -> DataFrame:
    """Islands by their worst drought index."""
    return islands.select(
        "island", "obs_date", "city_count", "max_drought_index", "max_fire_idx", "cities_ekstrem"
    ).orderBy(falling("max_drought_index"), rising("island"), rising("obs_date"))


def star_fact(
    gold: DataFrame, dim_date: DataFrame, dim_condition: DataFrame, dim_risk: DataFrame
) -> DataFrame:
    """Gold rows as star-schema facts: one per (location, date), the newest run wins.

    Rows without a known location or date are left out; an unknown condition or
    risk falls back to id 1.
    """
    conditions = dim_condition.select("condition_id", F.col("condition_code").alias("condition_label"))
    risks = dim_risk.select("risk_id", "risk_code")
    dates = dim_date.select("date_id", F.col("full_date").alias("obs_date"))
    facts = (
        gold.where(F.col("location_id").isNotNull())
        .join(dates, "obs_date")
        .join(conditions, "condition_label", "left")
        .join(risks, "risk_code", "left")
        .withColumns(
            {
                "condition_id": F.coalesce("condition_id", F.lit(1)),
                "risk_id": F.coalesce("risk_id", F.lit(1)),
                "apparent_temp_max": F.col("apparent_temp_max_c"),
                "source_api": F.lit(SOURCE_API),
            }
        )
        .select(*schemas.FACT_WEATHER_DAILY.names)
    )
    return latest_per_key(facts, schemas.TABLE_KEYS["fact_weather_daily"], ["run_date"])


def _worst_first(df: DataFrame) -> DataFrame:
    return df.orderBy(wx.category_rank(F.col("risk_category")), falling("drought_index"), rising("location_key"))


def alert_dashboard(gold: DataFrame, dim_location: DataFrame) -> DataFrame:
    """The latest observed day of the whole table, worst risk first."""
    places = dim_location.select("location_key", "city_name", "province", "island")
    return _worst_first(
        at_latest(gold, "obs_date")
        .join(places, "location_key", "left")
        .select(
            "location_key",
            "city_name",
            "province",
            "island",
            "obs_date",
            "temp_max_c",
            "precip_mm",
            "drought_index",
            "fire_weather_idx",
            "dry_day_streak",
            "risk_category",
            "alert_color",
            "is_fire_alert",
            "is_drought_alert",
            "is_flood_alert",
            "is_extreme_weather",
            "season",
            "monsoon_phase",
            "is_el_nino_period",
        )
    )


# Text flags of the report, in print order.
REPORT_FLAGS = (("is_fire_alert", "[KARHUTLA]"), ("is_drought_alert", "[KEKERINGAN]"), ("is_extreme_weather", "[EKSTREM]"))
HIGH_RISK = ("TINGGI", "EKSTREM")


def daily_report(gold: DataFrame, dim_location: DataFrame, run_date: str) -> DataFrame:
    """The last day of one run, worst risk first, with text flags."""
    run = gold.where(F.col("run_date") == F.lit(run_date).cast("date"))
    flags = F.concat_ws(" ", *[F.when(F.col(c), F.lit(text)) for c, text in REPORT_FLAGS])
    return _worst_first(
        at_latest(run, "obs_date")
        .join(dim_location.select("location_key", "city_name"), "location_key", "left")
        .select(
            "location_key",
            F.coalesce("city_name", "location_key").alias("city_name"),
            "alert_color",
            "temp_max_c",
            "precip_mm",
            "drought_index",
            "fire_weather_idx",
            "risk_category",
            "is_fire_alert",
            "is_drought_alert",
            "is_extreme_weather",
            flags.alias("flags"),
        )
    )


def high_risk(report: DataFrame) -> DataFrame:
    return _worst_first(report.where(F.col("risk_category").isin(*HIGH_RISK)))


# -- stored tables -----------------------------------------------------------
def store_bronze(batch: DataFrame, path: str, table: str) -> None:
    """Append the observations the run does not hold yet.

    Rows whose key is not whole (a document may list an empty time) are no observations:
    they go to ``<path>_rejected``, where they can be counted, and not into the table.
    """
    keys = schemas.TABLE_KEYS[table]
    with scratch(batch.sparkSession, "bronze") as folder:  # two filters of one parse
        whole, rejected = split_complete(stored(batch, f"{folder}/parsed"), keys)
        append_new(whole, path, keys, ["run_date"], ["extracted_at"])
        if not rejected.isEmpty():
            append_new(rejected, f"{path}_rejected", keys, ["run_date"], ["extracted_at"])


def store_silver(batch: DataFrame, path: str, table: str) -> None:
    """Append cleaned rows the run does not hold yet, next to what batch runs have stored."""
    append_new(batch, path, schemas.TABLE_KEYS[table], ["run_date"])


def store_run(df: DataFrame, path: str, run_date: str, table: str | None = None) -> None:
    """Replace the rows of one run by those in df; repeating a run gives the same table.

    With the name of the table its keys are checked before any row shows (`publish_partition`).
    """
    if table:
        publish_partition(df, path, schemas.TABLE_KEYS[table], "run_date", run_date)
    else:
        replace_partition(df, path, "run_date", run_date)


def store_star_fact(facts: DataFrame, path: str) -> None:
    """Upsert into the fact, which is partitioned by month so that old months are not rewritten."""
    monthly = facts.withColumn("date_month", F.floor(F.col("date_id") / 100).cast("int"))
    upsert(monthly, path, schemas.TABLE_KEYS["fact_weather_daily"], ["run_date"], ["date_month"])
