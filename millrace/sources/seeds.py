"""Seed dimensions of the weather warehouse."""

from __future__ import annotations

import datetime as dt

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace import schemas
from millrace.functions.calendar import calendar_columns, date_key

TIME_ZONE = "Asia/Jakarta"

# Key, city, province, island, region type, climate zone, latitude, longitude, elevation.
LOCATIONS = [
    ("jakarta", "Jakarta", "DKI Jakarta", "Jawa", "urban", "Pesisir Utara Jawa", -6.2088, 106.8456, 8.0),
    ("surabaya", "Surabaya", "Jawa Timur", "Jawa", "urban", "Pesisir Utara Jawa", -7.2575, 112.7521, 5.0),
    ("bandung", "Bandung", "Jawa Barat", "Jawa", "highland", "Dataran Tinggi Jawa", -6.9175, 107.6191, 768.0),
    ("semarang", "Semarang", "Jawa Tengah", "Jawa", "coastal", "Pesisir Utara Jawa", -6.9932, 110.4203, 5.0),
    ("yogyakarta", "Yogyakarta", "DI Yogyakarta", "Jawa", "urban", "Lembah Jawa Selatan", -7.7956, 110.3695, 113.0),
    ("medan", "Medan", "Sumatera Utara", "Sumatera", "urban", "Delta Sumatera", 3.5952, 98.6722, 23.0),
    ("palembang", "Palembang", "Sumatera Selatan", "Sumatera", "peatland", "Lahan Gambut Sumatera", -2.9761, 104.7754, 11.0),
    ("pekanbaru", "Pekanbaru", "Riau", "Sumatera", "peatland", "Lahan Gambut Sumatera", 0.5103, 101.4478, 30.0),
    ("palangkaraya", "Palangkaraya", "Kalimantan Tengah", "Kalimantan", "peatland", "Lahan Gambut Kalimantan", -2.2136, 113.9108, 27.0),
    ("samarinda", "Samarinda", "Kalimantan Timur", "Kalimantan", "urban", "Kalimantan Timur", -0.4948, 117.1436, 13.0),
    ("makassar", "Makassar", "Sulawesi Selatan", "Sulawesi", "coastal", "Pesisir Sulawesi", -5.1477, 119.4327, 2.0),
    ("manado", "Manado", "Sulawesi Utara", "Sulawesi", "coastal", "Sulawesi Utara", 1.4748, 124.8421, 5.0),
    ("jayapura", "Jayapura", "Papua", "Papua", "coastal", "Papua Utara", -2.5337, 140.7181, 15.0),
    ("kupang", "Kupang", "Nusa Tenggara Timur", "NTT", "coastal", "NTT Kering", -10.1772, 123.6070, 80.0),
    ("mataram", "Mataram", "Nusa Tenggara Barat", "Lombok", "urban", "Lombok", -8.5833, 116.1167, 23.0),
]
# Code, label, rain category, extreme, thunder, risk multiplier.
CONDITIONS = [
    ("CLEAR", "Cerah", "Tidak Hujan", False, False, 0.8),
    ("PARTLY_CLOUDY", "Cerah Berawan", "Tidak Hujan", False, False, 0.9),
    ("CLOUDY", "Berawan", "Tidak Hujan", False, False, 1.0),
    ("DRIZZLE", "Gerimis", "Ringan", False, False, 1.0),
    ("LIGHT_RAIN", "Hujan Ringan", "Ringan (<20mm)", False, False, 1.1),
    ("MODERATE_RAIN", "Hujan Sedang", "Sedang (20-50mm)", False, False, 1.2),
    ("HEAVY_RAIN", "Hujan Lebat", "Lebat (50-100mm)", False, False, 1.5),
    ("VERY_HEAVY", "Hujan Sangat Lebat", "Sangat Lebat (100-150mm)", True, False, 1.8),
    ("EXTREME_RAIN", "Hujan Ekstrem", "Ekstrem (>150mm)", True, True, 2.5),
    ("THUNDERSTORM", "Hujan Badai", "Ekstrem", True, True, 3.0),
    ("FOG", "Kabut", "Tidak Hujan", False, False, 1.0),
    ("HAZE", "Asap/Kabut Asap", "Tidak Hujan", True, False, 1.5),
]
# Code, category, score, the four hazard columns, action, colour.
RISK_LEVELS = [
    ("R_LOW", "RENDAH", 10, "RENDAH", "RENDAH", "RENDAH", "RENDAH", "Monitor rutin.", "GREEN"),
    ("R_MODERATE", "SEDANG", 40, "SEDANG", "SEDANG", "SEDANG", "SEDANG", "Siaga Level 2.", "YELLOW"),
    ("R_HIGH", "TINGGI", 70, "TINGGI", "TINGGI", "TINGGI", "TINGGI", "Siaga Level 1.", "ORANGE"),
    ("R_EXTREME", "EKSTREM", 95, "EKSTREM", "EKSTREM", "EKSTREM", "EKSTREM", "TANGGAP DARURAT.", "RED"),
]
DATE_RANGE = (dt.date(2024, 1, 1), dt.date(2030, 12, 31))


def _local(spark: SparkSession, rows: list[tuple], schema: StructType) -> DataFrame:
    """Rows as a local relation, whose exact size Catalyst knows when it picks a join."""
    columns = {name: [row[i] for row in rows] for i, name in enumerate(schema.names)}
    return spark.createDataFrame(pa.table(columns), schema)


def dim_location(spark: SparkSession) -> DataFrame:
    rows = [(i, *row, TIME_ZONE, True) for i, row in enumerate(LOCATIONS, 1)]
    return _local(spark, rows, schemas.DIM_LOCATION)


def dim_weather_condition(spark: SparkSession) -> DataFrame:
    return _local(spark, [(i, *row) for i, row in enumerate(CONDITIONS, 1)], schemas.DIM_WEATHER_CONDITION)


def dim_risk_level(spark: SparkSession) -> DataFrame:
    return _local(spark, [(i, *row) for i, row in enumerate(RISK_LEVELS, 1)], schemas.DIM_RISK_LEVEL)


def date_series(spark: SparkSession, first: dt.date, last: dt.date) -> DataFrame:
    """One row per day, both ends included."""
    days = F.sequence(F.lit(first), F.lit(last), F.expr("INTERVAL 1 DAY"))
    return spark.range(1).select(F.explode(days).alias("full_date"))


def dim_date(spark: SparkSession, first: dt.date = DATE_RANGE[0], last: dt.date = DATE_RANGE[1]) -> DataFrame:
    """Date dimension; every calendar column is filled from the date."""
    day = F.col("full_date")
    features = {**calendar_columns(day), "day_of_year": F.dayofyear(day), "date_id": date_key(day)}
    return date_series(spark, first, last).withColumns(features).select(*schemas.DIM_DATE.names)
