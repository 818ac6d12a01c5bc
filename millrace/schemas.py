"""Column lists of every layer, as Spark schemas, and the statements that create the tables."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

_TYPES = {
    "smallint": ShortType(),
    "int": IntegerType(),
    "bigint": LongType(),
    "double": DoubleType(),
    "string": StringType(),
    "boolean": BooleanType(),
    "date": DateType(),
    "timestamp": TimestampType(),
    "timestamp_ntz": TimestampNTZType(),
    "decimal(6,2)": DecimalType(6, 2),
    "decimal(10,2)": DecimalType(10, 2),
    "decimal(15,2)": DecimalType(15, 2),
    "decimal(18,4)": DecimalType(18, 4),
    "decimal(18,8)": DecimalType(18, 8),
}


def _schema(text: str) -> StructType:
    """``name type, name type, ...``; unlike ``StructType.fromDDL`` it needs no running session."""
    return StructType([StructField(name, _TYPES[kind]) for name, kind in (c.split() for c in text.split(", "))])


# -- sales sources -----------------------------------------------------------
SALES_ORDER_HEADER = _schema(
    "SalesOrderID bigint, OrderDate timestamp_ntz, TerritoryID int, Status int, OnlineOrderFlag boolean"
)
SALES_ORDER_DETAIL = _schema(
    "SalesOrderID bigint, SalesOrderDetailID int, ProductID bigint, OrderQty smallint, "
    "UnitPrice decimal(18,8), LineTotal decimal(18,4)"
)
SALES_TERRITORY = _schema("TerritoryID int, Name string, CountryRegionCode string")
PRODUCT = _schema(
    "ProductID bigint, Name string, ProductNumber string, ListPrice decimal(10,2), "
    "StandardCost decimal(10,2), ProductSubcategoryID int"
)
PRODUCT_SUBCATEGORY = _schema("ProductSubcategoryID int, Name string, ProductCategoryID int")
PRODUCT_CATEGORY = _schema("ProductCategoryID int, Name string")

# -- sales warehouse ---------------------------------------------------------
STG_SALES_ORDERS = _schema(
    "SalesOrderID bigint, SalesOrderDetailID int, OrderDate date, ProductID bigint, OrderQty int, "
    "UnitPrice double, LineTotal double, TerritoryID int, TerritoryName string, CountryRegionCode string"
)
STG_PRODUCTS = _schema(
    "ProductID bigint, ProductName string, ProductNumber string, ListPrice double, StandardCost double, "
    "Category string, Subcategory string"
)
TRF_SALES_SUMMARY = _schema(
    "ProductID bigint, ProductName string, ProductNumber string, Category string, Subcategory string, "
    "TerritoryID int, TerritoryName string, CountryRegionCode string, TotalRevenue double, TotalQty bigint, "
    "AvgUnitPrice double, ListPrice double, StandardCost double, Margin double, MarginPct double"
)
FACT_SALES_PERFORMANCE = StructType(
    TRF_SALES_SUMMARY.fields + _schema("LoadTimestamp timestamp_ntz, BatchDate date").fields
)
# the database flavour of the same table
FACT_SALES_PERFORMANCE_DECIMAL = StructType(
    _schema(
        "ProductID bigint, ProductName string, ProductNumber string, Category string, Subcategory string, "
        "TerritoryID int, TerritoryName string, CountryRegionCode string, TotalRevenue decimal(15,2), TotalQty bigint, "
        "AvgUnitPrice decimal(10,2), ListPrice decimal(10,2), StandardCost decimal(10,2), Margin decimal(10,2), "
        "MarginPct decimal(6,2)"
    ).fields
    + _schema("LoadTimestamp timestamp_ntz, BatchDate date").fields
)

# -- weather landing ---------------------------------------------------------
LANDING_META = _schema(
    "location_key string, province string, island string, latitude double, longitude double, "
    "extracted_at string, run_date string, source string, api_url string, resolution string"
)
# Landing array name -> bronze column.
DAILY_FIELDS = {
    "temperature_2m_max": "temp_max",
    "temperature_2m_min": "temp_min",
    "apparent_temperature_max": "apparent_temp_max",
    "precipitation_sum": "precip_sum",
    "wind_speed_10m_max": "windspeed_max",
    "relative_humidity_2m_max": "humidity_max",
    "sunrise": "sunrise",
    "sunset": "sunset",
    "uv_index_max": "uv_index_max",
    "et0_fao_evapotranspiration": "evapotranspiration",
    "weather_code": "weathercode",
}
HOURLY_FIELDS = {
    "temperature_2m": "temperature_2m",
    "precipitation": "precipitation",
    "wind_speed_10m": "windspeed_10m",
    "relative_humidity_2m": "humidity_2m",
    "apparent_temperature": "apparent_temp",
    "precipitation_probability": "precip_prob",
    "cloud_cover": "cloudcover",
    "soil_moisture_0_to_1cm": "soil_moisture",
}
MANIFEST = StructType(
    [
        *_schema("run_date date, created_at timestamp, total_locations bigint, files_ingested bigint, part int, parts int").fields,
        StructField(
            "locations",
            ArrayType(_schema("location_key string, run_date date, object_key string, size_bytes bigint, days_returned bigint")),
        ),
        StructField("status", StringType()),
    ]
)

# -- weather dimensions ------------------------------------------------------
DIM_LOCATION = _schema(
    "location_id int, location_key string, city_name string, province string, island string, region_type string, "
    "climate_zone string, latitude double, longitude double, elevation_m double, timezone string, is_active boolean"
)
DIM_DATE = _schema(
    "date_id int, full_date date, year int, month int, quarter int, day_of_year int, day_of_week int, "
    "week_of_year int, season string, monsoon_phase string, is_el_nino_period boolean, is_peak_dry boolean, "
    "is_peak_wet boolean"
)
DIM_WEATHER_CONDITION = _schema(
    "condition_id int, condition_code string, condition_label string, precip_category string, is_extreme boolean, "
    "has_thunder boolean, risk_multiplier double"
)
DIM_RISK_LEVEL = _schema(
    "risk_id int, risk_code string, risk_category string, risk_score int, flood_risk string, drought_risk string, "
    "wildfire_risk string, heat_risk string, mitigation_action string, alert_color string"
)

# -- weather layers ----------------------------------------------------------
BRONZE_WEATHER_DAILY = _schema(
    "bronze_id bigint, location_key string, run_date date, obs_date date, extracted_at timestamp_ntz, "
    "ingested_at timestamp, temp_max double, temp_min double, apparent_temp_max double, precip_sum double, "
    "windspeed_max double, humidity_max double, sunrise string, sunset string, uv_index_max double, "
    "evapotranspiration double, weathercode int, source_file string"
)
BRONZE_WEATHER_HOURLY = _schema(
    "bronze_id bigint, location_key string, run_date date, hour_timestamp timestamp_ntz, extracted_at timestamp_ntz, "
    "ingested_at timestamp, temperature_2m double, precipitation double, windspeed_10m double, humidity_2m double, "
    "apparent_temp double, precip_prob double, cloudcover double, soil_moisture double, source_file string"
)
_CALENDAR = (
    "year int, month int, quarter int, quarter_rounded int, day_of_week int, week_of_year int, season string, "
    "monsoon_phase string, is_el_nino_period boolean, is_peak_dry boolean, is_peak_wet boolean"
)
SILVER_WEATHER_DAILY = _schema(
    "silver_id bigint, location_key string, obs_date date, run_date date, temp_max_c double, temp_min_c double, "
    "temp_avg_c double, apparent_temp_max_c double, precip_mm double, windspeed_kmh double, humidity_pct double, "
    f"uv_index_max double, evapotranspiration double, weathercode int, {_CALENDAR}, bronze_id bigint, "
    "transformed_at timestamp"
)
SILVER_WEATHER_HOURLY = _schema(
    "silver_id bigint, location_key string, hour_timestamp timestamp_ntz, run_date date, temperature_c double, "
    "precipitation_mm double, windspeed_kmh double, humidity_pct double, apparent_temp_c double, "
    "precip_prob_pct double, cloudcover_pct double, soil_moisture double, obs_date date, obs_hour int, "
    "bronze_id bigint, transformed_at timestamp"
)
GOLD_WEATHER_DAILY = _schema(
    "gold_id bigint, location_key string, location_id int, obs_date date, run_date date, temp_max_c double, "
    "temp_min_c double, temp_avg_c double, apparent_temp_max_c double, precip_mm double, windspeed_kmh double, "
    "humidity_pct double, uv_index_max double, drought_index double, fire_weather_idx double, heat_index double, "
    "crop_stress_score double, dry_day_streak int, dry_day_streak_true int, condition_label string, "
    "risk_category string, risk_code string, alert_color string, is_extreme_weather boolean, "
    "is_drought_alert boolean, is_flood_alert boolean, is_fire_alert boolean, season string, monsoon_phase string, "
    "is_el_nino_period boolean, is_peak_dry boolean, is_peak_wet boolean, silver_id bigint, transformed_at timestamp"
)
GOLD_WEATHER_ISLAND_DAILY = _schema(
    "island string, obs_date date, run_date date, city_count bigint, avg_temp_max_c double, avg_temp_min_c double, "
    "total_precip_mm double, max_precip_mm double, avg_humidity_pct double, avg_windspeed_kmh double, "
    "avg_drought_index double, max_drought_index double, avg_fire_idx double, max_fire_idx double, "
    "cities_rendah bigint, cities_sedang bigint, cities_tinggi bigint, cities_ekstrem bigint, "
    "has_fire_alert boolean, has_drought_alert boolean, has_flood_alert boolean, has_extreme_weather boolean, "
    "transformed_at timestamp"
)
FACT_WEATHER_DAILY = _schema(
    "location_id int, date_id int, condition_id int, risk_id int, temp_max_c double, temp_min_c double, "
    "temp_avg_c double, precip_mm double, windspeed_kmh double, humidity_pct double, apparent_temp_max double, "
    "drought_index double, dry_day_streak int, heat_index double, fire_weather_idx double, crop_stress_score double, "
    "is_extreme_weather boolean, is_drought_alert boolean, is_flood_alert boolean, is_fire_alert boolean, "
    "run_date date, source_api string"
)

# key columns of each stored table, in place of PRIMARY KEY / UNIQUE
TABLE_KEYS = {
    "bronze_weather_daily": ("location_key", "run_date", "obs_date"),
    "bronze_weather_hourly": ("location_key", "run_date", "hour_timestamp"),
    "silver_weather_daily": ("location_key", "obs_date", "run_date"),
    "silver_weather_hourly": ("location_key", "hour_timestamp", "run_date"),
    "gold_weather_daily": ("location_key", "obs_date", "run_date"),
    "gold_weather_island_daily": ("island", "obs_date", "run_date"),
    "fact_weather_daily": ("location_id", "date_id"),
    "stg_products": ("ProductID",),
    "trf_sales_summary": ("ProductID", "TerritoryID"),
    "fact_sales_performance": ("ProductID", "TerritoryID"),
}
# table -> (schema, partition columns)
STORED_TABLES = {
    "dim_location": (DIM_LOCATION, ()),
    "dim_date": (DIM_DATE, ()),
    "dim_weather_condition": (DIM_WEATHER_CONDITION, ()),
    "dim_risk_level": (DIM_RISK_LEVEL, ()),
    "bronze_weather_daily": (BRONZE_WEATHER_DAILY, ("run_date",)),
    "bronze_weather_hourly": (BRONZE_WEATHER_HOURLY, ("run_date",)),
    "silver_weather_daily": (SILVER_WEATHER_DAILY, ("run_date",)),
    "silver_weather_hourly": (SILVER_WEATHER_HOURLY, ("run_date",)),
    "gold_weather_daily": (GOLD_WEATHER_DAILY, ("run_date",)),
    "gold_weather_island_daily": (GOLD_WEATHER_ISLAND_DAILY, ("run_date",)),
    "fact_weather_daily": (StructType([*FACT_WEATHER_DAILY.fields, *_schema("date_month int").fields]), ("date_month",)),
    "stg_sales_orders": (STG_SALES_ORDERS, ()),
    "stg_products": (STG_PRODUCTS, ()),
    "trf_sales_summary": (TRF_SALES_SUMMARY, ()),
    "fact_sales_performance": (FACT_SALES_PERFORMANCE, ("BatchDate",)),
    "fact_sales_performance_decimal": (FACT_SALES_PERFORMANCE_DECIMAL, ("BatchDate",)),
}


def create_tables(spark: SparkSession, namespace: str) -> list[str]:
    """Create the namespace and every stored table that does not exist yet; safe to repeat."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {namespace}")
    names = []
    for table, (schema, partitions) in STORED_TABLES.items():
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        clause = f" PARTITIONED BY ({', '.join(partitions)})" if partitions else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {namespace}.{table} ({columns}) USING parquet{clause}")
        names.append(f"{namespace}.{table}")
    return names
