"""Maps the generic order/event sample tables to the inputs of the pipelines.

The pipelines themselves know nothing of the sample tables. All formulas in this
file are our own choice; they only have to produce plausible, repeatable values
that reach every branch of the pipelines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.cleaning import bounded, ladder
from millrace.functions.numbers import round_half_away, settled_mean, settled_sum
from millrace.sources.seeds import dim_location

RUN_DATE = "2024-01-30"
RFM_DAY = "2001-08-02"


# declared, so that opening a table does not start a job that infers its schema
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{folder.rstrip('/')}/{name}.parquet")


# -- sales -------------------------------------------------------------------
def sales_order_header(spark: SparkSession, folder: str) -> DataFrame:
    orders, customer = table(spark, folder, "orders"), table(spark, folder, "customer")
    joined = orders.join(customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    return joined.select(
        F.col("o_orderkey").alias("SalesOrderID"),
        F.col("o_orderdate").alias("OrderDate"),
        F.col("c_nationkey").alias("TerritoryID"),
        F.when(F.col("o_orderstatus").eqNullSafe("F"), 5).otherwise(1).alias("Status"),
        (F.col("o_orderpriority") == "5-LOW").alias("OnlineOrderFlag"),
    )


def sales_order_detail(spark: SparkSession, folder: str, money: str = "decimal") -> DataFrame:
    price, quantity = F.col("l_extendedprice"), F.col("l_quantity")
    unit, total = ("decimal(18,8)", "decimal(18,4)") if money == "decimal" else ("double", "double")
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("SalesOrderID"),
        F.col("l_linenumber").alias("SalesOrderDetailID"),
        F.col("l_partkey").alias("ProductID"),
        quantity.cast("smallint").alias("OrderQty"),
        F.try_divide(price, quantity).cast(unit).alias("UnitPrice"),
        (price * (1 - F.col("l_discount"))).cast(total).alias("LineTotal"),
    )


def sales_territory(spark: SparkSession, folder: str) -> DataFrame:
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("TerritoryID"),
        F.col("n_name").alias("Name"),
        F.col("r_name").alias("CountryRegionCode"),
    )


def _brand_number() -> Column:
    return F.regexp_extract("p_brand", r"#(\d+)", 1).cast("int")


def product(spark: SparkSession, folder: str) -> DataFrame:
    cost = round_half_away(F.col("p_retailprice") * (F.lit(0.3) + F.col("p_size") / F.lit(100.0)), 2)
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("ProductID"),
        F.col("p_name").alias("Name"),
        F.concat(F.lit("PN-"), F.col("p_partkey").cast("string")).alias("ProductNumber"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("ListPrice"),
        cost.cast("decimal(10,2)").alias("StandardCost"),
        F.when(F.col("p_size") % 10 != 0, _brand_number()).alias("ProductSubcategoryID"),
    )


def product_subcategory(spark: SparkSession, folder: str) -> DataFrame:
    brands = table(spark, folder, "part").select("p_brand").distinct()
    number = _brand_number()
    return brands.select(
        number.alias("ProductSubcategoryID"), F.col("p_brand").alias("Name"), (number % 6).alias("ProductCategoryID")
    )


def product_category(spark: SparkSession, folder: str) -> DataFrame:
    ids = product_subcategory(spark, folder).select("ProductCategoryID").distinct()
    name = F.concat(F.lit("Type"), F.col("ProductCategoryID").cast("string"))
    return ids.select("ProductCategoryID", name.alias("Name"))


SALES_FRAMES = {
    "sales_order_header": sales_order_header,
    "sales_order_detail": sales_order_detail,
    "sales_territory": sales_territory,
    "product": product,
    "product_subcategory": product_subcategory,
    "product_category": product_category,
}


# -- weather -----------------------------------------------------------------
def _located(events: DataFrame, spark: SparkSession) -> DataFrame:
    keys = dim_location(spark).select("location_id", "location_key")
    return events.join(keys, "location_id")


def _of(kind: str) -> Column:
    return F.when(F.col("event_type") == kind, F.col("value"))


def bronze_weather_daily(
    spark: SparkSession, folder: str, run_date: str = RUN_DATE, first: str | None = None, last: str | None = None
) -> DataFrame:
    """One row per (location, day). Only order-independent aggregates are used."""
    day = F.col("ts").cast("date")
    events = table(spark, folder, "events")
    if first:
        events = events.where(day >= F.lit(first).cast("date"))
    if last:
        events = events.where(day <= F.lit(last).cast("date"))
    cells = events.groupBy((F.col("user_id") % 15 + 1).cast("int").alias("location_id"), day.alias("obs_date")).agg(
        F.max(_of("view")).alias("views"),
        F.min(_of("click")).alias("clicks"),
        F.max(_of("error")).alias("errors"),
        F.max(_of("signup")).alias("signups"),
        F.min(_of("purchase")).alias("purchases"),
        F.max("value").alias("largest"),
        F.min("value").alias("smallest"),
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
    )
    temp_max = F.lit(8.0) + F.col("views") / F.lit(6.0)
    run = F.lit(run_date).cast("date")
    minute = "yyyy-MM-dd'T'HH:mm"
    return _located(cells, spark).select(
        F.xxhash64("location_key", run, "obs_date").alias("bronze_id"),
        "location_key",
        run.alias("run_date"),
        "obs_date",
        F.col("last_ts").alias("extracted_at"),
        F.current_timestamp().alias("ingested_at"),
        temp_max.alias("temp_max"),
        F.col("clicks").alias("temp_min"),
        (temp_max + F.lit(2.0)).alias("apparent_temp_max"),
        (F.col("errors") - F.lit(60.0)).alias("precip_sum"),
        (F.col("signups") / F.lit(4.0)).alias("windspeed_max"),
        (F.lit(100.0) - F.col("purchases")).alias("humidity_max"),
        F.date_format("first_ts", minute).alias("sunrise"),
        F.date_format("last_ts", minute).alias("sunset"),
        (F.col("errors") / F.lit(40.0)).alias("uv_index_max"),
        F.col("smallest").alias("evapotranspiration"),
        F.floor(F.col("largest") / F.lit(5.0)).cast("int").alias("weathercode"),
        F.concat(F.lit("weather/raw/daily/"), "location_key", F.lit(f"/{run_date}.json")).alias("source_file"),
    )


def bronze_weather_hourly(spark: SparkSession, folder: str, run_date: str = RUN_DATE) -> DataFrame:
    cells = (
        table(spark, folder, "events")
        .groupBy(
            (F.col("user_id") % 15 + 1).cast("int").alias("location_id"),
            F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour_timestamp"),
        )
        .agg(
            F.max(_of("view")).alias("views"),
            F.min(_of("click")).alias("clicks"),
            F.max(_of("error")).alias("errors"),
            F.max(_of("signup")).alias("signups"),
            F.min(_of("purchase")).alias("purchases"),
            F.max("value").alias("largest"),
            F.min("value").alias("smallest"),
            F.max("ts").alias("last_ts"),
        )
    )
    temperature = F.col("views") / F.lit(4.0)
    run = F.lit(run_date).cast("date")
    return _located(cells, spark).select(
        F.xxhash64("location_key", run, "hour_timestamp").alias("bronze_id"),
        "location_key",
        run.alias("run_date"),
        "hour_timestamp",
        F.col("last_ts").alias("extracted_at"),
        F.current_timestamp().alias("ingested_at"),
        temperature.alias("temperature_2m"),
        (F.col("errors") - F.lit(60.0)).alias("precipitation"),
        (F.col("signups") / F.lit(4.0)).alias("windspeed_10m"),
        (F.lit(100.0) - F.col("purchases")).alias("humidity_2m"),
        (temperature + F.lit(1.0)).alias("apparent_temp"),
        F.col("clicks").alias("precip_prob"),
        (F.col("largest") - F.lit(20.0)).alias("cloudcover"),
        (F.col("smallest") / F.lit(100.0)).alias("soil_moisture"),
        F.concat(F.lit("weather/raw/hourly/"), "location_key", F.lit(f"/{run_date}.json")).alias("source_file"),
    )


def landing_files(spark: SparkSession, folder: str) -> DataFrame:
    """(location_key, resolution, run_date): a daily file where errors were seen that day, an hourly one where signups were."""
    resolution = F.when(F.col("event_type") == "error", "daily").when(F.col("event_type") == "signup", "hourly")
    found = (
        table(spark, folder, "events")
        .select(
            (F.col("user_id") % 15 + 1).cast("int").alias("location_id"),
            resolution.alias("resolution"),
            F.col("ts").cast("date").alias("run_date"),
        )
        .where("resolution IS NOT NULL")
        .distinct()
    )
    return _located(found, spark).select("location_key", "resolution", "run_date")


# -- facts without a pipeline ------------------------------------------------
def stg_purchase_orders(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("VendorID"), F.col("l_returnflag").alias("ShipMethodName")
    )


def fact_vendor_performance(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    supplier = table(spark, folder, "supplier").select("s_suppkey", "s_name")
    days = F.abs(F.datediff(F.col("l_shipdate").cast("date"), F.col("o_orderdate").cast("date")))
    measured = (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("l_suppkey")
        .agg(
            F.count("*").alias("TotalOrders"),
            F.count_if(days <= 1350).alias("on_time"),
            F.sum(days).alias("days"),
            settled_mean(F.try_divide(F.col("l_extendedprice"), F.col("l_quantity"))).alias("price"),
            F.max("o_orderdate").alias("LoadTimestamp"),
        )
    )
    n = F.col("TotalOrders").cast("double")
    rated = measured.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.col("l_suppkey").alias("VendorID"),
        F.col("s_name").alias("VendorName"),
        "TotalOrders",
        round_half_away(F.col("on_time") * F.lit(100.0) / n, 2).alias("OnTimeRate"),
        round_half_away(F.col("days") / n, 1).alias("AvgLeadTimeDays"),
        round_half_away(F.col("price") - F.lit(4750.0), 2).alias("AvgPriceVariance"),
        "LoadTimestamp",
    )
    score = F.lit(60.0) - F.col("AvgPriceVariance") / F.lit(10.0) + (F.col("OnTimeRate") - F.lit(79.5))
    return rated.withColumn("VendorScore", round_half_away(bounded(score, default=0.0, low=0.0, high=100.0), 2))


RECENCY_LIMITS = (70, 170, 333, 715)
FREQUENCY_STEPS = (8, 10, 12, 14)
MONETARY_STEPS = (1.8e6, 2.4e6, 3.0e6, 3.6e6)


def fact_customer_rfm(spark: SparkSession, folder: str) -> DataFrame:
    customer, nation = table(spark, folder, "customer"), table(spark, folder, "nation")
    spent = (
        table(spark, folder, "orders")
        .groupBy("o_custkey")
        .agg(
            F.max("o_orderdate").alias("LoadTimestamp"),
            F.count("*").alias("Frequency"),
            settled_sum(F.col("o_totalprice"), 2).alias("Monetary"),
        )
    )
    recency = F.datediff(F.lit(RFM_DAY).cast("date"), F.col("LoadTimestamp").cast("date"))

    def score(value: Column, steps) -> Column:
        return sum((F.when(value >= F.lit(s), 1).otherwise(0) for s in steps), F.lit(1))

    late = sum((F.when(recency > limit, 1).otherwise(0) for limit in RECENCY_LIMITS), F.lit(0))
    named = (
        spent.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("c_name").alias("CustomerName"),
            F.col("n_name").alias("TerritoryName"),
            recency.alias("Recency"),
            "Frequency",
            "Monetary",
            (F.lit(5) - late).alias("R_Score"),
            score(F.col("Frequency"), FREQUENCY_STEPS).alias("F_Score"),
            score(F.col("Monetary"), MONETARY_STEPS).alias("M_Score"),
            "LoadTimestamp",
        )
    )
    total = F.col("R_Score") + F.col("F_Score") + F.col("M_Score")
    segment = ladder(F.col("RFM_Score"), ((6, "At Risk"), (9, "Loyal"), (12, "Champions")), "Lost")
    return named.withColumn("RFM_Score", total).withColumn("Segment", segment)


def fact_hr_workforce(spark: SparkSession, folder: str) -> DataFrame:
    moves = (
        table(spark, folder, "orders")
        .groupBy("o_custkey")
        .agg(F.countDistinct("o_orderpriority").alias("priorities"))
    )
    customer = table(spark, folder, "customer")
    return customer.join(moves, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        F.col("c_name").alias("FullName"),
        F.concat(F.lit("Title "), (F.col("c_nationkey") % 5).cast("string")).alias("JobTitle"),
        F.col("c_mktsegment").alias("DepartmentName"),
        round_half_away(F.lit(10.0) + (F.col("c_acctbal") + F.lit(1000.0)) / F.lit(200.0), 2).alias("LatestPayRate"),
        (F.col("c_custkey") * 37 % 200 / F.lit(10.0)).alias("TenureYears"),
        F.coalesce(F.col("priorities") == 5, F.lit(False)).alias("IsMover"),
    )
