"""Every pipeline, operator and report as a named query over the sample tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, TimestampNTZType, TimestampType

from millrace import schemas
from millrace.operators import merge, quality
from millrace.operators.asof import latest_before
from millrace.operators.ranking import global_rank
from millrace.operators.streaks import continue_streaks, previous_day_streak
from millrace.plans import hr_reports, rfm_reports, sales, sales_reports, vendor_reports, weather
from millrace.session import stored, workspace
from millrace.sources import files, landing, sample_tables, seeds
from millrace.sources.jdbc import SALES_TABLES
from millrace.sources.versions import RunLedger, VersionedTable
from millrace.streaming import jobs

BATCH_DATE = "2024-01-01"
NEXT_DATE = "2024-01-02"
FIRST_RUN = "2024-01-20"  # the early run holds the days up to this one,
OVERLAP_FROM = "2024-01-15"  # the late run those from this one on
Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}


def portable(df: DataFrame) -> DataFrame:
    """Dates and times as ISO text and decimals as doubles, so that any engine's result compares."""
    out = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, DateType):
            column = column.cast("string")
        elif isinstance(field.dataType, (TimestampType, TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(field.dataType, DecimalType):
            column = column.cast("double")
        out.append(column.alias(field.name))
    return df.select(*out)


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = lambda spark, folder: portable(fn(spark, folder))
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


# -- building blocks ---------------------------------------------------------
# ids and load times of a table differ from run to run or engine to engine
_UNCOMPARED = ("bronze_id", "silver_id", "gold_id", "ingested_at", "transformed_at")


def _orders(spark, folder, *, exclude_online=False, money="double") -> DataFrame:
    return sales.stg_sales_orders(
        sample_tables.sales_order_header(spark, folder),
        sample_tables.sales_order_detail(spark, folder, money),
        sample_tables.sales_territory(spark, folder),
        exclude_online=exclude_online,
        money=money,
    )


def _products(spark, folder, money="double") -> DataFrame:
    levels = (sample_tables.SALES_FRAMES[n](spark, folder) for n in ("product", "product_subcategory", "product_category"))
    return sales.stg_products(*levels, money=money)


def _summary(spark, folder) -> DataFrame:
    return sales.sales_summary(_orders(spark, folder), _products(spark, folder))


def _fact(spark, folder) -> DataFrame:
    """The fact with the newest order date of the product and territory as its load time."""
    newest = F.max("OrderDate").cast("timestamp_ntz").alias("newest")
    summary = sales.sales_summary(_orders(spark, folder), _products(spark, folder), extra=[newest])
    return sales.fact_sales_performance(summary, BATCH_DATE, F.col("newest")).drop("newest")


def _silver(spark, folder) -> DataFrame:
    return weather.silver_daily(sample_tables.bronze_weather_daily(spark, folder))


def _gold(spark, folder) -> DataFrame:
    return weather.gold_daily(_silver(spark, folder), seeds.dim_location(spark))


def _early_bronze(spark, folder) -> DataFrame:
    return sample_tables.bronze_weather_daily(spark, folder, FIRST_RUN, last=FIRST_RUN)


def _late_bronze(spark, folder) -> DataFrame:
    return sample_tables.bronze_weather_daily(spark, folder, first=OVERLAP_FROM)


def _two_run_gold(spark, folder) -> DataFrame:
    silver = weather.silver_daily(_early_bronze(spark, folder).unionByName(_late_bronze(spark, folder)))
    return weather.gold_daily(silver, seeds.dim_location(spark))


def _dims(spark) -> tuple[DataFrame, DataFrame, DataFrame]:
    return seeds.dim_date(spark), seeds.dim_weather_condition(spark), seeds.dim_risk_level(spark)


def _ingest(spark, folder, names=None) -> dict[str, str]:
    """Copy the sales tables into a fresh landing zone; {folder: path}."""
    specs = [s for s in SALES_TABLES if names is None or s.folder in names]
    base = workspace(spark, "landing")
    return files.ingest_tables(lambda s: sample_tables.SALES_FRAMES[s.folder](spark, folder), specs, base, BATCH_DATE)


# -- sales warehouse ---------------------------------------------------------
@query
def silver_stg_sales_orders(spark, folder):
    return _orders(spark, folder)


@query
def pg_stg_sales_orders(spark, folder):
    return _orders(spark, folder, exclude_online=True, money="decimal").withColumn("OrderQty", F.col("OrderQty").cast("int"))


@query
def silver_stg_products(spark, folder):
    return _products(spark, folder)


@query
def silver_trf_sales_summary(spark, folder):
    return _summary(spark, folder)


@query
def pg_trf_sales_summary(spark, folder):
    orders = _orders(spark, folder, exclude_online=True, money="decimal")
    return sales.sales_summary(orders, _products(spark, folder, "decimal"), money="decimal")


@query
def gold_fact_sales_performance(spark, folder):
    return _fact(spark, folder)


@query
def sales_preview(spark, folder):
    return sales_reports.preview(_summary(spark, folder))


@query
def sales_top10_products(spark, folder):
    return sales_reports.top_products(_summary(spark, folder))


@query
def sales_by_territory(spark, folder):
    return sales_reports.by_territory(_summary(spark, folder))


@query
def sales_top5_per_territory(spark, folder):
    return sales_reports.top_per_territory(_summary(spark, folder))


@query
def sales_margin_by_category(spark, folder):
    return sales_reports.margin_by_category(_summary(spark, folder))


@query
def sales_high_margin_low_qty(spark, folder):
    return sales_reports.high_margin_low_quantity(_summary(spark, folder))


@query
def sales_category_share(spark, folder):
    return sales_reports.category_share(_summary(spark, folder))


@query
def sales_audit(spark, folder):
    return sales_reports.load_audit(_fact(spark, folder))


# -- landing zone ------------------------------------------------------------
@query
def ingest_all_tables(spark, folder):
    paths = _ingest(spark, folder)
    return files.row_counts({name: spark.read.parquet(path) for name, path in paths.items()})


@query
def raw_validation_summary(spark, folder):
    return files.validation_summary(spark, _ingest(spark, folder), BATCH_DATE).drop("detail")


@query
def bronze_scan_dt(spark, folder):
    """Two load dates of the order headers; one is read back."""
    path = files.raw_path(workspace(spark, "landing"), "sales_order_header")
    header = sample_tables.sales_order_header(spark, folder)
    files.write_partition(header, path, BATCH_DATE)
    files.write_partition(header.where(~F.col("OnlineOrderFlag")), path, NEXT_DATE)
    return files.read_partition(spark, path, NEXT_DATE)


@query
def bronze_views_count(spark, folder):
    paths = _ingest(spark, folder)
    base = next(iter(paths.values())).rsplit("/raw/", 1)[0]
    views = files.register_bronze_views(spark, base, paths, BATCH_DATE)
    return files.row_counts({view: spark.table(view) for view in views})


@query
def raw_roundtrip(spark, folder):
    """A load date written twice is there once; the other date stays."""
    path = files.raw_path(workspace(spark, "landing"), "sales_order_header")
    header = sample_tables.sales_order_header(spark, folder)
    for dt, rows in ((BATCH_DATE, header), (NEXT_DATE, header), (BATCH_DATE, header.where("Status = 5"))):
        files.write_partition(rows, path, dt)
    return spark.read.parquet(path)


@query
def export_gold(spark, folder):
    path = workspace(spark, "gold")
    files.replace_partition(sales.fact_sales_performance(_summary(spark, folder), BATCH_DATE), path, "BatchDate", BATCH_DATE)
    return spark.read.parquet(path).drop("LoadTimestamp")


@query
def landing_missing_files(spark, folder):
    found = sample_tables.landing_files(spark, folder)
    first, last = found.agg(F.min("run_date").cast("string"), F.max("run_date").cast("string")).first()
    return landing.missing_files(seeds.dim_location(spark), found, first, last)


@query
def landing_manifest(spark, folder):
    """The manifest of every run day, written as JSON and read back entry by entry."""
    daily = sample_tables.landing_files(spark, folder).where("resolution = 'daily'")
    events = (
        sample_tables.bronze_weather_daily(spark, folder)
        .select("location_key", F.col("obs_date").alias("run_date"), "extracted_at")
        .join(daily.select("location_key", "run_date"), ["location_key", "run_date"])
    )
    name = F.concat(F.lit("weather/raw/daily/"), "location_key", F.lit("/"), "run_date", F.lit(".json"))
    entries = events.select(
        "location_key",
        "run_date",
        name.alias("object_key"),
        F.length(name).cast("bigint").alias("size_bytes"),
        F.lit(1).cast("bigint").alias("days_returned"),
    )
    path = workspace(spark, "manifest")
    landing.manifest(entries, len(seeds.LOCATIONS)).write.json(path)
    written = spark.read.schema(schemas.MANIFEST).json(path)
    return written.select(
        "run_date", "total_locations", "files_ingested", "parts", "status", F.explode("locations").alias("entry")
    ).select("run_date", "total_locations", "files_ingested", "parts", "status", "entry.location_key", "entry.object_key", "entry.days_returned")


@query
def landing_daily_documents(spark, folder):
    """Bronze to JSON documents and back."""
    path = workspace(spark, "documents")
    bronze = sample_tables.bronze_weather_daily(spark, folder)
    landing.write_documents(landing.to_documents(bronze, "daily"), path)
    documents = landing.read_documents(spark, path, "daily", multi_line=False)
    return landing.parse_documents(documents, "daily").drop(*_UNCOMPARED, "extracted_at")


@query
def landing_hourly_documents(spark, folder):
    path = workspace(spark, "documents")
    bronze = sample_tables.bronze_weather_hourly(spark, folder)
    landing.write_documents(landing.to_documents(bronze, "hourly"), path)
    documents = landing.read_documents(spark, path, "hourly", multi_line=False)
    return landing.parse_documents(documents, "hourly").drop(*_UNCOMPARED, "extracted_at")


@query
def landing_named_objects(spark, folder):
    """Bronze to one object per location and run under its landing name, found by the run's globs and read back."""
    base = workspace(spark, "objects")
    bronze = sample_tables.bronze_weather_daily(spark, folder)
    landing.write_landing(landing.to_documents(bronze, "daily"), base, "daily")
    documents = landing.read_documents(spark, landing.landing_globs(base, "daily", sample_tables.RUN_DATE), "daily")
    return landing.parse_documents(documents, "daily").drop(*_UNCOMPARED, "extracted_at")


# -- weather dimensions, each with its use in the data ------------------------
@query
def dim_location(spark, folder):
    events = sample_tables.table(spark, folder, "events")
    per_location = events.groupBy((F.col("user_id") % 15 + 1).cast("int").alias("location_id")).agg(
        F.count("*").alias("observations")
    )
    return (
        seeds.dim_location(spark)
        .join(per_location, "location_id", "left")
        .withColumn("observations", F.coalesce("observations", F.lit(0)))
    )


@query
def dim_date(spark, folder):
    events = sample_tables.table(spark, folder, "events")
    per_day = events.groupBy(F.col("ts").cast("date").alias("full_date")).agg(F.count("*").alias("observations"))
    return (
        seeds.dim_date(spark).join(per_day, "full_date", "left").withColumn("observations", F.coalesce("observations", F.lit(0)))
    )


@query
def dim_weather_condition(spark, folder):
    days = _gold(spark, folder).groupBy(F.col("condition_label").alias("condition_code")).agg(F.count("*").alias("days"))
    return (
        seeds.dim_weather_condition(spark).join(days, "condition_code", "left").withColumn("days", F.coalesce("days", F.lit(0)))
    )


@query
def dim_risk_level(spark, folder):
    days = _gold(spark, folder).groupBy("risk_code").agg(F.count("*").alias("days"))
    return seeds.dim_risk_level(spark).join(days, "risk_code", "left").withColumn("days", F.coalesce("days", F.lit(0)))


# -- weather layers ----------------------------------------------------------
@query
def bronze_weather_daily(spark, folder):
    return sample_tables.bronze_weather_daily(spark, folder).drop(*_UNCOMPARED)


@query
def bronze_weather_hourly(spark, folder):
    return sample_tables.bronze_weather_hourly(spark, folder).drop(*_UNCOMPARED)


@query
def silver_weather_daily(spark, folder):
    return _silver(spark, folder).drop(*_UNCOMPARED)


@query
def silver_weather_hourly(spark, folder):
    bronze = sample_tables.bronze_weather_hourly(spark, folder)
    return weather.silver_hourly(bronze).drop(*_UNCOMPARED)


@query
def gold_weather_daily(spark, folder):
    return _gold(spark, folder).drop(*_UNCOMPARED)


@query
def gold_island_daily(spark, folder):
    return weather.island_daily(_gold(spark, folder), seeds.dim_location(spark)).drop(*_UNCOMPARED)


@query
def gold_island_ranking(spark, folder):
    return weather.island_ranking(weather.island_daily(_gold(spark, folder), seeds.dim_location(spark)))


@query
def gold_alert_dashboard(spark, folder):
    return weather.alert_dashboard(stored(_gold(spark, folder), workspace(spark, "gold")), seeds.dim_location(spark))


@query
def gold_daily_report(spark, folder):
    return weather.daily_report(stored(_gold(spark, folder), workspace(spark, "gold")), seeds.dim_location(spark), sample_tables.RUN_DATE)


@query
def gold_high_risk(spark, folder):
    return weather.high_risk(gold_daily_report(spark, folder))


@query
def fact_weather_daily(spark, folder):
    """Two overlapping runs; the newer run wins on the shared days."""
    return weather.star_fact(_two_run_gold(spark, folder), *_dims(spark))


@query
def dry_day_streak_true(spark, folder):
    """Streaks of the late run continued from gold of the early run."""
    location = seeds.dim_location(spark)
    early = weather.gold_daily(weather.silver_daily(_early_bronze(spark, folder)), location)
    later = sample_tables.bronze_weather_daily(spark, folder, first="2024-01-21")
    late = continue_streaks(weather.gold_daily(weather.silver_daily(later), location), early)
    columns = ["location_key", "obs_date", "run_date", "precip_mm", "dry_day_streak_true"]
    return early.select(*columns).unionByName(late.select(*columns))


@query
def prev_day_streak(spark, folder):
    return previous_day_streak(_gold(spark, folder)).select("location_key", "obs_date", "dry_day_streak", "prev_streak")


# -- quality -----------------------------------------------------------------
@query
def dq_bronze(spark, folder):
    return quality.run_checks(sample_tables.bronze_weather_daily(spark, folder), quality.bronze_checks())


@query
def dq_silver(spark, folder):
    return quality.run_checks(_silver(spark, folder), quality.silver_checks())


@query
def dq_gold(spark, folder):
    return quality.run_checks(_gold(spark, folder), quality.gold_checks())


@query
def dq_unique_keys(spark, folder):
    """Keys of the fact and of gold are unique; (order, line number) of the order lines is not."""
    detail = sample_tables.sales_order_detail(spark, folder)
    fact_keys = schemas.TABLE_KEYS["fact_sales_performance"]
    checks = [
        quality.key_check(_summary(spark, folder), fact_keys, "fact_sales_performance"),
        quality.key_check(_gold(spark, folder), schemas.TABLE_KEYS["gold_weather_daily"], "gold_weather_daily"),
        quality.key_check(detail, ["SalesOrderID", "SalesOrderDetailID"], "sales_order_detail"),
    ]
    return checks[0].unionByName(checks[1]).unionByName(checks[2])


# -- changing tables ---------------------------------------------------------
_KEY = list(schemas.TABLE_KEYS["bronze_weather_daily"])
_MEASURES = ["temp_max", "temp_min", "precip_sum", "windspeed_max", "humidity_max"]


@query
def upsert_ignore(spark, folder):
    """Early days, then all days offered under the same run: known days stay, new days are added, repeating adds nothing."""
    path = workspace(spark, "bronze")
    early = sample_tables.bronze_weather_daily(spark, folder, last=FIRST_RUN).withColumn("temp_max", F.col("temp_max") + 100)
    everything = sample_tables.bronze_weather_daily(spark, folder)
    for batch in (early, everything, everything):
        weather.store_bronze(batch, path, "bronze_weather_daily")
    return spark.read.schema(schemas.BRONZE_WEATHER_DAILY).parquet(path).select(*_KEY, *_MEASURES)


@query
def upsert_replace(spark, folder):
    """The star fact stored run by run; the late run replaces the shared days."""
    path = workspace(spark, "fact")
    location, dims = seeds.dim_location(spark), _dims(spark)
    for bronze in (_early_bronze(spark, folder), _late_bronze(spark, folder)):
        gold = weather.gold_daily(weather.silver_daily(bronze), location)
        weather.store_star_fact(weather.star_fact(gold, *dims), path)
    return spark.read.schema(schemas.FACT_WEATHER_DAILY).parquet(path).drop("date_month")


@query
def replace_partition(spark, folder):
    """Two runs stored, the first replaced by its dry days and stored once more."""
    path = workspace(spark, "silver")
    early, late = (weather.silver_daily(b(spark, folder)) for b in (_early_bronze, _late_bronze))
    dry = early.where("precip_mm < 1")
    for rows, run in ((early, FIRST_RUN), (late, sample_tables.RUN_DATE), (dry, FIRST_RUN), (dry, FIRST_RUN)):
        weather.store_run(rows, path, run)
    return spark.read.schema(schemas.SILVER_WEATHER_DAILY).parquet(path).select("location_key", "run_date", "obs_date", "precip_mm")


@query
def incremental_unprocessed(spark, folder):
    """Bronze days that silver of the early days does not hold."""
    done = weather.silver_daily(sample_tables.bronze_weather_daily(spark, folder, last=FIRST_RUN))
    todo = merge.unprocessed(sample_tables.bronze_weather_daily(spark, folder), done, _KEY)
    return todo.select(*_KEY, *_MEASURES)


@query
def versioned_upsert(spark, folder):
    """The newest order of each customer, in a table without partitions: two loads, the second repeated, one that failed between."""
    orders = sample_tables.table(spark, folder, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")
    newest = VersionedTable(spark, workspace(spark, "newest-orders"), orders.schema)
    early = F.col("o_orderdate") < "1996-01-01"
    for batch in (orders.where(early), orders.where(~early), orders.where(~early)):
        newest.upsert(batch, ["o_custkey"], ["o_orderdate", "o_orderkey"])

    def refuse(_):
        raise quality.QualityError("refused")

    try:
        newest.replace(orders.limit(0), audit=refuse)
    except quality.QualityError:
        return newest.read()
    raise AssertionError("the audit was passed over")


@query
def surrogate_numbers(spark, folder):
    """Customers numbered in two loads without gaps; repeating the second gives the same numbers."""
    customers = sample_tables.table(spark, folder, "customer").select(F.lit(None).cast("long").alias("customer_no"), "c_custkey", "c_nationkey")
    table = VersionedTable(spark, workspace(spark, "customers"), customers.schema)
    for batch in (customers.where("c_nationkey < 12"), customers, customers):
        table.append_numbered(batch, ["c_custkey"], "customer_no")
    return table.read()


@query
def keys_enforced(spark, folder):
    """Order lines published once per key; those that repeat a key are set aside with the reason."""
    lines = sample_tables.table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", F.lit(BATCH_DATE).cast("date").alias("dt"))
    path = workspace(spark, "lines")
    for _ in range(2):
        merge.publish_partition(lines, path, ["l_orderkey", "l_linenumber", "dt"], "dt", BATCH_DATE)
    rejected = files.read_or_empty(spark, f"{path}_rejected", lines.withColumn("reason", F.lit("")).schema)
    both = spark.read.parquet(path).withColumn("reason", F.lit("published")).unionByName(rejected)
    number = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return both.groupBy("reason").agg(
        F.count("*").alias("lines"), F.sum(F.col("l_quantity").cast("long")).alias("quantity"),
        *[F.sum(c).alias(f"sum_{c}") for c in number],
    )


@query
def run_ledger(spark, folder):
    """Two runs stored under the ledger and offered again, a third that stops half-way."""
    base = workspace(spark, "ledger")
    ledger = RunLedger(spark, f"{base}/runs")

    def load(rows, run):
        weather.store_run(rows, f"{base}/bronze", run, "bronze_weather_daily")
        return spark.read.parquet(f"{base}/bronze").where(F.col("run_date") == F.lit(run).cast("date")).count()

    for _ in range(2):
        for rows, run in ((_early_bronze(spark, folder), FIRST_RUN), (_late_bronze(spark, folder), sample_tables.RUN_DATE)):
            ledger.perform("bronze_weather_daily", run, "first", lambda rows=rows, run=run: load(rows, run))
    broken = _late_bronze(spark, folder).withColumn("temp_max", F.raise_error(F.lit("interrupted")).cast("double"))
    try:
        ledger.perform("bronze_weather_daily", FIRST_RUN, "changed", lambda: load(broken.withColumn("run_date", F.lit(FIRST_RUN).cast("date")), FIRST_RUN))
    except PySparkException:
        pass
    stored_rows = spark.read.parquet(f"{base}/bronze").groupBy(F.col("run_date").cast("string").alias("run")).agg(F.count("*").alias("stored"))
    return ledger.records().join(stored_rows, "run")


@query
def asof_last_event(spark, folder):
    """Every event with the last earlier one of its user of another kind, however long ago."""
    events = sample_tables.table(spark, folder, "events").select("event_id", "user_id", "event_type", "ts")
    first = F.col("event_type") == events.select(F.min("event_type")).first()[0]
    return latest_before(events.where(first), events.where(~first), ["user_id"], "ts", ["event_id", "event_type"])


@query
def order_price_rank(spark, folder):
    """The rank of every order by price, over a column with about as many values as rows."""
    orders = sample_tables.table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return global_rank(orders, "o_totalprice", "price_rank")


# -- streams -----------------------------------------------------------------
@query
def stream_landing_to_bronze(spark, folder):
    """Early documents, a first run, all documents, a second run: every day is stored once."""
    docs, bronze, checkpoint = (workspace(spark, n) for n in ("documents", "bronze", "offsets"))
    for last in (FIRST_RUN, None):
        rows = sample_tables.bronze_weather_daily(spark, folder, last=last)
        landing.write_documents(landing.to_documents(rows, "daily"), docs)
        jobs.landing_to_bronze(spark, docs, bronze, checkpoint, multi_line=False).awaitTermination()
    return spark.read.schema(schemas.BRONZE_WEATHER_DAILY).parquet(bronze).select(*_KEY, *_MEASURES)


@query
def stream_bronze_to_silver(spark, folder):
    """Two bronze loads, one stream run after each."""
    bronze, silver, checkpoint = (workspace(spark, n) for n in ("bronze", "silver", "offsets"))
    for rows in (_early_bronze(spark, folder), _late_bronze(spark, folder)):
        weather.store_bronze(rows, bronze, "bronze_weather_daily")
        jobs.bronze_to_silver(spark, bronze, silver, checkpoint).awaitTermination()
    return spark.read.schema(schemas.SILVER_WEATHER_DAILY).parquet(silver).drop(*_UNCOMPARED)


# -- HR ----------------------------------------------------------------------
@query
def hr_tenure_by_dept(spark, folder):
    return hr_reports.tenure_by_department(sample_tables.fact_hr_workforce(spark, folder))


@query
def hr_top5_pay(spark, folder):
    return hr_reports.top_pay(sample_tables.fact_hr_workforce(spark, folder))


@query
def hr_mover_pct(spark, folder):
    return hr_reports.mover_percent(sample_tables.fact_hr_workforce(spark, folder))


@query
def hr_pay_by_bracket(spark, folder):
    return hr_reports.pay_by_bracket(sample_tables.fact_hr_workforce(spark, folder))


@query
def hr_jobtitle_distribution(spark, folder):
    return hr_reports.job_titles(sample_tables.fact_hr_workforce(spark, folder))


@query
def hr_long_tenure_low_pay(spark, folder):
    return hr_reports.long_tenure_low_pay(sample_tables.fact_hr_workforce(spark, folder))


# -- vendors -----------------------------------------------------------------
@query
def vendor_ranking(spark, folder):
    return vendor_reports.ranking(stored(sample_tables.fact_vendor_performance(spark, folder), workspace(spark, "vendors")))


@query
def vendor_shipmethod_compare(spark, folder):
    return vendor_reports.by_ship_method(
        sample_tables.fact_vendor_performance(spark, folder), sample_tables.stg_purchase_orders(spark, folder)
    )


@query
def vendor_price_status(spark, folder):
    return vendor_reports.price_status(sample_tables.fact_vendor_performance(spark, folder))


@query
def vendor_best_of_both(spark, folder):
    return vendor_reports.best_of_both(sample_tables.fact_vendor_performance(spark, folder))


@query
def vendor_performance_bands(spark, folder):
    return vendor_reports.performance_bands(sample_tables.fact_vendor_performance(spark, folder))


@query
def vendor_audit(spark, folder):
    return vendor_reports.load_audit(sample_tables.fact_vendor_performance(spark, folder))


# -- customers ---------------------------------------------------------------
@query
def rfm_top10_champions(spark, folder):
    return rfm_reports.top_champions(sample_tables.fact_customer_rfm(spark, folder))


@query
def rfm_segment_distribution(spark, folder):
    return rfm_reports.segment_distribution(sample_tables.fact_customer_rfm(spark, folder))


@query
def rfm_territory_profile(spark, folder):
    return rfm_reports.territory_profile(sample_tables.fact_customer_rfm(spark, folder))


@query
def rfm_winback(spark, folder):
    return rfm_reports.win_back(stored(sample_tables.fact_customer_rfm(spark, folder), workspace(spark, "customers")))


@query
def rfm_champions_pct(spark, folder):
    return rfm_reports.champions_percent(sample_tables.fact_customer_rfm(spark, folder))


@query
def rfm_heatmap(spark, folder):
    return rfm_reports.heat_map(sample_tables.fact_customer_rfm(spark, folder))


@query
def rfm_audit(spark, folder):
    return rfm_reports.load_audit(sample_tables.fact_customer_rfm(spark, folder))
