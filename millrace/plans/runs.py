"""Whole runs: the steps of each warehouse in order, on stored tables.

Every step reads what the step before stored, and every store is idempotent, so
a run that failed half-way is simply started again.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import schemas
from millrace.functions.calendar import EL_NINO_FROM
from millrace.functions.weather import WET_DAY_MM
from millrace.operators import quality
from millrace.operators.merge import append_new, publish_partition
from millrace.operators.streaks import continue_streaks
from millrace.plans import packs, sales, weather
from millrace.sources import files, landing, seeds
from millrace.sources.jdbc import SALES_TABLES, TableSpec
from millrace.sources.versions import RunLedger, VersionedTable


# -- sales -------------------------------------------------------------------
def sales_ingestion(spark: SparkSession, read: Callable[[TableSpec], DataFrame], base: str, dt: str) -> DataFrame:
    """Copy the six source tables (``read`` is usually a JDBC reader) and check that all can be read back."""
    paths = files.ingest_tables(read, SALES_TABLES, base, dt)
    summary = files.validation_summary(spark, paths, dt)
    files.require_valid(summary)
    return summary


def sales_warehouse(spark: SparkSession, base: str, dt: str, *, money: str = "double", exclude_online: bool = False) -> DataFrame:
    """Bronze views, stored silver tables and the gold fact of one load date; returns the fact.

    Each money flavour has tables of its own (``..._decimal``), because their columns differ in type.
    Silver tables are versioned: a load that fails, or whose keys are broken, leaves the last one in place.
    """
    suffix = "" if money == "double" else f"_{money}"
    raw = {s.folder: files.read_partition(spark, files.raw_path(base, s.folder), dt).drop("dt") for s in SALES_TABLES}
    files.register_bronze_views(spark, base, raw, dt)

    def store(df: DataFrame, table: str) -> DataFrame:
        versions = VersionedTable(spark, f"{base.rstrip('/')}/silver/{table}{suffix}", df.schema)
        audit = (lambda rows: check_rows(rows, table)) if table in schemas.TABLE_KEYS else None  # order lines have no key
        versions.replace(df, audit=audit, batch_date=dt)
        versions.vacuum()
        return versions.read()

    orders = sales.stg_sales_orders(
        raw["sales_order_header"],
        raw["sales_order_detail"],
        raw["sales_territory"],
        exclude_online=exclude_online,
        money=money,
    )
    products = sales.stg_products(raw["product"], raw["product_subcategory"], raw["product_category"], money=money)
    summary = store(
        sales.sales_summary(store(orders, "stg_sales_orders"), store(products, "stg_products"), money=money),
        "trf_sales_summary",
    )
    fact = sales.fact_sales_performance(summary, dt)
    path = f"{base.rstrip('/')}/gold/fact_sales_performance{suffix}"
    publish_partition(fact, path, [*schemas.TABLE_KEYS["fact_sales_performance"], "BatchDate"], "BatchDate", dt)
    return spark.read.schema(fact.schema).parquet(path).where(F.col("BatchDate") == F.lit(dt).cast("date"))


def write_reports(tables: dict[str, DataFrame], base: str) -> list[str]:
    """Every report whose facts are given, stored as ``reports/<pack>/<report>``; returns the paths."""
    paths = []
    for name, report in packs.analytic_queries(tables).items():
        paths.append(f"{base.rstrip('/')}/reports/{name}")
        report.coalesce(1).write.mode("overwrite").parquet(paths[-1])  # reports are short, and keep their order
    return paths


# -- weather -----------------------------------------------------------------
class Warehouse:
    """The stored weather tables below one folder."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")
        self.ledger = RunLedger(spark, f"{self.base}/_runs")

    def path(self, table: str) -> str:
        return f"{self.base}/{table}"

    def read(self, table: str, run_date: str | None = None) -> DataFrame:
        schema = schemas.STORED_TABLES[table][0]
        df = files.read_or_empty(self.spark, self.path(table), schema)
        return df if run_date is None else df.where(F.col("run_date") == F.lit(run_date).cast("date"))

    def seed(self, dates: tuple[dt.date, dt.date] = seeds.DATE_RANGE) -> None:
        """Store the dimensions; rows whose key is there stay as they are, so a user's own rows survive."""
        for table, (keys, build) in DIMENSIONS.items():
            rows = build(self.spark, *dates) if table == "dim_date" else build(self.spark)
            append_new(rows, self.path(table), keys)

    def add(self, table: str, rows: DataFrame) -> None:
        """More rows of a dimension, such as own locations."""
        append_new(rows.select(*schemas.STORED_TABLES[table][0].names), self.path(table), DIMENSIONS[table][0])


DIMENSIONS = {
    "dim_location": (["location_key"], seeds.dim_location),
    "dim_date": (["date_id"], seeds.dim_date),
    "dim_weather_condition": (["condition_code"], seeds.dim_weather_condition),
    "dim_risk_level": (["risk_code"], seeds.dim_risk_level),
}
LAST_STEP = "gold_weather"  # of a run, in the ledger
NAMED = 50  # missing files named in an error; all are counted


def check_landing(spark: SparkSession, base: str, run_date: str, dim_location: DataFrame, policy: str = "raise") -> None:
    """Every location must have both files of the run."""
    found = landing.found_files(spark, base, run_date)
    missing = landing.missing_files(dim_location, found, run_date, run_date)
    first = missing.orderBy("object_key").limit(NAMED).agg(F.concat_ws(", ", F.sort_array(F.collect_list("object_key"))).alias("names"))
    count = missing.agg(F.count("*").alias("n"))
    names = F.when(F.col("n") > NAMED, F.concat("names", F.lit(" and more: "), F.col("n").cast("string"))).otherwise(F.col("names"))
    result = count.join(first).select((F.col("n") == 0).alias("passed"), names.alias("detail"))
    quality.enforce(result.select(F.lit("landing_files").alias("check"), "passed", "detail"), policy)


def write_manifest(spark: SparkSession, base: str, run_date: str, total_locations: int) -> None:
    """Summary of the daily files of the run, below ``_manifests``."""
    documents = landing.read_documents(spark, landing.landing_globs(base, "daily", run_date), "daily")
    days = landing.parse_documents(documents, "daily").groupBy("location_key", "run_date", "source_file").agg(
        F.count("*").alias("days_returned")
    )
    files_of_run = landing.found_files(spark, base, run_date).where("resolution = 'daily'")
    sizes = files_of_run.select("location_key", "run_date", "size_bytes")
    entries = days.join(sizes, ["location_key", "run_date"]).withColumnRenamed("source_file", "object_key")
    manifest = landing.manifest(entries, total_locations)
    manifest.write.mode("overwrite").json(f"{base.rstrip('/')}/_manifests/{run_date}")


def load_bronze(spark: SparkSession, base: str, house: Warehouse, run_date: str) -> None:
    for resolution in landing.RESOLUTIONS:
        documents = landing.read_documents(spark, landing.landing_globs(base, resolution, run_date), resolution)
        table = f"bronze_weather_{resolution}"
        weather.store_bronze(landing.parse_documents(documents, resolution), house.path(table), table)


def build_silver(house: Warehouse, run_date: str, el_nino_from: dt.date = EL_NINO_FROM) -> None:
    daily = weather.silver_daily(house.read("bronze_weather_daily", run_date), el_nino_from=el_nino_from)
    weather.store_run(daily, house.path("silver_weather_daily"), run_date, "silver_weather_daily")
    hourly = weather.silver_hourly(house.read("bronze_weather_hourly", run_date))
    weather.store_run(hourly, house.path("silver_weather_hourly"), run_date, "silver_weather_hourly")


def _days_before(gold: DataFrame) -> list[dt.date]:
    """The days before the first days of the locations of a run; the calendar bounds their number."""
    firsts = gold.groupBy("location_key").agg(F.min("obs_date").alias("first"))
    return [r.day for r in firsts.select(F.date_sub("first", 1).alias("day")).distinct().collect() if r.day]


def build_gold(house: Warehouse, run_date: str) -> None:
    """Gold, the island aggregate and the star fact of one run; true streaks go on from earlier runs."""
    location = house.read("dim_location")
    gold = weather.gold_daily(house.read("silver_weather_daily", run_date), location)
    before = house.read("gold_weather_daily").where(F.col("run_date") < F.lit(run_date).cast("date"))
    before = before.where(F.col("obs_date").isin(_days_before(house.read("silver_weather_daily", run_date))))
    gold = continue_streaks(gold, before).select(*schemas.GOLD_WEATHER_DAILY.names)
    weather.store_run(gold, house.path("gold_weather_daily"), run_date, "gold_weather_daily")
    gold = house.read("gold_weather_daily", run_date)
    islands = weather.island_daily(gold, location)
    weather.store_run(islands, house.path("gold_weather_island_daily"), run_date, "gold_weather_island_daily")
    quality.enforce(left_out(house, gold), "warn")
    sync_star_fact(house, gold)


def stale_run(house: Warehouse, after: str) -> str | None:
    """The first run after `after` whose streaks do not go on from what earlier runs now say.

    What hangs on earlier runs is the streak of a location's first day. It is summed up for each run
    and compared with the streak of the day before in the newest run before it that has that day.
    """
    gold = house.read("gold_weather_daily").select("location_key", "obs_date", "run_date", "precip_mm", "dry_day_streak_true")
    later = gold.where(F.col("run_date") > F.lit(after).cast("date"))
    openings = later.groupBy("location_key", "run_date").agg(
        F.min("obs_date").alias("first"), F.min_by(F.struct("precip_mm", "dry_day_streak_true"), "obs_date").alias("opening")
    )
    days = [r["day"] for r in openings.select(F.date_sub("first", 1).alias("day")).distinct().collect()]  # the calendar bounds them
    before = gold.where(F.col("obs_date").isin(days)).select(
        "location_key", F.date_add("obs_date", 1).alias("first"), F.col("run_date").alias("told"), F.col("dry_day_streak_true").alias("streak")
    )
    told = openings.join(before, ["location_key", "first"], "left").where(F.col("told").isNull() | (F.col("told") < F.col("run_date")))
    carried = told.groupBy("location_key", "run_date").agg(F.max_by("streak", "told").alias("streak"))
    checked = openings.join(carried, ["location_key", "run_date"], "left")
    dry = F.col("opening.precip_mm") < WET_DAY_MM
    expected = F.when(dry, F.coalesce("streak", F.lit(0)) + 1).otherwise(0)
    stale = checked.where(~expected.eqNullSafe(F.col("opening.dry_day_streak_true")))
    return stale.agg(F.min("run_date").cast("string").alias("run")).first()["run"]


def redo_later_runs(house: Warehouse, run_date: str) -> list[str]:
    """Build the gold of those later runs anew whose streaks hung on what `run_date` has changed; returns them."""
    redone, at = [], run_date
    while at := stale_run(house, at):
        build_gold(house, at)
        redone.append(at)
    return redone


def sync_star_fact(house: Warehouse, gold: DataFrame | None = None) -> None:
    """Upsert gold into the star fact; without `gold` all of it, which rebuilds a lost fact."""
    gold = house.read("gold_weather_daily") if gold is None else gold
    dims = [house.read(t) for t in ("dim_date", "dim_weather_condition", "dim_risk_level")]
    weather.store_star_fact(weather.star_fact(gold, *dims), house.path("fact_weather_daily"))


def left_out(house: Warehouse, gold: DataFrame) -> DataFrame:
    """How many gold rows the star fact cannot hold, for want of a location or a date."""
    dates = house.read("dim_date").select(F.col("full_date").alias("obs_date"), F.lit(True).alias("dated"))
    checked = gold.select("location_id", "obs_date").join(dates, "obs_date", "left")
    lost = F.col("location_id").isNull() | F.col("dated").isNull()
    return quality.run_checks(checked, [quality.Check("rows_left_out_of_fact", F.count_if(lost), equals=0)])


def check_rows(rows: DataFrame, table: str) -> None:
    """Keys must be whole and unique, in place of the database's constraints."""
    keys = schemas.TABLE_KEYS[table]
    quality.enforce(quality.key_check(rows, keys, f"{table}_unique"))
    quality.enforce(quality.whole_key_check(rows, keys, f"{table}_not_null"))


def check_keys(house: Warehouse, table: str, run_date: str | None = None) -> None:
    check_rows(house.read(table, run_date), table)


def create_dashboard_view(house: Warehouse, name: str = "gold_alert_dashboard") -> None:
    """The dashboard as a view: it is computed from the stored gold table whenever it is queried."""
    gold = house.read("gold_weather_daily")
    weather.alert_dashboard(gold, house.read("dim_location")).createOrReplaceTempView(name)


def weather_run(
    spark: SparkSession,
    landing_base: str,
    warehouse_base: str,
    run_date: str,
    *,
    least_cities: int = 10,
    el_nino_from: dt.date = EL_NINO_FROM,
    dates: tuple[dt.date, dt.date] = seeds.DATE_RANGE,
) -> DataFrame:
    """Landing files to the daily report; a failed gate stops the run before the next layer.

    The stored dimensions decide which locations are expected (see `Warehouse.add`).
    """
    house = Warehouse(spark, warehouse_base)
    house.seed(dates)
    location = house.read("dim_location")
    cities = location.count()

    def bronze() -> int:
        check_landing(spark, landing_base, run_date, location)
        write_manifest(spark, landing_base, run_date, cities)
        load_bronze(spark, landing_base, house, run_date)
        check_keys(house, "bronze_weather_daily", run_date)
        check_keys(house, "bronze_weather_hourly", run_date)
        rows = house.read("bronze_weather_daily", run_date)
        quality.enforce(quality.run_checks(rows, quality.bronze_checks(cities)), "warn")
        return rows.count()

    def silver() -> int:
        build_silver(house, run_date, el_nino_from)
        rows = house.read("silver_weather_daily", run_date)
        quality.enforce(quality.run_checks(rows, quality.silver_checks(least_cities)))
        return rows.count()

    def gold() -> int:
        build_gold(house, run_date)
        redo_later_runs(house, run_date)
        check_keys(house, "fact_weather_daily")
        rows = house.read("gold_weather_daily", run_date)
        quality.enforce(quality.run_checks(rows, quality.gold_checks(least_cities, el_nino_from)))
        return rows.count()

    # a step that is done from these files is not done again; an interrupted one is
    source = f"{landing.source_versions(spark, landing_base, run_date).get(run_date)}/{cities}/{el_nino_from}/{least_cities}"
    for step, load in (("bronze_weather", bronze), ("silver_weather", silver), (LAST_STEP, gold)):
        house.ledger.perform(step, run_date, source, load)
    create_dashboard_view(house)
    return weather.daily_report(house.read("gold_weather_daily", run_date), location, run_date)


def open_runs(spark: SparkSession, landing_base: str, warehouse_base: str) -> list[str]:
    """The runs in the landing zone that were never finished; told from names and the ledger, no table is read.

    A run whose files have changed since is done again by `weather_run`, which compares them.
    """
    ledger = Warehouse(spark, warehouse_base).ledger
    found = sorted(landing.source_versions(spark, landing_base))
    return [run for run in found if (ledger.record(LAST_STEP, run) or {}).get("state") != "done"]
