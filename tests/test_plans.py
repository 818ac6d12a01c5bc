"""Shapes of the physical plans that matter at scale, and properties of whole pipelines."""

import re

import pytest
from pyspark.sql import functions as F

from millrace.operators import ranking
from millrace.plans import sales, vendor_reports, weather
from millrace.registry.queries import all_queries
from millrace.session import stored
from millrace.sources import sample_tables, seeds

FOLDER = "/root/testdata/sf0.001"
LAZY = ["silver_trf_sales_summary", "sales_top5_per_territory", "gold_weather_daily", "gold_island_daily", "rfm_territory_profile"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_no_python(spark, name):
    text = plan(all_queries()[name](spark, FOLDER))
    assert not re.search(r"Cartesian|NestedLoop|EvalPython|InPandas", text)


def test_status_filter_and_columns_reach_the_scan(spark):
    text = plan(all_queries()["silver_trf_sales_summary"](spark, FOLDER))
    assert "EqualNullSafe(o_orderstatus,F)" in text
    scanned = re.search(r"FileScan parquet \[(l_[^\]]+)\]", text).group(1)
    assert re.sub(r"#\d+L?", "", scanned) == "l_orderkey,l_partkey,l_quantity,l_extendedprice,l_discount"


def test_lines_are_summed_before_the_product_join(spark):
    text = plan(all_queries()["silver_trf_sales_summary"](spark, FOLDER))
    final_join = text.index("Join [ProductID")
    assert text.index("HashAggregate(keys=[ProductID") > final_join  # printed top down: the sum feeds the join


def test_rank_is_limited_before_the_shuffle(spark):
    assert plan(all_queries()["sales_top5_per_territory"](spark, FOLDER)).count("WindowGroupLimit") == 2


def test_gold_windows_share_one_shuffle(spark):
    text = plan(all_queries()["gold_weather_daily"](spark, FOLDER))
    assert text.count("hashpartitioning(location_key") == 1


def test_both_flavours_agree_on_offline_orders(spark):
    header = sample_tables.sales_order_header(spark, FOLDER)
    detail = sample_tables.sales_order_detail(spark, FOLDER)
    territory = sample_tables.sales_territory(spark, FOLDER)
    offline = header.where(~F.col("OnlineOrderFlag"))
    a = sales.stg_sales_orders(offline, detail, territory)
    b = sales.stg_sales_orders(header, detail, territory, exclude_online=True, money="decimal")
    assert a.count() == b.count()
    assert dict(b.dtypes)["UnitPrice"] == "decimal(10,2)" and dict(b.dtypes)["LineTotal"] == "decimal(12,2)"
    with pytest.raises(ValueError):
        sales.stg_sales_orders(header, detail, territory, money="float")


def test_build_fact_from_six_tables(spark):
    sources = {name: build(spark, FOLDER) for name, build in sample_tables.SALES_FRAMES.items()}
    fact = sales.build_fact(sources, "2026-01-01")
    assert str(fact.select("BatchDate").first()[0]) == "2026-01-01"
    assert fact.groupBy("ProductID", "TerritoryID").count().where("count > 1").count() == 0


def test_hot_vendor_is_weighted_like_the_line_join(spark):
    fact = spark.createDataFrame(
        [(1, 90.0, 10.0, 3.0), (2, 50.0, 70.0, None), (3, 10.0, 20.0, 9.5)],
        "VendorID bigint, OnTimeRate double, VendorScore double, AvgLeadTimeDays double",
    )
    lines = [(1, "A")] * 700 + [(2, "A")] * 200 + [(3, "B")] * 100 + [(2, "B")] + [(9, "C")]
    orders = spark.createDataFrame(lines, "VendorID bigint, ShipMethodName string")
    got = {r.ShipMethodName: r for r in vendor_reports.by_ship_method(fact, orders).collect()}
    joined = orders.join(fact, "VendorID").groupBy("ShipMethodName")
    for r in joined.agg(
        F.countDistinct("VendorID").alias("v"), F.avg("OnTimeRate").alias("o"), F.avg("VendorScore").alias("s"), F.avg("AvgLeadTimeDays").alias("l")
    ).collect():
        mine = got.pop(r.ShipMethodName)
        assert mine.JumlahVendor == r.v
        assert mine.AvgOnTimeRate == pytest.approx(r.o, abs=0.0051)
        assert mine.AvgVendorScore == pytest.approx(r.s, abs=0.0051)
        assert mine.AvgLeadTime == pytest.approx(r.l, abs=0.051)
    assert not got


def test_island_counts_add_up(spark):
    location = seeds.dim_location(spark)
    gold = weather.gold_daily(weather.silver_daily(sample_tables.bronze_weather_daily(spark, FOLDER)), location)
    islands = weather.island_daily(gold, location)
    parts = sum((F.col(f"cities_{c}") for c in ("rendah", "sedang", "tinggi", "ekstrem")), F.lit(0))
    assert islands.where(parts != F.col("city_count")).count() == 0
    assert islands.agg(F.sum("city_count")).first()[0] == gold.count()


def test_unknown_location_stays_in_gold_but_not_in_the_fact(spark):
    bronze = sample_tables.bronze_weather_daily(spark, FOLDER)
    stray = bronze.withColumn("location_key", F.when(F.col("location_key") == "medan", "atlantis").otherwise(F.col("location_key")))
    gold = weather.gold_daily(weather.silver_daily(stray), seeds.dim_location(spark))
    lost = gold.where("location_key = 'atlantis'")
    assert lost.count() > 0 and lost.where("location_id IS NOT NULL").count() == 0
    fact = weather.star_fact(gold, seeds.dim_date(spark), seeds.dim_weather_condition(spark), seeds.dim_risk_level(spark))
    assert fact.count() == gold.count() - lost.count()
    report = weather.daily_report(gold, seeds.dim_location(spark), sample_tables.RUN_DATE)
    assert report.where("city_name = 'atlantis'").count() <= 1


def test_rank_plan_ranks_values_and_has_no_single_task(spark, monkeypatch):
    df = spark.range(100).select((F.col("id") % 7).cast("double").alias("v"))
    kept = []
    monkeypatch.setattr(ranking, "stored", lambda rows, path: kept.append((plan(rows), stored(rows, path))) or kept[-1][1])
    text = plan(ranking.global_rank(df, "v", "place"))
    assert "partial_count" in kept[0][0] and kept[0][1].count() == 7
    assert "Window" in text and "SinglePartition" not in text
