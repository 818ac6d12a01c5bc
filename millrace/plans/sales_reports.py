"""Reports over fact_sales_performance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.cleaning import falling, rising
from millrace.functions.numbers import round_half_away, settled_mean, settled_sum
from millrace.operators.ranking import top_ranked_per_group
from millrace.operators.shares import share_of_total

PRODUCT = ("ProductName", "Category", "Subcategory")


def _revenue():
    return settled_sum(F.col("TotalRevenue"), 2)


def preview(fact: DataFrame, rows: int = 20) -> DataFrame:
    return fact.orderBy("ProductID", "TerritoryID").limit(rows)


def top_products(fact: DataFrame, k: int = 10) -> DataFrame:
    sums = fact.groupBy(*PRODUCT).agg(_revenue().alias("TotalRevenue"), F.sum("TotalQty").alias("TotalQty"))
    return sums.orderBy(falling("TotalRevenue"), *[rising(c) for c in PRODUCT]).limit(k)


def by_territory(fact: DataFrame) -> DataFrame:
    return (
        fact.groupBy("TerritoryName", "CountryRegionCode")
        .agg(
            _revenue().alias("TotalRevenue"),
            F.sum("TotalQty").alias("TotalQty"),
            F.countDistinct("ProductID").alias("TotalProducts"),
        )
        .orderBy(falling("TotalRevenue"), "TerritoryName")
    )


def top_per_territory(fact: DataFrame, k: int = 5) -> DataFrame:
    rows = fact.select("TerritoryName", "ProductName", "Category", "TotalRevenue", "TotalQty")
    ranked = top_ranked_per_group(rows, "TerritoryName", "TotalRevenue", k, "RankInTerritory")
    return ranked.orderBy("TerritoryName", "RankInTerritory", "ProductName")


def margin_by_category(fact: DataFrame) -> DataFrame:
    return (
        fact.groupBy("Category", "Subcategory")
        .agg(
            round_half_away(settled_mean(F.col("MarginPct")), 2).alias("AvgMarginPct"),
            round_half_away(settled_mean(F.col("Margin")), 2).alias("AvgMargin"),
            round_half_away(_revenue(), 2).alias("TotalRevenue"),
            F.sum("TotalQty").alias("TotalQty"),
        )
        .orderBy(falling("AvgMarginPct"), "Category", "Subcategory")
    )


def high_margin_low_quantity(fact: DataFrame, margin_over: float = 40.0, quantity_under: int = 100) -> DataFrame:
    return (
        fact.groupBy(*PRODUCT)
        .agg(
            F.sum("TotalQty").alias("TotalQty"),
            settled_mean(F.col("MarginPct")).alias("AvgMarginPct"),
            _revenue().alias("TotalRevenue"),
        )
        .where((F.col("AvgMarginPct") > margin_over) & (F.col("TotalQty") < quantity_under))
        .orderBy(falling("AvgMarginPct"), *PRODUCT)
    )


def category_share(fact: DataFrame) -> DataFrame:
    groups = fact.groupBy("Category").agg(_revenue().alias("CategoryRevenue"))
    total = settled_sum(F.col("CategoryRevenue"), 2)
    return share_of_total(groups, "CategoryRevenue", "RevenueSharePct", total).orderBy(
        falling("CategoryRevenue"), "Category"
    )


def load_audit(fact: DataFrame) -> DataFrame:
    return fact.agg(F.max("LoadTimestamp").alias("LastLoadTime"), F.count("*").alias("TotalRows"))
