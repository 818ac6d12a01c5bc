"""Reports over fact_vendor_performance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from millrace.functions.cleaning import falling, ladder, rising
from millrace.functions.numbers import SETTLED, ratio, round_half_away, settled_mean
from millrace.operators.ranking import global_rank

# Price labels and score bands.
CHEAPER = "Lebih murah dari Standard ✓"
EQUAL_PRICE = "Sama dengan Standard"
DEARER = "Lebih mahal dari Standard ✗"
LOWEST_BAND = "Poor (<40)"
BANDS = ((40.0, "Fair (40-59)"), (60.0, "Good (60-79)"), (80.0, "Excellent (80+)"))


def ranking(fact: DataFrame) -> DataFrame:
    """Every vendor with its rank by score (0..100)."""
    rows = fact.select("VendorName", "TotalOrders", "OnTimeRate", "AvgLeadTimeDays", "AvgPriceVariance", "VendorScore")
    return (
        global_rank(rows, "VendorScore", "Rank")
        .select("Rank", *rows.columns)
        .orderBy(falling("VendorScore"), "VendorName")
    )


def by_ship_method(fact: DataFrame, purchase_orders: DataFrame) -> DataFrame:
    """Vendor figures per ship method, weighted by order line.

    Joining every order line to its vendor and averaging gives the same as
    counting the lines per (ship method, vendor) first and weighting with the
    count; only the counts are shuffled, whatever the busiest vendor holds.
    """
    lines = purchase_orders.groupBy("ShipMethodName", "VendorID").agg(F.count("*").alias("n"))
    weighted = lines.join(fact.select("VendorID", "OnTimeRate", "VendorScore", "AvgLeadTimeDays"), "VendorID")

    def mean(column: str, places: int):
        value = F.col(column).cast("double")
        lines_with_value = F.sum(F.when(value.isNotNull(), F.col("n")))
        return round_half_away(F.round(ratio(F.sum(value * F.col("n")), lines_with_value), SETTLED), places)

    return (
        weighted.groupBy("ShipMethodName")
        .agg(
            F.count("*").alias("JumlahVendor"),
            mean("OnTimeRate", 2).alias("AvgOnTimeRate"),
            mean("VendorScore", 2).alias("AvgVendorScore"),
            mean("AvgLeadTimeDays", 1).alias("AvgLeadTime"),
        )
        .orderBy(falling("AvgOnTimeRate"), "ShipMethodName")
    )


def price_status(fact: DataFrame) -> DataFrame:
    variance = F.col("AvgPriceVariance")
    status = F.when(variance < 0, CHEAPER).when(variance == 0, EQUAL_PRICE).otherwise(DEARER)
    return fact.select(
        "VendorName", "AvgPriceVariance", "OnTimeRate", "VendorScore", status.alias("PriceStatus")
    ).orderBy(rising("AvgPriceVariance"), "VendorName")


def best_of_both(fact: DataFrame, on_time: float = 80.0, variance: float = 10.0) -> DataFrame:
    return (
        fact.where((F.col("OnTimeRate") >= on_time) & (F.col("AvgPriceVariance") < variance))
        .select("VendorName", "OnTimeRate", "AvgPriceVariance", "VendorScore", "TotalOrders")
        .orderBy(falling("VendorScore"), "VendorName")
    )


def performance_bands(fact: DataFrame) -> DataFrame:
    band = ladder(F.col("VendorScore"), BANDS, LOWEST_BAND)
    return (
        fact.groupBy(band.alias("PerformanceCategory"))
        .agg(
            F.count("*").alias("JumlahVendor"),
            round_half_away(settled_mean(F.col("OnTimeRate")), 2).alias("AvgOnTimeRate"),
            round_half_away(settled_mean(F.col("AvgLeadTimeDays")), 1).alias("AvgLeadTime"),
            F.min("VendorScore").alias("lowest"),
        )
        .orderBy(falling("lowest"))
        .drop("lowest")
    )


def load_audit(fact: DataFrame) -> DataFrame:
    return fact.agg(
        F.max("LoadTimestamp").alias("LastLoadTime"),
        F.count("*").alias("TotalVendor"),
        round_half_away(settled_mean(F.col("VendorScore")), 2).alias("AvgScoreKeseluruhan"),
    )
