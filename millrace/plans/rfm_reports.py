"""Reports over fact_customer_rfm."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.cleaning import falling, lookup
from millrace.functions.numbers import percent, round_half_away, settled_mean
from millrace.operators.shares import compared_with_average, share_of_total

# Segment names, in report order, with the column that counts them.
SEGMENTS = {"Champions": "Champions", "Loyal": "Loyal", "At Risk": "AtRisk", "Lost": "Lost"}


def _mean(column: str, places: int):
    return round_half_away(settled_mean(F.col(column)), places)


def _segment_counts():
    return [F.count_if(F.col("Segment") == segment).alias(name) for segment, name in SEGMENTS.items()]


def top_champions(fact: DataFrame, k: int = 10) -> DataFrame:
    return (
        fact.where(F.col("Segment") == "Champions")
        .select("CustomerName", "TerritoryName", "Recency", "Frequency", "Monetary", "RFM_Score", "Segment")
        .orderBy(falling("RFM_Score"), falling("Monetary"), "CustomerName")
        .limit(k)
    )


def segment_distribution(fact: DataFrame) -> DataFrame:
    groups = fact.groupBy("Segment").agg(
        F.count("*").alias("JumlahCustomer"),
        _mean("Monetary", 2).alias("AvgMonetary"),
        _mean("Frequency", 1).alias("AvgFrequency"),
        _mean("Recency", 0).alias("AvgRecencyDays"),
    )
    position = lookup(F.col("Segment"), {segment: i for i, segment in enumerate(SEGMENTS)})
    return (
        share_of_total(groups, "JumlahCustomer", "PctDariTotal")
        .select("Segment", "JumlahCustomer", "PctDariTotal", "AvgMonetary", "AvgFrequency", "AvgRecencyDays")
        .orderBy(position.asc_nulls_last())
    )


def territory_profile(fact: DataFrame) -> DataFrame:
    return (
        fact.groupBy("TerritoryName")
        .agg(
            F.count("*").alias("TotalCustomer"),
            _mean("Recency", 0).alias("AvgRecency"),
            _mean("Frequency", 1).alias("AvgFrequency"),
            _mean("Monetary", 2).alias("AvgMonetary"),
            _mean("RFM_Score", 2).alias("AvgRFMScore"),
            *_segment_counts(),
        )
        .orderBy(falling("AvgRFMScore"), "TerritoryName")
    )


def win_back(fact: DataFrame, days: int = 365) -> DataFrame:
    rows = compared_with_average(fact, settled_mean(F.col("Monetary")), lambda average: F.col("Monetary") > average)
    return (
        rows.where(F.col("Recency") > days)
        .select(
            "CustomerName", "TerritoryName", F.col("Recency").alias("RecencyDays"), "Frequency", "Monetary", "Segment"
        )
        .orderBy(falling("Monetary"), "CustomerName")
    )


def champions_percent(fact: DataFrame) -> DataFrame:
    return (
        fact.groupBy("TerritoryName")
        .agg(
            _mean("RFM_Score", 2).alias("AvgRFMScore"),
            _mean("R_Score", 2).alias("AvgR"),
            _mean("F_Score", 2).alias("AvgF"),
            _mean("M_Score", 2).alias("AvgM"),
            percent(F.count_if(F.col("Segment") == "Champions"), F.count("*")).alias("ChampionsPct"),
        )
        .orderBy(falling("AvgRFMScore"), "TerritoryName")
    )


def heat_map(fact: DataFrame) -> DataFrame:
    return (
        fact.groupBy("R_Score", "F_Score")
        .agg(
            F.count("*").alias("JumlahCustomer"),
            _mean("Monetary", 2).alias("AvgMonetary"),
            _mean("RFM_Score", 2).alias("AvgRFMScore"),
        )
        .orderBy(falling("R_Score"), falling("F_Score"))
    )


def load_audit(fact: DataFrame) -> DataFrame:
    return fact.agg(
        F.max("LoadTimestamp").alias("LastLoadTime"),
        F.count("*").alias("TotalCustomer"),
        F.countDistinct("TerritoryName").alias("TotalTerritory"),
        *_segment_counts(),
    )
