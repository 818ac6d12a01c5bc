"""Reports over fact_hr_workforce."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.cleaning import falling, ladder, rising
from millrace.functions.numbers import percent, round_half_away, settled_mean
from millrace.operators.ranking import top_rows_with_group_rank
from millrace.operators.shares import compared_with_average

# Tenure brackets in years.
FIRST_BRACKET = "0-5 tahun"
BRACKET_STEPS = ((5.0, "5-10 tahun"), (10.0, "10-15 tahun"), (15.0, "15+ tahun"))


def _mean(column: str):
    return round_half_away(settled_mean(F.col(column)), 2)


def _spread(column: str, suffix: str):
    return [
        _mean(column).alias(f"Avg{suffix}"),
        round_half_away(F.min(column), 2).alias(f"Min{suffix}"),
        round_half_away(F.max(column), 2).alias(f"Max{suffix}"),
    ]


def tenure_by_department(fact: DataFrame) -> DataFrame:
    return (
        fact.groupBy("DepartmentName")
        .agg(F.count("*").alias("TotalKaryawan"), *_spread("TenureYears", "TenureYears"))
        .orderBy(falling("AvgTenureYears"), "DepartmentName")
    )


def top_pay(fact: DataFrame, k: int = 5) -> DataFrame:
    rows = fact.select("FullName", "JobTitle", "DepartmentName", "LatestPayRate", "TenureYears")
    return top_rows_with_group_rank(rows, "DepartmentName", "LatestPayRate", k, "RankInDept", ["FullName"])


def mover_percent(fact: DataFrame) -> DataFrame:
    groups = fact.groupBy("DepartmentName").agg(
        F.count("*").alias("TotalKaryawan"), F.count_if("IsMover").alias("TotalMover")
    )
    return groups.withColumn("MoverPct", percent(F.col("TotalMover"), F.col("TotalKaryawan"))).orderBy(
        falling("MoverPct"), "DepartmentName"
    )


def pay_by_bracket(fact: DataFrame) -> DataFrame:
    bracket = ladder(F.col("TenureYears"), BRACKET_STEPS, FIRST_BRACKET)
    return (
        fact.groupBy(bracket.alias("TenureBracket"))
        .agg(
            F.count("*").alias("JumlahKaryawan"),
            *_spread("LatestPayRate", "PayRate"),
            F.min("TenureYears").alias("shortest"),
        )
        .orderBy(rising("shortest"))
        .drop("shortest")
    )


def job_titles(fact: DataFrame) -> DataFrame:
    return (
        fact.groupBy("DepartmentName", "JobTitle")
        .agg(
            F.count("*").alias("JumlahKaryawan"),
            _mean("LatestPayRate").alias("AvgPayRate"),
            _mean("TenureYears").alias("AvgTenure"),
        )
        .orderBy("DepartmentName", falling("JumlahKaryawan"), "JobTitle")
    )


def long_tenure_low_pay(fact: DataFrame, years: float = 10.0) -> DataFrame:
    rows = compared_with_average(
        fact, settled_mean(F.col("LatestPayRate")), lambda average: F.col("LatestPayRate") < average
    )
    return (
        rows.where(F.col("TenureYears") > years)
        .select("FullName", "DepartmentName", "JobTitle", "TenureYears", "LatestPayRate")
        .orderBy(falling("TenureYears"), "FullName")
    )
