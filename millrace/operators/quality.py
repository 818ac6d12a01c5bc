"""Data-quality checks: every check of a table is computed in one pass."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.calendar import EL_NINO_FROM

log = logging.getLogger(__name__)


class QualityError(ValueError):
    """A check with policy 'raise' failed."""


@dataclass(frozen=True)
class Check:
    name: str
    measure: Column  # an aggregate
    at_least: int | None = None
    equals: int | None = None

    def passed(self, column: Column) -> Column:
        return column >= self.at_least if self.at_least is not None else column == self.equals


def run_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """(check, passed, detail) rows; ``detail`` is the measured number."""
    measures = df.agg(*[c.measure.cast("bigint").alias(f"m{i}") for i, c in enumerate(checks)])
    rows = [
        F.struct(
            F.lit(c.name).alias("check"),
            c.passed(F.col(f"m{i}")).alias("passed"),
            F.col(f"m{i}").cast("string").alias("detail"),
        )
        for i, c in enumerate(checks)
    ]
    return measures.select(F.inline(F.array(*rows)))


def enforce(results: DataFrame, policy: str = "raise") -> bool:
    """Log failures ('warn') or raise ('raise'); there is one row per check."""
    failed = [f"{r['check']}: {r['detail']}" for r in results.where("NOT passed").collect()]
    if failed and policy == "raise":
        raise QualityError("; ".join(failed))
    for line in failed:
        log.warning("quality check failed: %s", line)
    return not failed


def bronze_checks(expected_cities: int = 15) -> list[Check]:
    empty = F.col("temp_max").isNull() & F.col("temp_min").isNull() & F.col("precip_sum").isNull()
    return [
        Check("city_coverage", F.countDistinct("location_key"), at_least=expected_cities),
        Check("rows_without_measures", F.count_if(empty), equals=0),
    ]


def silver_checks(least_cities: int = 10) -> list[Check]:
    odd = ~F.col("temp_max_c").between(10.0, 50.0)
    return [
        Check("city_coverage", F.countDistinct("location_key"), at_least=least_cities),
        Check("temperature_out_of_range", F.count_if(odd), equals=0),
        Check("missing_obs_date", F.count_if(F.col("obs_date").isNull()), equals=0),
    ]


def gold_checks(least_cities: int = 10, el_nino_from: dt.date = EL_NINO_FROM) -> list[Check]:
    late = (F.col("obs_date") >= F.lit(el_nino_from)) & ~F.col("is_el_nino_period")
    return [
        Check("city_coverage", F.countDistinct("location_key"), at_least=least_cities),
        Check("missing_risk", F.count_if(F.col("risk_category").isNull()), equals=0),
        Check("drought_out_of_range", F.count_if(~F.col("drought_index").between(0.0, 1.0)), equals=0),
        Check("el_nino_flag_wrong", F.count_if(late), equals=0),
    ]


def key_check(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Number of keys that occur more than once."""
    copies = df.groupBy(*keys).agg(F.count("*").alias("copies"))
    return run_checks(copies, [Check(name, F.count_if(F.col("copies") > 1), equals=0)])


def whole_key_check(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Number of rows whose key is not whole."""
    return run_checks(df, [Check(name, F.count_if(F.greatest(*[F.col(k).isNull() for k in keys], F.lit(False))), equals=0)])
