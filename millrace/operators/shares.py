"""Values compared with a figure of the whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.numbers import percent


def share_of_total(groups: DataFrame, value: str, name: str, total: Column | None = None) -> DataFrame:
    """Each group's percentage of the sum over all groups.

    The total is a scalar subquery over the grouped rows, which share the
    shuffle of the main query; no window gathers the groups in one task.
    """
    total = F.sum(value) if total is None else total
    whole = groups.agg(total.alias("whole")).scalar()
    return groups.withColumn(name, percent(F.col(value), whole))


def compared_with_average(df: DataFrame, average: Column, keep) -> DataFrame:
    """Filter by the table's own average: ``keep(average column)`` is the condition.

    The table is read twice, so df should be a stored table.
    """
    return df.where(keep(df.agg(average.alias("average")).scalar()))


def at_latest(df: DataFrame, column: str) -> DataFrame:
    """Rows at the largest value of ``column``; df is read twice, so it should be a stored table."""
    return df.where(F.col(column) == df.agg(F.max(column).alias("latest")).scalar())
