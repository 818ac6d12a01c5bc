"""Runs of dry days per location."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.weather import WET_DAY_MM


def dry_day_streaks(df: DataFrame, series: Sequence[str] = ("location_key", "run_date")) -> DataFrame:
    """Add ``dry_day_streak`` and ``dry_day_streak_true``.

    ``dry_day_streak`` is the running count of dry days (rows so far minus wet
    rows so far), which never starts again after rain. ``dry_day_streak_true``
    counts the dry days since the last wet one. Both are 0 on a wet day.

    A series holds one row per calendar day (the key of silver), so its length
    is bounded by the calendar and not by the volume of the source. All three
    window columns share one shuffle and one sort.
    """
    in_order = Window.partitionBy(*series).orderBy("obs_date")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    wet = F.col("precip_mm") >= WET_DAY_MM
    dry = F.col("precip_mm") < WET_DAY_MM
    numbered = df.withColumns(
        {
            "day_no": F.row_number().over(in_order),
            "wet_days": F.count(F.when(wet, 1)).over(so_far),
        }
    ).withColumn("last_wet", F.coalesce(F.max(F.when(wet, F.col("day_no"))).over(so_far), F.lit(0)))
    return numbered.withColumns(
        {
            "dry_day_streak": F.when(dry, F.col("day_no") - F.col("wet_days")).otherwise(0).cast("int"),
            "dry_day_streak_true": F.when(dry, F.col("day_no") - F.col("last_wet")).otherwise(0).cast("int"),
        }
    ).drop("day_no", "wet_days", "last_wet")


def previous_day_streak(gold: DataFrame, name: str = "prev_streak") -> DataFrame:
    """Add the streak of the day before, 0 where there is none.

    An equi-join on the shifted date; for days held by several runs the newest run counts.
    """
    before = (
        gold.groupBy("location_key", "obs_date")
        .agg(F.max_by("dry_day_streak", "run_date").alias(name))
        .select("location_key", F.date_add("obs_date", 1).alias("obs_date"), name)
    )
    return gold.join(before, ["location_key", "obs_date"], "left").withColumn(name, F.coalesce(name, F.lit(0)))


def continue_streaks(gold: DataFrame, earlier: DataFrame) -> DataFrame:
    """Extend true streaks that begin on the first row of a batch with the streak stored before it.

    ``earlier`` is gold of previous runs. Only its last day before the batch
    matters, and only if that is the day before the batch starts.
    """
    starts = gold.groupBy("location_key", "run_date").agg(
        F.min("obs_date").alias("first_day"),
        F.min(F.when(F.col("precip_mm") >= WET_DAY_MM, F.col("obs_date"))).alias("first_wet"),
    )
    stored = earlier.groupBy("location_key", F.date_add("obs_date", 1).alias("first_day")).agg(
        F.max_by("dry_day_streak_true", "run_date").alias("carried")
    )
    carried = starts.join(stored, ["location_key", "first_day"]).drop("first_day")
    opening = F.col("first_wet").isNull() | (F.col("obs_date") < F.col("first_wet"))
    streak = F.col("dry_day_streak_true") + F.when(opening, F.coalesce("carried", F.lit(0))).otherwise(0)
    return (
        gold.join(carried, ["location_key", "run_date"], "left")
        .withColumn("dry_day_streak_true", streak.cast("int"))
        .drop("carried", "first_wet")
    )
