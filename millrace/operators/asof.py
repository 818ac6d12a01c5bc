"""The latest earlier row of another table, whatever the gap."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def by_month(time: Column) -> Column:
    return F.date_trunc("month", time)


def latest_before(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    time: str,
    values: Sequence[str],
    *,
    bucket: Callable[[Column], Column] = by_month,
    same_time: bool = False,
    prefix: str = "last_",
) -> DataFrame:
    """Add to each row of left, as ``last_<column>``, the values and the time of right's newest row of the key before it.

    Both tables have ``keys`` and ``time``. With ``same_time`` a row of the same moment counts too.
    Of several rows of right with one key and time the largest by ``values`` counts. NULL
    keys match each other; a row without a time gets NULLs.

    Rows meet in a sorted pass over (key, bucket of time), so that a key with most of the rows is
    spread over its buckets. What a bucket hands on is its last row: these, one per key and bucket,
    are carried forward in a second pass, which reaches over any number of empty buckets.
    """
    moment, kept = F.col(time), [time, *values]
    found = right.where(moment.isNotNull()).groupBy(*keys, time).agg(F.max(F.struct(*values)).alias("v"))
    found = found.select(*keys, F.col(time).alias("at"), F.struct(time, *[F.col(f"v.{c}").alias(c) for c in values]).alias("seen"))
    asked = left.select(*keys, moment.alias("at"), F.struct("*").alias("row"))
    both = asked.unionByName(found, allowMissingColumns=True).withColumn("bucket", bucket(F.col("at")))
    # of one moment, rows of left stand before those of right unless these count too
    turn = F.col("row").isNotNull() if same_time else F.col("row").isNull()
    inside = Window.partitionBy(*keys, "bucket").orderBy("at", turn).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marked = both.withColumn("near", F.last("seen", ignorenulls=True).over(inside)).where(F.col("row").isNotNull())
    lasts = both.groupBy(*keys, "bucket").agg(F.max_by("seen", F.when(F.col("seen").isNotNull(), F.col("at"))).alias("own"))
    earlier = Window.partitionBy(*keys).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = lasts.withColumn("far", F.last("own", ignorenulls=True).over(earlier)).where(F.col("far").isNotNull())
    carried = carried.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("bucket").alias("_bucket"), "far")
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    joined = marked.join(carried, [*same, F.col("bucket") == F.col("_bucket")], "left")
    last = F.when(F.col("at").isNotNull(), F.coalesce("near", "far"))
    return joined.select("row.*", last.alias("_last")).select(*left.columns, *[F.col(f"_last.{c}").alias(f"{prefix}{c}") for c in kept])
