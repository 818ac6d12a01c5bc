"""Ranks and top-k rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.cleaning import falling
from millrace.session import stored, workspace


def top_ranked_per_group(df: DataFrame, group: str, by: str, k: int, name: str) -> DataFrame:
    """Rows whose descending rank inside the group is at most k; ties stay.

    Catalyst turns rank + filter into a limit per group on both sides of the
    shuffle, so a group sends about k rows per task however large it is.
    """
    rank = F.rank().over(Window.partitionBy(group).orderBy(falling(by)))
    return df.withColumn(name, rank).where(F.col(name) <= k)


def top_rows_with_group_rank(
    df: DataFrame, group: str, by: str, k: int, name: str, tie_break: Sequence[str]
) -> DataFrame:
    """The k rows with the largest ``by``, each with its rank inside its group.

    Every row that beats a top-k row in its group is itself in the top k, so the
    rank can be taken over the k rows instead of over whole groups.
    """
    order = [falling(by), *[F.col(c).asc_nulls_last() for c in tie_break]]
    top = df.orderBy(*order).limit(k)
    rank = F.rank().over(Window.partitionBy(group).orderBy(falling(by)))
    return top.withColumn(name, rank).orderBy(*order)


def global_rank(df: DataFrame, by: str, name: str) -> DataFrame:
    """Descending rank over the whole table, on any column, without sorting it in one task.

    Rows are counted per distinct value before the shuffle. The values are dealt out by range and
    stored; the rows of each range, a few numbers, give where it begins; ranks are
    counted inside the ranges. NULL ranks last. The table is read twice (values,
    then rows), so df should be a stored table.
    """
    spark = df.sparkSession
    order = falling(by)
    values = df.groupBy(by).agg(F.count("*").alias("n")).repartitionByRange(order).sortWithinPartitions(order)
    place = F.monotonically_increasing_id()
    ranges = stored(values.select(F.col(by).alias("value"), "n", F.shiftright(place, 33).alias("part"), place.alias("place")), workspace(spark, "ranks"))
    starts, total = [], 0
    for part in ranges.groupBy("part").agg(F.sum("n").alias("rows")).orderBy("part").collect():
        starts.append((part["part"], total))
        total += part["rows"]
    starts = F.broadcast(spark.createDataFrame(starts, "part long, start long"))  # a row per range
    inside = Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n").over(inside), F.lit(0))
    ranks = ranges.withColumn("before", before).join(starts, "part")
    ranks = ranks.select(F.col("value").alias("ranked_value"), (F.col("start") + F.col("before") + 1).alias(name))
    return df.join(ranks, df[by].eqNullSafe(F.col("ranked_value")), "inner").drop("ranked_value")
