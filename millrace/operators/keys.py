"""One row per key, duplicate detection, surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import stored


def surrogate_key(*natural_key: str) -> Column:
    """A 64-bit id computed from the natural key; needs no global numbering."""
    return F.xxhash64(*natural_key)


def numbered(df: DataFrame, order: Sequence[str], number: str, folder: str, after: int = 0) -> DataFrame:
    """Add a gapless number, `after` + 1 and up, in the order of the (unique) `order` columns.

    The rows are stored in sorted parts, each row with its part and place. The sizes of the parts, a
    few numbers, give where each part begins; no task sees more than its part.
    """
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id()
    placed = placed.select("*", F.shiftright(place, 33).alias("_part"), place.bitwiseAND(F.lit((1 << 33) - 1)).alias("_place"))
    placed = stored(placed, f"{folder}/placed")
    sizes = placed.groupBy("_part").agg(F.count("*").alias("n")).orderBy("_part").collect()
    begins, total = [], after
    for part in sizes:
        begins.append((part["_part"], total))
        total += part["n"]
    begin = F.broadcast(df.sparkSession.createDataFrame(begins, "_part long, _begin long"))  # a row per part
    return placed.join(begin, "_part").withColumn(number, F.col("_begin") + F.col("_place") + 1).drop("_part", "_place", "_begin")


def _one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], pick) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    ordered = [*order, *[c for c in rest if c not in order]]
    if not ordered:
        return df.select(*keys).distinct()
    kept = df.groupBy(*keys).agg(pick(F.struct(*ordered)).alias("kept"))
    return kept.select(*[F.col(c) if c in keys else F.col(f"kept.{c}").alias(c) for c in df.columns])


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the largest ``order`` columns for each key; the other columns break ties.

    An aggregate rather than a ranking window: each task keeps one row per key
    before the shuffle, so a key that holds most of the rows costs no more.
    """
    return _one_per_key(df, keys, order, F.max)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return _one_per_key(df, keys, order, F.min)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).where(F.col("copies") > 1)
