"""Changes to Parquet tables: ignore-insert, upsert, incremental selection.

Keys match null-safe: a row whose key holds NULL is found again like any other, so
repeating a load adds nothing. Loads that must not hold such rows filter them first
(`split_complete`).
"""

from __future__ import annotations

import logging
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.operators.keys import first_per_key, latest_per_key
from millrace.session import scratch, stored
from millrace.sources.files import read_or_empty, replace_partition, replace_partitions

log = logging.getLogger(__name__)

BUCKETS = 1 << 16  # of keys, counted to find those that hold many rows
HOT = 1 << 20  # rows of a bucket that are not sent to one task


def _is_touched(batch: DataFrame, partitions: Sequence[str]) -> Column:
    """Filter for the partitions a stored batch writes to, with their values as literals.

    Literals prune folders when the target is planned; a join with the batch would read them
    all. The values are days or months, so the calendar bounds their number. Taken per
    column they may select a few more partitions than needed, which changes nothing.
    """
    values = batch.select(*partitions).distinct().collect()
    parts = []
    for name in partitions:
        seen = {row[name] for row in values}
        known = sorted(v for v in seen if v is not None)
        found = F.col(name).isin(known) if known else F.lit(False)
        parts.append(found | F.col(name).isNull() if None in seen else found)
    return reduce(Column.__and__, parts)


def _touched(target: DataFrame, batch: DataFrame, partitions: Sequence[str]) -> DataFrame:
    return target.where(_is_touched(batch, partitions)) if partitions else target


def split_complete(rows: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with a whole key, and those where a part of it is NULL."""
    whole = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
    return rows.where(whole), rows.where(~whole)


def unprocessed(source: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key is not in ``done`` yet; NULL equals NULL."""
    seen = done.select(*[F.col(k).alias(f"done_{k}") for k in keys])
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"done_{k}")) for k in keys])
    return source.join(seen, same, "left_anti")


def split_repeated(rows: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(admitted, repeated) of rows with whole keys, as `judged` says, by aggregates alone.

    No task gets all rows of a key, but all rows are shuffled again and again: for keys that hold many.
    """
    admitted = first_per_key(rows, keys, order)
    copies = rows.groupBy(*keys).agg(F.count("*").alias("copies")).where("copies > 1").select(*keys)
    repeated = rows.join(copies, list(keys), "left_semi").exceptAll(admitted.join(copies, list(keys), "left_semi"))
    return admitted, repeated.select(*rows.columns)


def judged(rows: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """The rows with a `_reason` to set them aside, NULL if admitted: they must have a whole key that no other row has.

    Of rows with one key the first by `order` and then by the other columns is admitted, as often as
    it is there once. One shuffle brings the rows of a key together; those of keys in buckets of more
    than HOT rows go through aggregates. `rows` are read several times and should be stored.
    """
    whole, broken = split_complete(rows, keys)
    bucket = F.pmod(F.xxhash64(*keys), F.lit(BUCKETS))
    large = whole.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n")).where(F.col("n") > HOT)
    hot = [row["bucket"] for row in large.collect()]  # at most a row per HOT rows
    ordered = [*order, *[c for c in rows.columns if c not in keys and c not in order]] or keys
    turn = F.row_number().over(Window.partitionBy(*keys).orderBy(*ordered))
    few = whole.where(~bucket.isin(hot)) if hot else whole
    parts = [few.withColumn("_reason", F.when(turn > 1, F.lit("key repeated"))), broken.withColumn("_reason", F.lit("key not whole"))]
    if hot:
        admitted, repeated = split_repeated(whole.where(bucket.isin(hot)), keys, order)
        parts += [admitted.withColumn("_reason", F.lit(None).cast("string")), repeated.withColumn("_reason", F.lit("key repeated"))]
    return reduce(DataFrame.unionByName, parts)


def publish_partition(rows: DataFrame, path: str, keys: Sequence[str], column: str, value: str, order: Sequence[str] = ()) -> int:
    """Replace one date partition, audited before it shows; returns how many rows were set aside.

    The rows are staged, checked for NULL and repeated keys, and only the sound ones published. The
    rest replaces the same partition of `<path>_rejected`, with the reason. The partition column
    must be part of the key or be fixed by it, so that no other partition can hold the key.
    """
    with scratch(rows.sparkSession, "publish") as folder:
        staged = stored(rows.where(F.col(column) == F.lit(value).cast("date")), f"{folder}/staged")
        found = stored(judged(staged, keys, order), f"{folder}/judged")
        admitted = found.where(F.col("_reason").isNull()).drop("_reason")
        aside = found.where(F.col("_reason").isNotNull()).withColumn("reason", F.col("_reason")).drop("_reason")
        count = aside.count()
        rejected = f"{path}_rejected"
        if count or not read_or_empty(rows.sparkSession, rejected, aside.schema).isEmpty():
            log.warning("%d rows of %s were set aside: see %s", count, path, rejected)
            replace_partition(aside, rejected, column, value)
        replace_partition(admitted, path, column, value)
    return count


def append_new(
    batch: DataFrame,
    path: str,
    keys: Sequence[str],
    partitions: Sequence[str] = (),
    order: Sequence[str] = (),
) -> None:
    """Append the rows whose key the table does not hold; one row per key survives.

    Repeating the call with the same batch changes nothing. ``partitions`` must
    be part of the key: a key then lives in one partition only, and only the batch's
    partitions are read. The reduced batch is stored first, because it is used
    twice (which partitions, which rows).
    """
    spark = batch.sparkSession
    with scratch(spark, "append") as folder:
        rows = stored(first_per_key(batch, keys, order), f"{folder}/batch")
        target = _touched(read_or_empty(spark, path, batch.schema), rows, partitions)
        fresh = unprocessed(rows, target, keys)
        fresh.hint("rebalance", *partitions).write.mode("append").partitionBy(*partitions).parquet(path)


def upsert(
    batch: DataFrame,
    path: str,
    keys: Sequence[str],
    version: Sequence[str],
    partitions: Sequence[str],
) -> None:
    """Insert or replace by key; the highest version wins, the batch wins a tie.

    ``partitions`` must follow from the key and must be given: only theirs are read
    and rewritten, and Spark swaps the new files in when the job commits, so the old ones
    stay whole until then. (A table without partitions could only be deleted before
    its new copy is in place.) The batch is stored because it is used twice (which
    partitions, which rows). Running the same batch again gives the same table.
    """
    if not partitions:
        raise ValueError("an upsert needs partition columns: a whole table cannot be swapped in one commit")
    spark: SparkSession = batch.sparkSession
    with scratch(spark, "upsert") as folder:
        rows = stored(batch, f"{folder}/batch")
        old = _touched(read_or_empty(spark, path, batch.schema), rows, partitions)
        both = old.withColumn("from_batch", F.lit(False)).unionByName(rows.withColumn("from_batch", F.lit(True)))
        newest = latest_per_key(both, keys, [*version, "from_batch"]).drop("from_batch")
        replace_partitions(newest, path, *partitions)
