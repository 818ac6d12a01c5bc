"""Landing to bronze and bronze to silver as Structured Streaming jobs.

Both run with ``availableNow``: they take what has arrived, record it in the
checkpoint folder and stop. The checkpoint must lie on shared storage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from millrace import schemas
from millrace.plans.weather import silver_daily, silver_hourly, store_bronze, store_silver
from millrace.sources.landing import parse_documents, stream_documents

MAX_FILES_PER_BATCH = 100_000


def landing_to_bronze(
    spark: SparkSession,
    landing: str,
    bronze: str,
    checkpoint: str,
    resolution: str = "daily",
    *,
    multi_line: bool = True,
    max_files: int = MAX_FILES_PER_BATCH,
) -> StreamingQuery:
    """Parse new landing files and append the keys bronze does not hold.

    A batch that is repeated after a failure finds its keys present and appends nothing.
    """
    reader = spark.readStream.option("maxFilesPerTrigger", max_files)
    rows = parse_documents(stream_documents(reader, landing, resolution, multi_line=multi_line), resolution)
    table = f"bronze_weather_{resolution}"

    def append(batch: DataFrame, _batch_id: int) -> None:
        store_bronze(batch, bronze, table)

    return (
        rows.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def bronze_to_silver(
    spark: SparkSession,
    bronze: str,
    silver: str,
    checkpoint: str,
    resolution: str = "daily",
    *,
    max_files: int = MAX_FILES_PER_BATCH,
) -> StreamingQuery:
    """Clean new bronze files and append the keys silver does not hold.

    Row-wise, so no state is kept between batches. The table is the one that batch runs
    write; a replayed batch or a lost checkpoint finds its keys present and appends nothing.
    """
    if resolution == "daily":
        schema, clean = schemas.BRONZE_WEATHER_DAILY, silver_daily
    else:
        schema, clean = schemas.BRONZE_WEATHER_HOURLY, silver_hourly
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(bronze)
    table = f"silver_weather_{resolution}"

    def append(batch: DataFrame, _batch_id: int) -> None:
        store_silver(batch, silver, table)

    return (
        clean(rows)
        .writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
