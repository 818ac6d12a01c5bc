"""Weather landing documents: ``{_meta, data: {daily|hourly: {time: [...], x: [...]}}}``.

Two layouts are read alike: one pretty-printed file per city and run
(``{resolution}/{city}/{run_date}.json``), and JSON lines with many documents
per file, which is what Spark itself writes.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType, TimestampType

from millrace import schemas
from millrace.sources.files import FileStore, empty_frame

RESOLUTIONS = ("daily", "hourly")
_FIELDS = {"daily": schemas.DAILY_FIELDS, "hourly": schemas.HOURLY_FIELDS}
_PATH = r"/(daily|hourly)/([^/]+)/(\d{4}-\d{2}-\d{2})\.json"


def document_schema(resolution: str) -> StructType:
    bronze = schemas.BRONZE_WEATHER_DAILY if resolution == "daily" else schemas.BRONZE_WEATHER_HOURLY
    arrays = [StructField(name, ArrayType(bronze[column].dataType)) for name, column in _FIELDS[resolution].items()]
    block = StructField(resolution, StructType([StructField("time", ArrayType(StringType())), *arrays]))
    return StructType([StructField("_meta", schemas.LANDING_META), StructField("data", StructType([block])), block])


def _configured(reader, resolution: str, multi_line: bool):
    return (
        reader.schema(document_schema(resolution))
        .option("multiLine", multi_line)
        .option("recursiveFileLookup", True)
        .option("ignoreMissingFiles", True)
    )


def _with_path(df: DataFrame) -> DataFrame:
    return df.select("*", F.col("_metadata.file_path").alias("file_path"))


def landing_globs(base: str, resolution: str, run_date: str, locations: Iterable[str] | None = None) -> str:
    cities = "*" if locations is None else "{" + ",".join(locations) + "}"
    return f"{base.rstrip('/')}/{resolution}/{cities}/{run_date}.json"


def read_documents(spark: SparkSession, path: str | list[str], resolution: str, *, multi_line: bool = True) -> DataFrame:
    """Documents below ``path`` (a glob may match nothing: then there are no rows)."""
    try:
        return _with_path(_configured(spark.read, resolution, multi_line).json(path))
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty_frame(spark, document_schema(resolution).add("file_path", StringType()))


def stream_documents(reader: DataStreamReader, path: str, resolution: str, *, multi_line: bool = True) -> DataFrame:
    return _with_path(_configured(reader, resolution, multi_line).json(path))


def _from_path(group: int) -> Column:
    found = F.regexp_extract("file_path", _PATH, group)
    return F.when(found != "", found)


def parse_documents(documents: DataFrame, resolution: str) -> DataFrame:
    """Documents to bronze rows: one row per entry of ``time``.

    Other arrays may be shorter, missing or not a list; those cells are NULL.
    Entries past the end of ``time`` are ignored, and of a time that a document
    repeats the first entry counts. The work is linear in the entries but for the sort.
    """
    block = F.when(F.col("data").isNotNull(), F.col(f"data.{resolution}")).otherwise(F.col(resolution))
    located = documents.select(
        F.coalesce(_from_path(2), F.col("_meta.location_key")).alias("location_key"),
        F.coalesce(_from_path(3), F.col("_meta.run_date")).cast("date").alias("run_date"),
        F.coalesce(F.col("_meta.extracted_at").cast("timestamp_ntz"), F.current_timestamp().cast("timestamp_ntz")).alias(
            "extracted_at"
        ),
        block.alias("block"),
    )
    # places of the entries in the order of their times; of equal times the first comes first
    placed = F.array_sort(F.transform("block.time", lambda t, i: F.struct(t.alias("time"), i.alias("i"))))
    ordered = located.withColumn("placed", placed)
    fields = _FIELDS[resolution]

    def entry(place: Column) -> Column:
        values = [F.get(F.col(f"block.{name}"), place["i"]).alias(column) for name, column in fields.items()]
        return F.struct(place["i"].alias("place"), place["time"].alias("time"), *values)

    def is_first(place: Column, i: Column) -> Column:
        # the entry first, then its time: the times of all entries would be gathered anew for each
        before = F.get(F.col("placed"), i - 1)["time"]
        return (i == 0) | place["time"].isNull() | before.isNull() | (before != place["time"])

    kept = ordered.withColumn("kept", F.filter("placed", is_first))
    # only the finished entries are multiplied into rows, not the document
    entries = kept.select("location_key", "run_date", "extracted_at", F.transform("kept", entry).alias("entries"))
    # outer, because of an inner one the optimizer infers a filter on the size of the list, for which it copies
    # the sort into the lambda; the row of a document without entries has no place
    rows = entries.select("location_key", "run_date", "extracted_at", F.inline_outer("entries")).where("place IS NOT NULL")
    daily = resolution == "daily"
    moment = ("obs_date", "date") if daily else ("hour_timestamp", "timestamp_ntz")
    source = F.concat(F.lit(f"weather/raw/{resolution}/"), "location_key", F.lit("/"), "run_date", F.lit(".json"))
    keys = ["location_key", "run_date", moment[0]]
    schema = schemas.BRONZE_WEATHER_DAILY if daily else schemas.BRONZE_WEATHER_HOURLY
    return (
        rows.select(
            "location_key",
            "run_date",
            F.col("time").cast(moment[1]).alias(moment[0]),
            "extracted_at",
            F.current_timestamp().alias("ingested_at"),
            *fields.values(),
            source.alias("source_file"),
        )
        .withColumn("bronze_id", F.xxhash64(*keys))
        .select(*schema.names)
    )


def to_documents(bronze: DataFrame, resolution: str, source: str = "open-meteo.com") -> DataFrame:
    """Bronze rows back to documents: one per location and run.

    A group holds at most one entry per day (or hour) of the run, because
    (location, run, time) is the key of bronze.
    """
    time = "obs_date" if resolution == "daily" else "hour_timestamp"
    pattern = "yyyy-MM-dd" if resolution == "daily" else "yyyy-MM-dd'T'HH:mm"
    fields = _FIELDS[resolution]
    entry = F.struct(
        F.date_format(time, pattern).alias("time"), *[F.col(column).alias(name) for name, column in fields.items()]
    )
    grouped = bronze.groupBy("location_key", "run_date").agg(
        F.sort_array(F.collect_list(entry)).alias("rows"), F.max("extracted_at").alias("extracted_at")
    )
    block = F.struct(*[F.col(f"rows.{name}").alias(name) for name in ("time", *fields)])
    stamp = F.concat(F.date_format("extracted_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))
    meta = F.struct(
        "location_key",
        stamp.alias("extracted_at"),
        F.col("run_date").cast("string").alias("run_date"),
        F.lit(source).alias("source"),
    )
    return grouped.select(meta.alias("_meta"), F.struct(block.alias(resolution)).alias("data"))


def write_documents(documents: DataFrame, path: str) -> None:
    """JSON lines, appended; AQE sizes the files."""
    documents.hint("rebalance").write.mode("append").json(path)


def write_landing(documents: DataFrame, base: str, resolution: str) -> int:
    """One object per document, ``{resolution}/{location_key}/{run_date}.json``; returns how many.

    The documents are written aside first, each into a folder of its own, where Spark's
    committer sees to it that a repeated task leaves one file. The files then get their names,
    each by one rename that also replaces an older object of the name.
    """
    spark, base = documents.sparkSession, base.rstrip("/")
    store, aside = FileStore(spark), f"{base}/_staged-{uuid.uuid4().hex}"
    keys = ["location_key", "run_date"]
    named = documents.select(*[F.col(f"_meta.{k}").alias(k) for k in keys], F.to_json(F.struct("_meta", "data")).alias("value"))
    repeated = named.groupBy(*keys).count().where("count > 1 OR location_key IS NULL OR run_date IS NULL").limit(1).collect()
    if repeated:
        raise ValueError(f"an object needs a name of its own: {repeated[0].asDict()}")
    named.repartition(*keys).write.partitionBy(*keys).text(aside)
    written = spark.read.schema("value string, location_key string, run_date string").text(aside)
    places = written.select(F.col("_metadata.file_path").alias("path"), *keys).distinct()
    count = 0
    for place in places.toLocalIterator():  # names only
        store.rename(place["path"], f"{base}/{resolution}/{place['location_key']}/{place['run_date']}.json", overwrite=True)
        count += 1
    store.delete(aside)
    return count


def missing_files(dim_location: DataFrame, found: DataFrame, first: str, last: str) -> DataFrame:
    """Expected (location, resolution, run_date) without a file.

    The expected set is unrolled from the location dimension, so no cross join
    is planned; ``found`` is only probed.
    """
    days = F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))
    resolutions = F.array(*[F.lit(r) for r in RESOLUTIONS])
    expected = dim_location.select("location_key", F.explode(resolutions).alias("resolution")).select(
        "*", F.explode(days).alias("run_date")
    )
    keys = ["location_key", "resolution", "run_date"]
    missing = expected.join(found.select(*keys), keys, "left_anti")
    name = F.concat(F.lit("weather/raw/"), "resolution", F.lit("/"), "location_key", F.lit("/"), "run_date", F.lit(".json"))
    return missing.withColumn("object_key", name)


def found_files(spark: SparkSession, base: str, run_date: str = "*") -> DataFrame:
    """(location_key, resolution, run_date, size_bytes, modified) of the landing files of a run, listed without reading them."""
    try:
        files = spark.read.format("binaryFile").load(f"{base.rstrip('/')}/{{{','.join(RESOLUTIONS)}}}/*/{run_date}.json")
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        files = empty_frame(spark, StructType().add("path", StringType()).add("length", LongType()).add("modificationTime", TimestampType()))
    return files.select(
        F.regexp_extract("path", _PATH, 2).alias("location_key"),
        F.regexp_extract("path", _PATH, 1).alias("resolution"),
        F.nullif(F.regexp_extract("path", _PATH, 3), F.lit("")).cast("date").alias("run_date"),
        F.col("length").alias("size_bytes"),
        F.col("modificationTime").alias("modified"),
    ).where("run_date IS NOT NULL")


def source_versions(spark: SparkSession, base: str, run_date: str = "*") -> dict[str, str]:
    """For each run (a row each, so the calendar bounds them) a text that changes whenever its files do; nothing is read."""
    found = found_files(spark, base, run_date)
    mark = F.bit_xor(F.xxhash64("location_key", "resolution", "size_bytes", "modified"))
    per_run = found.groupBy(F.col("run_date").cast("string").alias("run")).agg(F.count("*").alias("files"), mark.alias("mark"))
    return {r["run"]: f"{r['files']}:{r['mark']}" for r in per_run.collect()}


ENTRIES_PER_PART = 1000


def manifest(entries: DataFrame, total_locations: int, entries_per_part: int = ENTRIES_PER_PART) -> DataFrame:
    """One summary document per run with its list of locations.

    ``entries``: location_key, run_date, object_key, size_bytes, days_returned.
    The list is in numbered parts (``part`` of ``parts``) at every size, so no single
    row (and no single task) has to hold the whole list; a short one has one part.
    """
    per_run = entries.groupBy("run_date").agg(F.count("*").alias("n"))
    sized = entries.join(per_run, "run_date")
    parts = F.ceil(F.col("n") / F.lit(entries_per_part)).cast("int")
    entry = F.struct(*[F.col(c) for c in ("location_key", "run_date", "object_key", "size_bytes", "days_returned")])
    return (
        sized.withColumn("parts", parts)
        .withColumn("part", F.pmod(F.xxhash64("location_key"), F.col("parts")).cast("int") + 1)
        .groupBy("run_date", "n", "parts", "part")
        .agg(F.sort_array(F.collect_list(entry)).alias("locations"))
        .select(
            "run_date",
            F.current_timestamp().alias("created_at"),
            F.lit(total_locations).cast("bigint").alias("total_locations"),
            (F.col("n") * len(RESOLUTIONS)).alias("files_ingested"),
            "part",
            "parts",
            "locations",
            F.lit("completed").alias("status"),
        )
    )
