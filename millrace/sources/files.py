"""Parquet landing zone: one folder per table, one partition per load date."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.sources.jdbc import TableSpec


class FileStore:
    """The few file operations that commits need, on whatever file system a path is."""

    def __init__(self, spark: SparkSession):
        self._gateway, self._jvm, self._conf = spark.sparkContext._gateway, spark._jvm, spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        place = self._jvm.org.apache.hadoop.fs.Path(path)
        return place, place.getFileSystem(self._conf)

    def names(self, folder: str) -> list[str]:
        place, system = self._at(folder)
        return sorted(s.getPath().getName() for s in system.listStatus(place)) if system.exists(place) else []

    def read(self, path: str) -> str:
        place, system = self._at(path)
        stream = system.open(place)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        place, system = self._at(path)
        stream = system.create(place, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def rename(self, source: str, target: str, *, overwrite: bool = False) -> bool:
        """Rename in one step; false where the target is there and may not be replaced."""
        place, system = self._at(target)
        system.mkdirs(place.getParent())
        option = getattr(self._jvm, "org.apache.hadoop.fs.Options$Rename")
        how = self._gateway.new_array(option, 1)
        how[0] = option.valueOf("OVERWRITE" if overwrite else "NONE")
        files = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), self._conf)
        try:
            files.rename(self._jvm.org.apache.hadoop.fs.Path(source), place, how)
        except Py4JJavaError as err:
            if "FileAlreadyExists" in str(err.java_exception):
                return False
            raise
        return True

    def delete(self, path: str) -> None:
        place, system = self._at(path)
        system.delete(place, True)


def raw_path(base: str, folder: str) -> str:
    return f"{base.rstrip('/')}/raw/{folder}"


def _overwrite(df: DataFrame, path: str, columns: Iterable[str]) -> None:
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy(*columns)
        .parquet(path)
    )


def replace_partition(df: DataFrame, path: str, column: str, value: str) -> None:
    """Replace one date partition by the rows of df that belong to it, even if there are none.

    The new files are moved in when the job commits. A dynamic overwrite leaves a
    partition alone when no row falls into it; an observed count of zero
    therefore empties the partition explicitly. No second pass is needed.
    """
    seen = Observation()
    rows = df.where(F.col(column) == F.lit(value).cast("date"))
    _overwrite(rows.observe(seen, F.count(F.lit(1)).alias("rows")), path, [column])
    if not seen.get.get("rows"):
        empty_frame(df.sparkSession, df.drop(column).schema).write.mode("overwrite").parquet(f"{path}/{column}={value}")


def write_partition(df: DataFrame, path: str, dt: str) -> None:
    """Store df as the ``dt`` partition, replacing that partition only; every scan task writes its own file."""
    replace_partition(df.withColumn("dt", F.lit(dt).cast("date")), path, "dt", dt)


def replace_partitions(df: DataFrame, path: str, *columns: str) -> None:
    """Dynamic overwrite: the partitions present in df are replaced, others stay.

    The rebalance hint lets AQE cut a large partition into several files and
    join small ones, instead of sending a whole partition to one task.
    """
    _overwrite(df.hint("rebalance", *columns), path, columns)


def read_partition(spark: SparkSession, path: str, dt: str) -> DataFrame:
    """One load date; the filter prunes folders before any file is opened."""
    return spark.read.parquet(path).where(F.col("dt") == F.lit(dt).cast("date"))


def empty_frame(spark: SparkSession, schema: StructType) -> DataFrame:
    """No rows, as a plan the optimizer folds away (an empty Python list would start Python workers)."""
    return spark.range(1).select(F.from_json(F.lit("{}"), schema).alias("row")).select("row.*").limit(0)


def read_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The dataset at ``path``, or an empty frame where nothing was written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty_frame(spark, schema)


def register_bronze_views(spark: SparkSession, base: str, folders: Iterable[str], dt: str) -> list[str]:
    """A view per folder over the files of one load date; nothing is copied."""
    names = []
    for folder in folders:
        name = f"bronze_{folder}"
        read_partition(spark, raw_path(base, folder), dt).drop("dt").createOrReplaceTempView(name)
        names.append(name)
    return names


def row_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """(table, row_count) in one query."""
    counts = [df.agg(F.count("*").alias("row_count")).select(F.lit(t).alias("table"), "row_count") for t, df in frames.items()]
    return reduce(DataFrame.unionByName, counts)


def ingest_tables(read: Callable[[TableSpec], DataFrame], specs: Iterable[TableSpec], base: str, dt: str) -> dict[str, str]:
    """Copy every listed table into the landing zone; returns the folder of each.

    The tables do not depend on each other, so their jobs are submitted together.
    """
    specs = list(specs)

    def copy(spec: TableSpec) -> str:
        path = raw_path(base, spec.folder)
        write_partition(read(spec), path, dt)
        return path

    with ThreadPoolExecutor(max_workers=len(specs)) as pool:
        return dict(zip((s.folder for s in specs), pool.map(copy, specs)))


def validation_summary(spark: SparkSession, paths: dict[str, str], dt: str) -> DataFrame:
    """(table, status, row_count, column_count, detail); a missing or damaged table is a FAILED row with the reason.

    Every table is counted here and now, all at the same time, because a damaged file shows only
    when it is opened. All columns are read, not just the files' footers.
    """

    def count(table: str) -> tuple:
        try:
            df = read_partition(spark, paths[table], dt).drop("dt")
            whole = F.count(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
            return table, "OK", df.agg(whole).first()[0], len(df.columns), None
        except (PySparkException, Py4JJavaError) as err:
            return table, "FAILED", None, None, str(err).splitlines()[0][:500]

    with ThreadPoolExecutor(max_workers=max(len(paths), 1)) as pool:
        rows = list(pool.map(count, paths))  # one per table
    return spark.createDataFrame(rows, "table string, status string, row_count long, column_count int, detail string")


def require_valid(summary: DataFrame) -> None:
    """Raise one error that names every table that could not be read (one row per table comes to the driver)."""
    failed = [f"{r['table']}: {r['detail']}" for r in summary.where("status <> 'OK'").select("table", "detail").collect()]
    if failed:
        raise ValueError(f"unreadable tables: {sorted(failed)}")
