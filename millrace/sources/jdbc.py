"""Table scans over JDBC, split into ranges so that executors read in parallel."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType


@dataclass(frozen=True)
class TableSpec:
    schema: str
    table: str
    folder: str
    split_column: str | None = None

    @property
    def qualified(self) -> str:
        return f'"{self.schema}"."{self.table}"'


# The six source tables and their landing folders.
SALES_TABLES = (
    TableSpec("Sales", "SalesOrderHeader", "sales_order_header", "SalesOrderID"),
    TableSpec("Sales", "SalesOrderDetail", "sales_order_detail", "SalesOrderID"),
    TableSpec("Sales", "SalesTerritory", "sales_territory"),
    TableSpec("Production", "Product", "product", "ProductID"),
    TableSpec("Production", "ProductSubcategory", "product_subcategory"),
    TableSpec("Production", "ProductCategory", "product_category"),
)


def jdbc_options(url: str, spec: TableSpec, *, fetch_size: int = 10_000, **connection: str) -> dict[str, str]:
    return {"url": url, "dbtable": spec.qualified, "fetchsize": str(fetch_size), **connection}


def split_options(spec: TableSpec, low: int | None, high: int | None, rows_per_split: int = 1_000_000) -> dict[str, str]:
    """Range-split options; none for an empty table or one without a split column."""
    if spec.split_column is None or low is None or high is None:
        return {}
    return {
        "partitionColumn": f'"{spec.split_column}"',
        "lowerBound": str(low),
        "upperBound": str(high + 1),
        "numPartitions": str(max(1, -(-(high - low + 1) // rows_per_split))),
    }


def drop_time_zone(df: DataFrame) -> DataFrame:
    """Zoned timestamps become plain ones."""
    zoned = [f.name for f in df.schema.fields if isinstance(f.dataType, TimestampType)]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in zoned})


def read_table(spark: SparkSession, url: str, spec: TableSpec, **connection: str) -> DataFrame:
    """Whole table; one small query finds the range of the split column first."""
    options = jdbc_options(url, spec, **connection)
    low = high = None
    if spec.split_column:
        column = f'"{spec.split_column}"'
        probe = f"SELECT min({column}) AS low, max({column}) AS high FROM {spec.qualified}"
        bounds = {k: v for k, v in options.items() if k != "dbtable"}
        low, high = spark.read.format("jdbc").options(**bounds).option("query", probe).load().first()
    return drop_time_zone(spark.read.format("jdbc").options(**options, **split_options(spec, low, high)).load())
