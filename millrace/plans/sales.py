"""Sales warehouse: staged orders and products, the summary and the fact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from millrace.functions.numbers import decimal_average, decimal_ratio, round_half_away, settled_mean, settled_sum

COMPLETED = 5
NOT_AVAILABLE = "N/A"
MONEY = ("double", "decimal")


def _decimal(value: Column, precision: int) -> Column:
    return value.cast(DecimalType(precision, 2))


def stg_sales_orders(
    header: DataFrame, detail: DataFrame, territory: DataFrame, *, exclude_online: bool = False, money: str = "double"
) -> DataFrame:
    """Lines of completed orders with their territory.

    The warehouse flavour keeps online orders and doubles; the database flavour
    drops online orders and stores two decimals. The status filter and the
    column lists reach the file scans. Headers and lines both grow with the
    business; how they meet is left to measured sizes: a sort-merge join, which spills,
    or AQE's hash join where each partition of a side is small. AQE splits an order
    that holds very many lines.
    """
    if money not in MONEY:
        raise ValueError(f"money must be one of {MONEY}")
    completed = header.where(F.col("Status") == COMPLETED)
    if exclude_online:
        completed = completed.where(~F.col("OnlineOrderFlag"))
    if money == "double":
        qty, price, total = "int", "double", "double"
    else:
        qty, price, total = "smallint", DecimalType(10, 2), DecimalType(12, 2)
    names = territory.select("TerritoryID", F.col("Name").alias("TerritoryName"), "CountryRegionCode")
    return (
        completed.join(names, "TerritoryID")
        .join(detail, "SalesOrderID")
        .select(
            "SalesOrderID",
            "SalesOrderDetailID",
            F.col("OrderDate").cast("date").alias("OrderDate"),
            "ProductID",
            F.col("OrderQty").cast(qty).alias("OrderQty"),
            F.col("UnitPrice").cast(price).alias("UnitPrice"),
            F.col("LineTotal").cast(total).alias("LineTotal"),
            "TerritoryID",
            "TerritoryName",
            "CountryRegionCode",
        )
    )


def stg_products(
    product: DataFrame, subcategory: DataFrame, category: DataFrame, *, money: str = "double"
) -> DataFrame:
    """Sellable products with category names, 'N/A' where a level is missing."""
    price = "double" if money == "double" else DecimalType(10, 2)
    levels = subcategory.select("ProductSubcategoryID", F.col("Name").alias("sub_name"), "ProductCategoryID").join(
        category.select("ProductCategoryID", F.col("Name").alias("cat_name")), "ProductCategoryID", "left"
    )
    return (
        product.where(F.col("ListPrice") > 0)
        .join(levels, "ProductSubcategoryID", "left")
        .select(
            "ProductID",
            F.col("Name").alias("ProductName"),
            "ProductNumber",
            F.col("ListPrice").cast(price).alias("ListPrice"),
            F.col("StandardCost").cast(price).alias("StandardCost"),
            F.coalesce("cat_name", F.lit(NOT_AVAILABLE)).alias("Category"),
            F.coalesce("sub_name", F.lit(NOT_AVAILABLE)).alias("Subcategory"),
        )
    )


def sales_summary(
    orders: DataFrame, products: DataFrame, *, money: str = "double", extra: Sequence[Column] = ()
) -> DataFrame:
    """Revenue, quantity, price and margin per product and territory.

    Lines are summed per (product, territory) before the product attributes are
    joined, so neither the wide attributes nor single lines are shuffled to the
    product join. ``ProductID`` is the key of products. ``extra`` holds named aggregates
    of the order lines that are wanted as further columns.
    """
    keys = ["ProductID", "TerritoryID", "TerritoryName", "CountryRegionCode"]
    if money == "double":
        revenue = round_half_away(settled_sum(F.col("LineTotal")), 2)
        price = round_half_away(settled_mean(F.col("UnitPrice")), 2)
    else:
        revenue = _decimal(F.sum("LineTotal"), 15)
        price = decimal_average(F.sum("UnitPrice"), F.count("UnitPrice"), DecimalType(10, 2))
    sums = orders.groupBy(*keys).agg(
        revenue.alias("TotalRevenue"), F.sum("OrderQty").alias("TotalQty"), price.alias("AvgUnitPrice"), *extra
    )
    added = sums.columns[len(keys) + 3 :]
    return sums.join(_with_margin(products, money), "ProductID").select(
        "ProductID",
        "ProductName",
        "ProductNumber",
        "Category",
        "Subcategory",
        "TerritoryID",
        "TerritoryName",
        "CountryRegionCode",
        "TotalRevenue",
        "TotalQty",
        "AvgUnitPrice",
        "ListPrice",
        "StandardCost",
        "Margin",
        "MarginPct",
        *added,
    )


def _with_margin(products: DataFrame, money: str) -> DataFrame:
    """Margin and its percentage: a matter of the product alone, so it is not worked out per territory."""
    spread = F.col("ListPrice") - F.col("StandardCost")
    if money == "double":
        margin = round_half_away(spread, 2)
        margin_pct = round_half_away(F.try_divide(spread, F.col("ListPrice")) * F.lit(100.0), 2)
    else:
        margin = _decimal(spread, 10)
        margin_pct = decimal_ratio(spread * 100, F.col("ListPrice"), 2, DecimalType(6, 2))
    return products.withColumns({"Margin": margin, "MarginPct": margin_pct})


def fact_sales_performance(summary: DataFrame, batch_date: str, load_time: Column | None = None) -> DataFrame:
    """The summary with its audit columns."""
    stamp = F.current_timestamp().cast("timestamp_ntz") if load_time is None else load_time
    return summary.withColumns({"LoadTimestamp": stamp, "BatchDate": F.lit(batch_date).cast("date")})


def build_fact(sources: dict[str, DataFrame], batch_date: str, *, money: str = "double", exclude_online: bool = False) -> DataFrame:
    """From the six source tables to the fact."""
    orders = stg_sales_orders(
        sources["sales_order_header"],
        sources["sales_order_detail"],
        sources["sales_territory"],
        exclude_online=exclude_online,
        money=money,
    )
    products = stg_products(
        sources["product"], sources["product_subcategory"], sources["product_category"], money=money
    )
    return fact_sales_performance(sales_summary(orders, products, money=money), batch_date)
