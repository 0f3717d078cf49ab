"""Readers for the pipeline's inputs (order lines, items, marketing, cost tables).

Explicit schemas (no ``inferSchema``: that is an extra full pass over the
data).  CSV and Parquet are both accepted; Parquet gets filter and column
pushdown from Catalyst.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandcast.functions.columns import month_index

ORDERS_SCHEMA = T.StructType([
    T.StructField("date", T.StringType()),
    T.StructField("product_id", T.IntegerType()),
    T.StructField("campaign_id", T.IntegerType()),
    T.StructField("price", T.DecimalType(18, 4)),
    T.StructField("purchase_price", T.DecimalType(18, 4)),
    T.StructField("orders", T.IntegerType()),
])

ITEMS_SCHEMA = T.StructType([
    T.StructField("id", T.IntegerType()),
    T.StructField("name", T.StringType()),
    T.StructField("short_description", T.StringType()),
    T.StructField("categories_id", T.IntegerType()),
    T.StructField("categories_name", T.StringType()),
])

MARKETING_SCHEMA = T.StructType([
    T.StructField("ID", T.IntegerType()),
    T.StructField("Marketing_Cost_Day", T.DoubleType()),
])


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None,
               fmt: str = "csv", header: bool = True) -> DataFrame:
    """Generic reader: CSV with header and a declared schema, or Parquet."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        return reader.option("header", header).option("mode", "FAILFAST").csv(path)
    return reader.format(fmt).load(path)


def with_month_index(orders: DataFrame, base_year: int, date_col: str = "date") -> DataFrame:
    """Parse ``date`` to DATE and add the 1-based month number."""
    d = F.to_date(F.col(date_col))
    return orders.withColumns({date_col: d, "date_block_num": month_index(d, base_year)})


def read_orders(spark: SparkSession, path: str, base_year: int = 2021, fmt: str = "csv",
                schema: T.StructType = ORDERS_SCHEMA) -> DataFrame:
    """Order lines ``(date, product_id, campaign_id, price, purchase_price, orders)`` + month index."""
    return with_month_index(read_table(spark, path, schema if fmt == "csv" else None, fmt), base_year)


def read_items(spark: SparkSession, path: str, fmt: str = "csv",
               schema: T.StructType = ITEMS_SCHEMA) -> DataFrame:
    return read_table(spark, path, schema if fmt == "csv" else None, fmt)


def read_marketing(spark: SparkSession, path: str, fmt: str = "csv",
                   schema: T.StructType = MARKETING_SCHEMA) -> DataFrame:
    return read_table(spark, path, schema if fmt == "csv" else None, fmt)


def assert_unique(df: DataFrame, *key: str) -> DataFrame:
    """Fail early when ``key`` repeats (a repeated item id would fan matrix rows out).

    Runs one distributed aggregation; only the first offending key reaches the driver.
    """
    dup = df.groupBy(*key).count().filter(F.col("count") > 1).limit(1).collect()
    if dup:
        raise ValueError(f"key {key} is not unique, e.g. {dup[0].asDict()}")
    return df
