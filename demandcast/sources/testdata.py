"""Mapping of the TPC-H-like test tables onto the pipeline's inputs (see FIXTURES.md).

* fact (order lines): lineitem x part x supplier; product = ``p_size``,
  campaign = supplier nation, month 1 = January 1995.
* items: one row per product (two product ids left out so the left join has
  unmatched rows).
* marketing: campaign cost per day from supplier balances.
* costs: one expense line per nation.

The dimension joins carry no broadcast hint: Spark/AQE broadcast them only
when their measured size is under ``autoBroadcastJoinThreshold`` and fall back
to a shuffle join (with skew splitting) otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandcast.functions.columns import month_index, month_range

FIXTURE_BASE_YEAR = 1995
# Fixed values of the fixture: product ids left out of the item table.
ITEMS_LEFT_OUT = (17, 34)


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fact(spark: SparkSession, sf_dir: str, base_year: int = FIXTURE_BASE_YEAR,
         months: tuple[int, int] | None = None) -> DataFrame:
    """Order lines; ``months=(lo, hi)`` keeps months lo..hi with a filter pushed into the scan."""
    li = _read(spark, sf_dir, "lineitem")
    if months is not None:
        li = li.filter(month_range("l_shipdate", base_year, *months))
    part = _read(spark, sf_dir, "part").select("p_partkey", "p_size")
    sup = _read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    purchase = (price * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)")
                         + F.col("l_tax").cast("decimal(4,2)"))).cast("decimal(18,4)")
    return (li.join(part, li.l_partkey == part.p_partkey)
              .join(sup, li.l_suppkey == sup.s_suppkey)
              .select(F.to_date("l_shipdate").alias("date"),
                      month_index(F.col("l_shipdate"), base_year).alias("date_block_num"),
                      F.col("s_nationkey").alias("campaign_id"),
                      F.col("p_size").alias("product_id"),
                      price.alias("price"),
                      purchase.alias("purchase_price"),
                      F.col("l_quantity").cast("int").alias("orders")))


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _read(spark, sf_dir, "part").select("p_partkey", "p_size", "p_name", "p_type", "p_brand")
    brand = F.min_by("p_brand", "p_partkey")
    g = (part.groupBy("p_size")
             .agg(F.min_by("p_name", "p_partkey").alias("name"),
                  F.min_by("p_type", "p_partkey").alias("short_description"),
                  brand.alias("categories_name")))
    return (g.filter(~F.col("p_size").isin(*ITEMS_LEFT_OUT))
             .select(F.col("p_size").alias("id"), "name", "short_description",
                     F.regexp_extract("categories_name", "[0-9]+", 0).cast("int").alias("categories_id"),
                     "categories_name"))


def marketing(spark: SparkSession, sf_dir: str) -> DataFrame:
    sup = _read(spark, sf_dir, "supplier").select("s_nationkey", "s_acctbal")
    return (sup.groupBy("s_nationkey")
               .agg((F.sum(F.col("s_acctbal").cast("decimal(12,2)")).cast("double") / 10)
                    .alias("Marketing_Cost_Day"))
               .select(F.col("s_nationkey").alias("ID"), "Marketing_Cost_Day"))


def costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = _read(spark, sf_dir, "nation")
    return nation.select(F.col("n_name").alias("item"),
                         (F.lit(1000) * (F.col("n_nationkey") + 1)).cast("bigint").alias("cost"))


def inputs(spark: SparkSession, sf_dir: str):
    """``(fact, items)`` — the two tables the feature chain reads."""
    return fact(spark, sf_dir), items(spark, sf_dir)
