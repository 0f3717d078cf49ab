"""CSV sources in the original file layout give the same panel as the Parquet fixture path."""

import tempfile

from pyspark.sql import functions as F

from demandcast.operators import panel as P
from demandcast.sources import readers as RD
from demandcast.sources import testdata as TD

from conftest import SF_SMALL


def test_csv_orders_and_items_roundtrip(spark):
    root = tempfile.mkdtemp(prefix="csv-src-")
    lines = TD.fact(spark, SF_SMALL)
    (lines.select(F.date_format("date", "yyyy-MM-dd").alias("date"), "product_id", "campaign_id", "price",
                  "purchase_price", "orders")
          .coalesce(2).write.option("header", True).csv(f"{root}/order1"))
    TD.items(spark, SF_SMALL).coalesce(1).write.option("header", True).csv(f"{root}/item1")
    orders = RD.read_orders(spark, f"{root}/order1", base_year=1995)
    items = RD.assert_unique(RD.read_items(spark, f"{root}/item1"), "id")
    a = P.build_matrix(orders, items).withColumn("profit_month", F.col("profit_month").cast("double"))
    b = P.build_matrix(lines, TD.items(spark, SF_SMALL)).withColumn("profit_month", F.col("profit_month").cast("double"))
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
