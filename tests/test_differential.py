"""Window forms vs the literal forms of the original (self-joins, per-month loops), and
the fused feature plan vs the operator-by-operator chain."""

import random

from pyspark.sql import functions as F

from demandcast.operators import temporal as T
from demandcast.plans.features import feature_matrix, feature_matrix_chain
from demandcast.plans.registry import rounded
from demandcast.sources import testdata as TD
from demandcast.spec import FIXTURE, KEY, TARGET

from conftest import SF_SMALL


def random_panel(spark, seed, n_pairs=30, months=30):
    rng = random.Random(seed)
    rows = []
    for c in range(4):
        for p in range(n_pairs // 4 + 1):
            for m in range(1, months + 1):
                if rng.random() < 0.55:
                    rows.append((m, c, p, rng.randint(0, 12)))
    return spark.createDataFrame(rows, "date_block_num int, campaign_id int, product_id int, item_cnt_month bigint")


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_lag_window_equals_self_join(spark):
    for seed in (1, 2):
        df = random_panel(spark, seed)
        w = T.lag_feature(df, [1, 2, 3, 6, 12], TARGET)
        j = T.union_lag_feature(df, [1, 2, 3, 6, 12], TARGET).select(*w.columns)
        assert same(w, j)


def test_last_sale_window_equals_month_loop(spark):
    df = random_panel(spark, 3, months=14)
    w = df.withColumn("item_campaign_last_sale", T.last_sale())
    loop = T.last_sale_loop(df, range(1, 15), ["product_id", "campaign_id"], "item_campaign_last_sale")
    assert same(w.select(*KEY, "item_campaign_last_sale"), loop.select(*KEY, "item_campaign_last_sale"))


def test_trailing_window_equals_range_join(spark):
    df = random_panel(spark, 4)
    g = df.groupBy("date_block_num", "product_id").agg(F.sum(TARGET).alias("x"))
    w = T.month_window(["product_id"]).rangeBetween(-6, -1)
    a = g.select("date_block_num", "product_id", F.coalesce(F.sum("x").over(w), F.lit(0)).alias("s"))
    h = g.select(F.col("date_block_num").alias("hm"), F.col("product_id").alias("hp"), F.col("x").alias("hx"))
    b = (g.join(h, (h.hp == g.product_id) & (h.hm >= g.date_block_num - 6) & (h.hm <= g.date_block_num - 1), "left")
          .groupBy("date_block_num", "product_id").agg(F.coalesce(F.sum("hx"), F.lit(0)).alias("s")))
    assert same(a, b)


def test_fused_feature_plan_equals_operator_chain(spark):
    lines, items = TD.inputs(spark, SF_SMALL)
    a = rounded(feature_matrix(lines, items, FIXTURE))
    b = rounded(feature_matrix_chain(lines, items, FIXTURE))
    assert a.columns == b.columns
    ra = sorted(map(repr, (tuple(r) for r in a.collect())))
    rb = sorted(map(repr, (tuple(r) for r in b.collect())))
    assert ra == rb
