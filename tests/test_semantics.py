"""Rules R1-R18 on hand-written frames (cases the test tables cannot produce)."""

import datetime
import math

from pyspark.sql import functions as F

from demandcast.functions import columns as FN
from demandcast.operators import clean as C
from demandcast.operators import panel as P
from demandcast.operators import temporal as T
from demandcast.spec import TARGET

SCHEMA = "date_block_num int, campaign_id int, product_id int, item_cnt_month bigint"


def cells(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


GOLDEN = [(1, 1, 1, 5), (2, 1, 1, 6), (4, 1, 1, 7), (1, 2, 1, 0), (4, 2, 1, 3)]


def test_golden_frame_lags_trailing_sum_last_sale(spark):
    # FIXTURES.md section 5: month lags with gaps, zero-filled trailing sum, last sale
    df = cells(spark, GOLDEN)
    w = T.month_window(["campaign_id", "product_id"]).rangeBetween(-6, -1)
    out = {(r[0], r[1]): r for r in df.select(
        "date_block_num", "campaign_id", T.month_lag(TARGET, 1).alias("l1"), T.month_lag(TARGET, 2).alias("l2"),
        F.coalesce(F.sum(TARGET).over(w), F.lit(0)).alias("s6"), T.last_sale().alias("ls")).collect()}
    assert tuple(out[(1, 1)][2:]) == (None, None, 0, None)
    assert tuple(out[(2, 1)][2:]) == (5, None, 5, 1)
    assert tuple(out[(4, 1)][2:]) == (None, 6, 11, 2)
    assert tuple(out[(1, 2)][2:]) == (None, None, 0, None)
    assert tuple(out[(4, 2)][2:]) == (None, None, 0, None)   # zero count is not a sale (R11)


def test_month_index_and_calendar(spark):
    df = spark.createDataFrame([(datetime.date(2021, 1, 15),), (datetime.date(2021, 12, 1),),
                                (datetime.date(2022, 1, 1),)], "date date")
    r = df.select(FN.month_index("date", 2021).alias("m")).select(
        "m", FN.calendar_month("m").alias("month"), FN.calendar_year("m").alias("year")).collect()
    assert [tuple(x) for x in r] == [(1, 1, 0), (12, 0, 1), (13, 1, 1)]   # R1, R17 (December -> 0, next year)


def test_month_range_filter_equals_month_index(spark):
    dates = [datetime.date(2021, 1, 1) + datetime.timedelta(days=d) for d in range(0, 800, 7)]
    df = spark.createDataFrame([(d,) for d in dates], "date date").withColumn("m", FN.month_index("date", 2021))
    a = df.filter(FN.month_range("date", 2021, 5, 17)).count()
    b = df.filter(F.col("m").between(5, 17)).count()
    assert a == b > 0


def _price_panel(spark):
    # two campaigns of product 1 in month 1 and 2; month-item prices 10 and 20 (R3 row shift)
    lines = spark.createDataFrame([
        (1, 1, 1, 10.0, 1), (1, 2, 1, 10.0, 1), (2, 1, 1, 20.0, 1), (2, 3, 1, 20.0, 1), (3, 1, 1, 30.0, 1)],
        "date_block_num int, campaign_id int, product_id int, price double, orders int")
    lines = lines.withColumn("price", F.col("price").cast("decimal(12,2)")).withColumn(
        "purchase_price", F.lit(0).cast("decimal(18,4)"))
    return P.build_cells(lines)


def test_price_row_lag_crosses_campaigns_in_same_month(spark):
    c = _price_panel(spark)
    pm = T.product_month_prices(c, 6)
    j = P.join_back(c, pm, ["product_id", "date_block_num"]).withColumn("__j", T.within_cell_index())
    got = {(r[0], r[1]): (r[2], r[3], r[4]) for r in j.select(
        "date_block_num", "campaign_id", T.price_row_lag(1, 6).alias("l1"), T.price_row_lag(2, 6).alias("l2"),
        T.price_row_lag(3, 6).alias("l3")).collect()}
    # row order in product 1: (1,1) (1,2) (2,1) (2,3) (3,1)
    assert got[(1, 1)] == (None, None, None)
    assert got[(1, 2)] == (10.0, None, None)
    assert got[(2, 1)] == (10.0, 10.0, None)
    assert got[(2, 3)] == (20.0, 10.0, 10.0)
    assert got[(3, 1)] == (20.0, 20.0, 10.0)


def test_pair_grain_target_encoding(spark):
    # Month mean of month 1 reaches month-2 rows only where the pair existed in month 1
    df = cells(spark, [(1, 1, 1, 4), (1, 2, 1, 8), (2, 1, 1, 1), (2, 3, 1, 1)])
    out = {(r[0], r[1]): r[2] for r in T.target_encoding(df, [], TARGET, "te", [1])
           .select("date_block_num", "campaign_id", "te_lag_1").collect()}
    assert out[(2, 1)] == 6.0 and out[(2, 3)] is None


def test_trailing_stats_zero_fill_and_normaliser(spark):
    # Divisor is always p, missing months are 0; normalised mean over group rows is 1
    df = cells(spark, [(1, 1, 1, 3), (2, 1, 1, 6), (5, 1, 1, 9)])
    g = T.group_trailing_stats(df, ["product_id"], TARGET, "p", (2,)).orderBy("date_block_num").collect()
    raw = [0.0, 1.5, 0.0]           # (0+0)/2, (3+0)/2, (month 4 and 3 missing)/2
    mean = sum(raw) / 3
    assert [r["p_avg_sale_last_2"] for r in g] == [x / mean for x in raw]
    assert abs(sum(r["p_avg_sale_last_2"] for r in g) / 3 - 1) < 1e-12


def test_null_group_key_dropped(spark):
    # Null category gets no group statistics and is not part of the normaliser
    df = spark.createDataFrame([(1, 1, 1, 2, 7), (2, 1, 1, 3, 7), (2, 1, 2, 5, None)],
                               SCHEMA + ", categories_id int")
    out = T.add_group_stats(df, ["categories_id"], TARGET, "c", (1,))
    nulls = out.filter(F.col("categories_id").isNull()).select("c_avg_sale_last_1").first()[0]
    assert nulls is None


def test_zero_divisor_gives_null(spark):
    # ANSI mode raises on x/0; ratios go through try_divide
    r = spark.range(1).select(FN.relative_change(F.lit(3.0), F.lit(0.0)).alias("x")).first()[0]
    assert r is None


def test_label_encode_sorted_null_last(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("c",), ("a",)], "name string")
    out = C.label_encode(df.withColumn("k", F.col("name")), ["name"]).collect()
    assert {(r["k"], r["name"]) for r in out} == {("a", 0), ("b", 1), ("c", 2), (None, 3)}   # R16
    assert len(out) == 5


def test_mean_impute_and_all_missing_column(spark):
    df = spark.createDataFrame([(1, 1, 1, 1, 2.0, None), (2, 1, 1, 1, None, None), (3, 1, 1, 1, 4.0, None)],
                               SCHEMA + ", x double, y double")
    out = C.mean_impute(C.inf_to_null(df)).orderBy("date_block_num").collect()
    assert [r["x"] for r in out] == [2.0, 3.0, 4.0]
    assert all(r["y"] is None for r in out)        # all-missing column stays missing


def test_inf_to_null(spark):
    df = spark.createDataFrame([(float("inf"),), (float("-inf"),), (float("nan"),), (1.0,)], "x double")
    assert [r[0] for r in C.inf_to_null(df).collect()] == [None, None, None, 1.0]


def test_duplicate_item_id_rejected(spark):
    from demandcast.sources.readers import assert_unique
    items = spark.createDataFrame([(1, "a"), (1, "b")], "id int, name string")
    try:
        assert_unique(items, "id")
    except ValueError:
        return
    raise AssertionError("duplicate id accepted")


def test_salary_tiers_boundaries(spark):
    df = spark.createDataFrame([(99, 100.0), (100, 100.0), (199, 100.0), (200, 100.0), (499, 100.0), (500, 100.0)],
                               "item_cnt_month int, profit_month double")
    df = df.withColumn("profit_month", F.col("profit_month").cast("decimal(18,4)"))
    got = [float(r[0]) for r in df.select(FN.salary_share()).collect()]
    assert got == [50.0, 52.0, 52.0, 55.0, 55.0, 60.0]


def test_seasonal_decomposition_matches_hand_computation(spark):
    from demandcast.operators.seasonal import decompose
    vals = [10, 12, 14, 11, 13, 15, 12, 14, 16, 13, 15, 17, 14, 16]
    df = spark.createDataFrame([(i + 1, v) for i, v in enumerate(vals)], "date_block_num int, v bigint")
    out = decompose(df, "v", (), 3).orderBy("date_block_num").collect()
    trend = [None] + [sum(vals[i - 1:i + 2]) / 3 for i in range(1, len(vals) - 1)] + [None]
    assert [r["trend"] for r in out] == trend
    det = [v / t if t else None for v, t in zip(vals, trend)]
    pm = [sum(d for d in det[p::3] if d) / len([d for d in det[p::3] if d]) for p in range(3)]
    si = [x / (sum(pm) / 3) for x in pm]
    for i, r in enumerate(out):
        assert math.isclose(r["seasonal"], si[i % 3], rel_tol=1e-8)


def test_seasonal_guards_keep_rows(spark):
    from demandcast.operators.seasonal import decompose
    df = spark.createDataFrame([(i + 1, 5) for i in range(5)], "date_block_num int, v bigint")
    out = decompose(df, "v", (), 7).collect()
    assert len(out) == 5 and all(r["trend"] is None and r["seasonal"] is None for r in out)


def test_blend_alpha_and_ols(spark):
    rows = [(float(y), float(y) + 1.0, float(y) * 0.5 + (y % 3)) for y in range(1, 40)]
    df = spark.createDataFrame(rows, "y double, a double, b double")
    best = R_blend(df)
    assert best[0] == 0.0 or best[1] <= 1.0
    from demandcast.operators.report import ols_two
    o = ols_two(df, "y", "a", "b").first()
    # y = a - 1 exactly: intercept -1, coef_1 1, coef_2 0
    assert abs(o["intercept"] + 1) < 1e-6 and abs(o["coef_1"] - 1) < 1e-6 and abs(o["coef_2"]) < 1e-6


def R_blend(df):
    from demandcast.operators.report import blend_alpha
    r = blend_alpha(df, "y", "a", "b").first()
    # brute force over the same grid
    ys = df.collect()
    best = None
    for i in range(50):
        a = i * 0.02
        e = math.sqrt(sum((y - (a * p + (1 - a) * q)) ** 2 for y, p, q in ys) / len(ys))
        if best is None or e < best[1] - 1e-12:
            best = (a, e)
    assert math.isclose(r["alpha"], best[0]) and math.isclose(r["rmse"], best[1], rel_tol=1e-9)
    return r["alpha"], r["rmse"]


def test_mean_impute_fit_on_training_months_only(spark):
    # D5 leak-free variant: the fill value comes from the fit frame only
    df = spark.createDataFrame([(1, 1, 1, 1, 2.0), (2, 1, 1, 1, None), (3, 1, 1, 1, 100.0)],
                               SCHEMA + ", x double")
    fit = df.filter(F.col("date_block_num") < 3)
    out = C.mean_impute(df, ["x"], fit=fit).orderBy("date_block_num").collect()
    assert [r["x"] for r in out] == [2.0, 2.0, 100.0]


LINES = "date_block_num int, campaign_id int, product_id int, price decimal(12,2), purchase_price decimal(18,4), orders int"


def _lines(spark, rows):
    from decimal import Decimal
    return spark.createDataFrame([(m, c, p, None if x is None else Decimal(x), Decimal(0), o)
                                  for m, c, p, x, o in rows], LINES)


NULL_ROWS = [(1, 1, 1, 10, 2), (1, 1, 1, None, 3), (1, 2, 1, 30, 1), (1, None, 1, 50, 9), (2, 1, None, 70, 4),
             (2, 1, 1, None, 1), (2, None, None, 5, 5), (3, None, 1, 90, 1)]


def test_null_keys_are_no_panel_rows_but_their_prices_count(spark):
    lines = _lines(spark, NULL_ROWS)
    panel = {(r[0], r[1], r[2]): r for r in P.build_cells(lines).collect()}
    assert set(panel) == {(1, 1, 1), (1, 2, 1), (2, 1, 1)}                            # R8
    cells = P.build_cells(lines, null_keys=True)
    for of in (lines, cells):                                                        # both paths, one result
        means = {(r[0], r[1]): r[2] for r in P.month_item_mean_price(of).collect()}
        assert means == {(1, 1): 30.0, (2, 1): None, (3, 1): 90.0}                   # a null price is no price
        assert [tuple(r) for r in P.item_mean_price(of).collect()] == [(1, 45.0)]
        revenue = {(r[0], r[1]): float(r[2]) for r in P.campaign_month_revenue(of).collect()}
        assert revenue == {(1, 1): 10.0, (1, 2): 30.0, (2, 1): 70.0}                 # an all-missing sum is 0 (R9)
    assert P.panel_rows(cells).count() == 3


def test_feature_matrix_with_null_keys_equals_the_chain(spark):
    from demandcast.plans.features import feature_matrix, feature_matrix_chain
    from demandcast.plans.registry import rounded
    rows = NULL_ROWS + [(m, c, p, 10 * m + c + p, m + c) for m in range(1, 9) for c in (1, 2, 3) for p in (1, 2, 3)
                        if (m + c * p) % 4]
    items = spark.createDataFrame([(1, "a", "s", 7, "x"), (2, "b", None, None, None)],
                                  "id int, name string, short_description string, categories_id int, categories_name string")
    fused = rounded(feature_matrix(_lines(spark, rows), items))
    chain = rounded(feature_matrix_chain(_lines(spark, rows), items))
    assert sorted(map(repr, fused.collect())) == sorted(map(repr, chain.collect()))
    assert fused.filter("campaign_id is null or product_id is null").count() == 0


def test_empty_parts_count_as_zero(spark):
    net = spark.createDataFrame([(10.0, 3.0)], "profit_month double, salary_month_sum double")
    costs = spark.createDataFrame([], "item string, cost bigint")
    orders = spark.createDataFrame([(None,)], "total_orders bigint")
    assert P.pnl_total(net, costs, orders).first()[0] == 7.0


def test_duplicate_items_do_not_fan_out(spark):
    items = spark.createDataFrame([(1, "a"), (1, "b")], "id int, name string")
    try:
        P.join_items(cells(spark, GOLDEN), items)
    except ValueError:
        return
    raise AssertionError("duplicate id accepted")


def test_broadcast_limit_is_read_with_its_unit(spark):
    agg = spark.range(1).selectExpr("id", "id as x")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for text, rows in (("1MB", 1 << 15), ("1024", 32), ("-1", 0), ("50m", 50 << 15)):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", text)
            assert P.broadcast_budget_rows(agg) == rows, text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_blends_are_applied(spark):
    from demandcast.operators import report as R
    df = spark.createDataFrame([(float(y), y + 1.0, y * 0.5) for y in range(1, 40)], "y double, a double, b double")
    w = spark.createDataFrame([(0.25, 1.0)], "alpha double, rmse double")
    assert all(math.isclose(r[R.FORECAST], 0.25 * r["a"] + 0.75 * r["b"]) for r in R.apply_blend(df, w, "a", "b").collect())
    o = R.apply_ols(df, R.ols_two(df.withColumn("b", F.col("b") + F.col("y") % 3), "y", "a", "b"), "a", "b").collect()
    assert all(math.isfinite(r[R.FORECAST]) for r in o)
