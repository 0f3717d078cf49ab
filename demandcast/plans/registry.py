"""

Every query reads the test tables through the fixture mapping
(``sources.testdata``) and runs over the whole tables.
"""

from __future__ import annotations

import dataclasses
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandcast.operators import panel as P
from demandcast.operators import temporal as T
from demandcast.plans import oracle as O
from demandcast.plans.features import feature_matrix
from demandcast.sources import testdata as TD
from demandcast.spec import FIXTURE, KEY, MONTH, TARGET

QUERIES: dict = {}
SQL: dict = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def _money(df: DataFrame, *cols: str) -> DataFrame:
    """DECIMAL money columns -> DOUBLE at the output boundary."""
    return df.withColumns({c: F.col(c).cast("double") for c in cols})


def matrix(spark: SparkSession, sf: str, keep_sums: bool = False) -> DataFrame:
    lines, items = TD.inputs(spark, sf)
    return P.build_matrix(lines, items, keep_sums=keep_sums)


BASE = O.with_ctes(*O.BASE)

# --- 2.1 sources ------------------------------------------------------------

register("scan_orders", O.with_ctes(O.FACT) + "SELECT * FROM fact")(
    lambda spark, sf: TD.fact(spark, sf))
register("scan_items", O.with_ctes(O.ITEMS) + "SELECT * FROM items")(
    lambda spark, sf: TD.items(spark, sf))
register("scan_marketing", O.with_ctes(O.MARKETING) + "SELECT * FROM marketing")(
    lambda spark, sf: TD.marketing(spark, sf))
register("scan_costs", O.with_ctes(O.COSTS) + "SELECT * FROM costs")(
    lambda spark, sf: TD.costs(spark, sf))

# --- 2.4 / 2.5 core ---------------------------------------------------------

register("build_matrix", BASE + "SELECT * REPLACE (CAST(profit_month AS DOUBLE) AS profit_month) FROM matrix")(
    lambda spark, sf: _money(matrix(spark, sf), "profit_month"))

register("lag_feature", BASE + """SELECT m.date_block_num, m.campaign_id, m.product_id, m.item_cnt_month,
  l1.item_cnt_month AS item_cnt_month_lag_1, l2.item_cnt_month AS item_cnt_month_lag_2,
  l3.item_cnt_month AS item_cnt_month_lag_3, l6.item_cnt_month AS item_cnt_month_lag_6,
  l12.item_cnt_month AS item_cnt_month_lag_12
FROM cells m
LEFT JOIN cells l1 ON l1.campaign_id = m.campaign_id AND l1.product_id = m.product_id AND l1.date_block_num = m.date_block_num - 1
LEFT JOIN cells l2 ON l2.campaign_id = m.campaign_id AND l2.product_id = m.product_id AND l2.date_block_num = m.date_block_num - 2
LEFT JOIN cells l3 ON l3.campaign_id = m.campaign_id AND l3.product_id = m.product_id AND l3.date_block_num = m.date_block_num - 3
LEFT JOIN cells l6 ON l6.campaign_id = m.campaign_id AND l6.product_id = m.product_id AND l6.date_block_num = m.date_block_num - 6
LEFT JOIN cells l12 ON l12.campaign_id = m.campaign_id AND l12.product_id = m.product_id AND l12.date_block_num = m.date_block_num - 12""")(
    lambda spark, sf: T.lag_feature(P.build_cells(TD.fact(spark, sf)), FIXTURE.count_lags, TARGET)
                       .select(*KEY, TARGET, *[f"{TARGET}_lag_{i}" for i in FIXTURE.count_lags]))


STAT_COLS = [f"{prefix}_{kind}_sale_last_{p}" for _, prefix, periods in FIXTURE.group_stats
             for p in periods for kind in ("avg", "std")]


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Normalised deviations at ``digits`` places: their normaliser is a float mean, whose last bits depend on the
    order of summation.  Only results are rounded, never what an operator hands on."""
    return df.withColumns({c: F.round(c, digits) for c in STAT_COLS if "_std_" in c and c in df.columns})


@register("feature_matrix", O.features_sql(FIXTURE))
def q_feature_matrix(spark, sf):
    lines, items = TD.inputs(spark, sf)
    return rounded(feature_matrix(lines, items, FIXTURE))


# ---------------------------------------------------------------------------
# shared pieces
# ---------------------------------------------------------------------------

from demandcast.operators import clean as C  # noqa: E402
from demandcast.operators import profile as PR  # noqa: E402
from demandcast.operators import report as R  # noqa: E402
from demandcast.operators import seasonal as S  # noqa: E402
from demandcast.functions import columns as FN  # noqa: E402
from demandcast.sources import sinks as SK  # noqa: E402

SPEC = FIXTURE
VM, TM = SPEC.valid_month, SPEC.test_month
FEATS = O.feature_ctes(SPEC)


def fsql(tail: str, *extra: str) -> str:
    """Oracle SQL over the literal feature chain."""
    return O.with_ctes(*FEATS, *extra) + tail


def features(spark, sf):
    return q_feature_matrix(spark, sf)


def _cells(spark, sf):
    return P.build_cells(TD.fact(spark, sf))


def cells_once(spark, sf, null_keys: bool = False):
    """The cells, written once for a query that reads them several times (one scan of the lines)."""
    return P.materialize(P.build_cells(TD.fact(spark, sf), null_keys), "parquet")


def panel_once(spark, sf):
    """The panel with its items' category, written once."""
    items = TD.items(spark, sf).select("id", "categories_id")
    return P.materialize(P.join_items(P.build_cells(TD.fact(spark, sf)), items).select(*KEY, TARGET, "categories_id"),
                         "parquet")


def report_rows(spark, sf) -> DataFrame:
    """Test-month rows with the lag-1 forecast.  Only months test-1..test reach the scan."""
    cells = P.build_cells(TD.fact(spark, sf, months=(TM - 1, TM)))
    f = T.lag_feature(cells, [1], TARGET)
    return (f.filter(F.col(MONTH) == TM)
             .select(*KEY, TARGET, "profit_month", R.lag1_forecast(f).alias(R.FORECAST)))


REPORT_ROWS = f"""rows AS (
  SELECT m.date_block_num, m.campaign_id, m.product_id, m.item_cnt_month, m.profit_month,
         CAST(COALESCE(l.item_cnt_month, 0) AS DOUBLE) AS item_cnt_month_forecast
  FROM cells m LEFT JOIN cells l ON l.campaign_id = m.campaign_id AND l.product_id = m.product_id
       AND l.date_block_num = m.date_block_num - 1
  WHERE m.date_block_num = {TM})"""
SALARY_SQL = """CASE WHEN item_cnt_month < 100 THEN profit_month * 0.50
     WHEN item_cnt_month < 200 THEN profit_month * 0.52
     WHEN item_cnt_month < 500 THEN profit_month * 0.55
     ELSE profit_month * 0.60 END"""
SAL_ROWS = f"""srows AS (SELECT *, {SALARY_SQL} AS salary FROM rows)"""
ROLLUP = """rollup AS (SELECT campaign_id, SUM(profit_month) AS profit_month_sum, SUM(salary) AS salary_month_sum
  FROM srows GROUP BY campaign_id)"""
NET = """net AS (SELECT k.Marketing_Cost_Day, r.campaign_id, r.salary_month_sum,
         CAST(r.profit_month_sum AS DOUBLE) - 29 * k.Marketing_Cost_Day AS profit_month
  FROM marketing k LEFT JOIN rollup r ON k.ID = r.campaign_id)"""
RSQL = lambda tail, *extra: O.with_ctes(O.FACT, O.CELLS, REPORT_ROWS, *extra) + tail
JITTER_SQL = ("item_cnt_month + CAST(('0x' || substr(md5(concat_ws('|', CAST(date_block_num AS VARCHAR), "
              "CAST(campaign_id AS VARCHAR), CAST(product_id AS VARCHAR))), 1, 8))::UBIGINT % 36 AS BIGINT) - 15")
FOLD_SQL = ("CAST(('0x' || substr(md5(concat_ws('|', CAST(date_block_num AS VARCHAR), "
            "CAST(campaign_id AS VARCHAR), CAST(product_id AS VARCHAR))), 1, 8))::UBIGINT % 5 AS INT)")


def salary_rows(spark, sf):
    return R.with_salary(report_rows(spark, sf))


def campaign_rollup_df(spark, sf):
    return P.campaign_rollup(salary_rows(spark, sf))


def net_profit_df(spark, sf):
    return P.campaign_net_profit(TD.marketing(spark, sf), campaign_rollup_df(spark, sf), days=29)


def _out_money(df):
    return _money(df, *[c for c in ("profit_month_sum", "salary_month_sum", "salary", "profit_month")
                        if c in df.columns and str(df.schema[c].dataType).startswith("Decimal")])


# --- 2.1 sinks -------------------------------------------------------------------

@register("write_forecast_csv", RSQL(
    """SELECT CAST(ROW_NUMBER() OVER (ORDER BY campaign_id, product_id) - 1 AS BIGINT) AS ID,
       item_cnt_month_forecast AS item_cnt_month FROM rows"""))
def q_write_forecast_csv(spark, sf):
    rows = report_rows(spark, sf)
    return SK.write_forecast_csv(rows, SK.scratch_dir(rows, "forecast-csv"), ["campaign_id", "product_id"],
                                 R.FORECAST)


@register("checkpoint_matrix", fsql("SELECT *, CAST(date_block_num % 12 AS INT) AS month, "
                                    "CAST(trunc(date_block_num / 12) AS INT) AS year FROM features"))
def q_checkpoint_matrix(spark, sf):
    """The whole feature table with its calendar columns, saved by month and read back."""
    lines, items = TD.inputs(spark, sf)
    m = feature_matrix(lines, items, dataclasses.replace(SPEC, calendar=True))
    return rounded(SK.checkpoint_table(m, SK.scratch_dir(m, "features"), [MONTH]))


@register("reload_predictions", O.with_ctes(*O.BASE) + f"""SELECT m.date_block_num, m.campaign_id, m.product_id,
  CAST(COALESCE(l.item_cnt_month, 0) AS DOUBLE) AS lag_1,
  CAST(COALESCE((SELECT SUM(h.item_cnt_month) FROM cells h WHERE h.campaign_id = m.campaign_id
       AND h.product_id = m.product_id AND h.date_block_num BETWEEN m.date_block_num - 6 AND m.date_block_num - 1), 0)
       AS DOUBLE) / 6 AS mean_6
FROM cells m LEFT JOIN cells l ON l.campaign_id = m.campaign_id AND l.product_id = m.product_id
     AND l.date_block_num = m.date_block_num - 1
WHERE m.date_block_num IN ({VM}, {TM})""")
def q_reload_predictions(spark, sf):
    cells = T.lag_feature(P.build_cells(TD.fact(spark, sf, months=(VM - 6, TM))), [1], TARGET)
    base = cells.select(*KEY, TARGET, R.lag1_forecast(cells).alias("lag_1"),
                        R.trailing_mean_forecast(cells, 6).alias("mean_6"))
    base = base.filter(F.col(MONTH).isin(VM, TM))
    a = SK.save_predictions(base.select(*KEY, "lag_1"), SK.scratch_dir(base, "pred-lag1"))
    b = SK.save_predictions(base.select(*KEY, "mean_6"), SK.scratch_dir(base, "pred-mean6"))
    return a.join(b, list(KEY), "inner")


@register("export_filtered_csv", O.with_ctes(O.FACT, O.CELLS, REPORT_ROWS, SAL_ROWS, ROLLUP, O.MARKETING, NET)
          + "SELECT Marketing_Cost_Day, campaign_id, CAST(salary_month_sum AS DOUBLE) AS salary_month_sum, "
            "profit_month FROM net WHERE profit_month < 0")
def q_export_filtered_csv(spark, sf):
    neg = _out_money(R.negative_profit(net_profit_df(spark, sf)))
    return SK.export_csv(neg, SK.scratch_dir(neg, "marketing-fail"))


# --- 2.2 projections and filters ----------------------------------------------------

register("month_index", O.with_ctes(O.FACT) + "SELECT date, date_block_num FROM fact")(
    lambda spark, sf: TD.fact(spark, sf).select("date", MONTH))

register("unit_margin", O.with_ctes(O.FACT) +
         "SELECT date, date_block_num, campaign_id, product_id, CAST(price - purchase_price AS DOUBLE) AS revenue FROM fact")(
    lambda spark, sf: TD.fact(spark, sf).select("date", *KEY, FN.unit_margin().cast("double").alias("revenue")))

register("line_profit", O.with_ctes(O.FACT) +
         "SELECT date, date_block_num, campaign_id, product_id, orders, "
         "CAST((price - purchase_price) * orders AS DOUBLE) AS profit FROM fact")(
    lambda spark, sf: P.with_margins(TD.fact(spark, sf)).select(
        "date", *KEY, "orders", F.col("profit").cast("double").alias("profit")))

register("calendar_features", BASE +
         "SELECT date_block_num, campaign_id, product_id, CAST(date_block_num % 12 AS INT) AS month, "
         "CAST(trunc(date_block_num / 12) AS INT) AS year FROM cells")(
    lambda spark, sf: P.build_cells(TD.fact(spark, sf)).select(
        *KEY, FN.calendar_month().alias("month"), FN.calendar_year().alias("year")))

register("cast_keys", BASE + "SELECT CAST(date_block_num AS INT) AS date_block_num, CAST(campaign_id AS INT) AS campaign_id,"
         " CAST(product_id AS INT) AS product_id FROM cells")(
    lambda spark, sf: P.build_cells(TD.fact(spark, sf)).select(*[F.col(k).cast("int") for k in KEY]))

register("drop_columns", fsql("SELECT * EXCLUDE (" + ", ".join(SPEC.drop_before_clean) + ") FROM features"))(
    lambda spark, sf: features(spark, sf).drop(*SPEC.drop_before_clean))

register("project_rename", BASE + "SELECT date_block_num + 1 AS date_block_num, campaign_id, product_id, "
         "item_cnt_month AS item_cnt_month_lag_1 FROM cells")(
    lambda spark, sf: P.build_cells(TD.fact(spark, sf)).select(
        (F.col(MONTH) + 1).alias(MONTH), "campaign_id", "product_id", F.col(TARGET).alias(f"{TARGET}_lag_1")))

register("clip_counts", O.with_ctes(O.FACT) + "SELECT date_block_num, product_id, campaign_id, "
         "CAST(least(greatest(SUM(orders), 0), 20) AS BIGINT) AS orders FROM fact GROUP BY date_block_num, product_id, campaign_id")(
    lambda spark, sf: P.block_item_sales(TD.fact(spark, sf)).withColumn(
        "orders", FN.clip("orders", 0, 20).cast("bigint")))

register("split_by_month", BASE + f"""SELECT date_block_num, campaign_id, product_id, item_cnt_month,
  CASE WHEN date_block_num < {VM} THEN 'train' WHEN date_block_num = {VM} THEN 'valid' ELSE 'test' END AS split
FROM cells WHERE date_block_num <= {TM}""")(
    lambda spark, sf: P.build_cells(TD.fact(spark, sf)).select(*KEY, TARGET, C.split_label(SPEC).alias("split"))
                      .filter(F.col("split").isNotNull()))

register("filter_campaign", RSQL(f"SELECT date_block_num, campaign_id, product_id, item_cnt_month_forecast, "
                                 f"item_cnt_month, {JITTER_SQL} AS target FROM rows WHERE campaign_id = 1"))(
    lambda spark, sf: R.filter_campaign(R.forecast_vs_actual(report_rows(spark, sf)), 1))

VOLUME_SQL = """CASE WHEN order_ctn_month < 100 THEN 'lt_100' WHEN order_ctn_month < 500 THEN '100_to_500'
  ELSE 'ge_500' END"""
PRODUCT_ROLLUP = """prod AS (SELECT product_id, CAST(SUM(item_cnt_month) AS BIGINT) AS order_ctn_month FROM rows
  GROUP BY product_id)"""

register("volume_bands", RSQL(f"SELECT product_id, order_ctn_month, {VOLUME_SQL} AS volume_band FROM prod",
                              PRODUCT_ROLLUP))(
    lambda spark, sf: R.volume_bands(P.product_rollup(report_rows(spark, sf))))

register("negative_profit", O.with_ctes(O.FACT, O.CELLS, REPORT_ROWS, SAL_ROWS, ROLLUP, O.MARKETING, NET)
         + "SELECT Marketing_Cost_Day, campaign_id, CAST(salary_month_sum AS DOUBLE) AS salary_month_sum, "
           "profit_month FROM net WHERE profit_month < 0")(
    lambda spark, sf: _out_money(R.negative_profit(net_profit_df(spark, sf))))

register("salary_tiers", RSQL("SELECT date_block_num, campaign_id, product_id, item_cnt_month, "
                              "CAST(profit_month AS DOUBLE) AS profit_month, CAST(salary AS DOUBLE) AS salary FROM srows",
                              SAL_ROWS))(
    lambda spark, sf: _out_money(salary_rows(spark, sf).select(*KEY, TARGET, "profit_month", "salary")))

register("target_jitter", RSQL(f"SELECT date_block_num, campaign_id, product_id, item_cnt_month, "
                               f"{JITTER_SQL} AS target FROM rows"))(
    lambda spark, sf: report_rows(spark, sf).select(*KEY, TARGET, FN.target_jitter(list(KEY), TARGET).alias("target")))

# --- 2.3 joins -------------------------------------------------------------------------

register("join_items", BASE + "SELECT date_block_num, campaign_id, product_id, name, short_description, "
         "categories_id, categories_name FROM matrix")(
    lambda spark, sf: P.join_items(P.build_cells(TD.fact(spark, sf)), TD.items(spark, sf)).select(
        *KEY, "name", "short_description", "categories_id", "categories_name"))

register("join_group_features", fsql(
    "SELECT m.date_block_num, m.campaign_id, m.product_id, g.product_avg_sale_last_6, g.product_std_sale_last_6, "
    "g.product_avg_sale_last_12, g.product_std_sale_last_12 FROM matrix m LEFT JOIN gs_product g "
    "ON g.date_block_num = m.date_block_num AND g.product_id = m.product_id"))(
    lambda spark, sf: rounded(T.add_group_stats(cells_once(spark, sf), ["product_id"], TARGET, "product", (6, 12)))
                       .select(*KEY, "product_avg_sale_last_6", "product_std_sale_last_6",
                               "product_avg_sale_last_12", "product_std_sale_last_12"))

register("asof_last_sale", fsql("SELECT date_block_num, campaign_id, product_id, item_campaign_last_sale, "
                                "item_last_sale FROM rec"))(
    lambda spark, sf: T.add_sales_features(cells_once(spark, sf))
                       .select(*KEY, "item_campaign_last_sale", "item_last_sale"))

register("join_marketing", O.with_ctes(O.FACT, O.CELLS, REPORT_ROWS, SAL_ROWS, ROLLUP, O.MARKETING) +
         """SELECT k.Marketing_Cost_Day, r.campaign_id, CAST(r.profit_month_sum AS DOUBLE) AS profit_month_sum,
  CAST(r.salary_month_sum AS DOUBLE) AS salary_month_sum FROM marketing k LEFT JOIN rollup r ON k.ID = r.campaign_id""")(
    lambda spark, sf: _out_money(TD.marketing(spark, sf).join(
        campaign_rollup_df(spark, sf), F.col("ID") == F.col("campaign_id"), "left").drop("ID")))

@register("attach_forecast", RSQL("SELECT date_block_num, campaign_id, product_id, item_cnt_month, "
                                  "item_cnt_month_forecast FROM rows"))
def q_attach_forecast(spark, sf):
    """Saved predictions put back on the test rows by their key."""
    rows = P.materialize(report_rows(spark, sf), "parquet")
    saved = SK.save_predictions(rows.select(*KEY, F.col(R.FORECAST).alias("prediction")),
                                SK.scratch_dir(rows, "pred-attach"))
    return R.attach_forecast(rows.select(*KEY, TARGET), saved)


# --- 2.4 aggregations ---------------------------------------------------------------

register("orders_by_month", O.with_ctes(O.FACT) +
         "SELECT date_block_num, CAST(SUM(orders) AS BIGINT) AS orders FROM fact GROUP BY date_block_num")(
    lambda spark, sf: P.orders_by_month(TD.fact(spark, sf)))

register("block_item_sales", O.with_ctes(O.FACT) + "SELECT date_block_num, product_id, campaign_id, "
         "CAST(SUM(orders) AS BIGINT) AS orders FROM fact GROUP BY date_block_num, product_id, campaign_id")(
    lambda spark, sf: P.block_item_sales(TD.fact(spark, sf)))

register("sales_histogram", O.with_ctes(O.FACT) + """, v AS (
  SELECT CAST(least(greatest(SUM(orders), 0), 20) AS DOUBLE) AS v FROM fact GROUP BY date_block_num, product_id, campaign_id),
rng AS (SELECT CASE WHEN min(v) = max(v) THEN min(v) - 0.5 ELSE min(v) END AS mn,
               CASE WHEN min(v) = max(v) THEN max(v) + 0.5 ELSE max(v) END AS mx FROM v),
cnt AS (SELECT CAST(least(19, floor((v - mn) * 20 / (mx - mn))) AS INT) AS bin, COUNT(*) AS count FROM v, rng GROUP BY 1),
grid AS (SELECT CAST(range AS INT) AS bin FROM range(20))
SELECT g.bin, mn + (mx - mn) * g.bin / 20 AS bin_lo, mn + (mx - mn) * (g.bin + 1) / 20 AS bin_hi,
       COALESCE(c.count, 0) AS count
FROM grid g CROSS JOIN rng LEFT JOIN cnt c ON c.bin = g.bin""")(
    lambda spark, sf: P.sales_histogram(P.block_item_sales(TD.fact(spark, sf)), "orders", 20, 0, 20))

register("item_mean_price", O.with_ctes(O.FACT) + "SELECT product_id, CAST(SUM(price) AS DOUBLE) / COUNT(price) "
         "AS item_avg_item_price FROM fact GROUP BY product_id")(
    lambda spark, sf: P.item_mean_price(TD.fact(spark, sf)))

register("month_item_mean_price", O.with_ctes(O.FACT) + "SELECT date_block_num, product_id, CAST(SUM(price) AS DOUBLE)"
         " / COUNT(price) AS date_item_avg_item_price FROM fact GROUP BY date_block_num, product_id")(
    lambda spark, sf: P.month_item_mean_price(TD.fact(spark, sf)))

register("campaign_month_revenue", O.with_ctes(O.FACT) + "SELECT date_block_num, campaign_id, "
         "CAST(SUM(price - purchase_price) AS DOUBLE) AS date_campaign_revenue FROM fact GROUP BY date_block_num, campaign_id")(
    lambda spark, sf: _money(P.campaign_month_revenue(TD.fact(spark, sf)), "date_campaign_revenue"))

register("campaign_mean_revenue", O.with_ctes(O.FACT) + """, cr AS (SELECT date_block_num, campaign_id,
  SUM(price - purchase_price) AS rev FROM fact GROUP BY date_block_num, campaign_id)
SELECT campaign_id, CAST(SUM(rev) AS DOUBLE) / COUNT(*) AS campaign_avg_revenue FROM cr GROUP BY campaign_id""")(
    lambda spark, sf: P.campaign_mean_revenue(P.campaign_month_revenue(TD.fact(spark, sf))))

VC_COLS = ("date_block_num", "campaign_id", "product_id", "item_cnt_month", "profit_month", "name",
           "short_description", "categories_id", "categories_name")
register("value_counts", BASE + "SELECT column_name, value, COUNT(*) AS count FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST({f'CAST({c} AS DECIMAL(38, 4))' if c == 'profit_month' else c} AS VARCHAR) "
    f"AS value FROM matrix" for c in VC_COLS)
    + ") WHERE value IS NOT NULL GROUP BY column_name, value")(
    lambda spark, sf: PR.value_counts(matrix(spark, sf).withColumn(
        "profit_month", F.col("profit_month").cast("decimal(38,4)")), VC_COLS))


def _profile_sql():
    from demandcast.plans.features import feature_columns
    cols = feature_columns(SPEC)
    kinds = "CASE any_value(typeof({0})) WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string' " \
            "WHEN 'HUGEINT' THEN 'bigint' ELSE lower(any_value(typeof({0}))) END"
    parts = [f"SELECT '{c}' AS column_name, {i} AS ordinal, {kinds.format(c)} AS data_type, "
             f"COUNT({c}) AS non_null_count, COUNT(*) - COUNT({c}) AS null_count FROM features"
             for i, c in enumerate(cols)]
    return fsql(" UNION ALL ".join(parts))


register("table_profile", _profile_sql())(
    lambda spark, sf: PR.table_profile(features(spark, sf)))


def _nonfinite_sql():
    from demandcast.plans.features import feature_columns
    cols = feature_columns(SPEC)
    parts = [f"SELECT '{c}' AS column_name, CAST(COUNT(*) - COUNT({c}) AS BIGINT) AS nonfinite_count FROM features"
             for c in cols]
    return fsql("SELECT * FROM (" + " UNION ALL ".join(parts) + ") WHERE nonfinite_count > 0")


register("nonfinite_counts", _nonfinite_sql())(lambda spark, sf: PR.nonfinite_counts(features(spark, sf)))


def _nonfinite_cells_sql():
    from demandcast.plans.features import feature_columns
    return fsql(" UNION ALL ".join(
        f"SELECT date_block_num, campaign_id, product_id, '{c}' AS column_name FROM features WHERE {c} IS NULL"
        for c in feature_columns(SPEC) if c not in KEY))


register("nonfinite_cells", _nonfinite_cells_sql())(
    lambda spark, sf: PR.nonfinite_cells(features(spark, sf), KEY))

register("product_rollup", RSQL("SELECT * FROM prod", PRODUCT_ROLLUP))(
    lambda spark, sf: P.product_rollup(report_rows(spark, sf)))

register("campaign_rollup", RSQL("SELECT campaign_id, CAST(profit_month_sum AS DOUBLE) AS profit_month_sum, "
                                 "CAST(salary_month_sum AS DOUBLE) AS salary_month_sum FROM rollup", SAL_ROWS, ROLLUP))(
    lambda spark, sf: _out_money(campaign_rollup_df(spark, sf)))

register("total_orders", RSQL("SELECT CAST(SUM(order_ctn_month) AS BIGINT) AS total_orders FROM prod", PRODUCT_ROLLUP))(
    lambda spark, sf: P.total(P.product_rollup(report_rows(spark, sf)), "order_ctn_month", "total_orders")
                       .select(F.col("total_orders").cast("bigint")))

register("campaign_net_profit", O.with_ctes(O.FACT, O.CELLS, REPORT_ROWS, SAL_ROWS, ROLLUP, O.MARKETING, NET)
         + "SELECT Marketing_Cost_Day, campaign_id, CAST(salary_month_sum AS DOUBLE) AS salary_month_sum, "
           "profit_month FROM net")(
    lambda spark, sf: _out_money(net_profit_df(spark, sf)))


@register("pnl_total", O.with_ctes(O.FACT, O.CELLS, REPORT_ROWS, SAL_ROWS, ROLLUP, O.MARKETING, NET, O.COSTS,
                                   PRODUCT_ROLLUP)
          + """SELECT round((SELECT SUM(profit_month) FROM net) - (SELECT CAST(SUM(cost) AS DOUBLE) FROM costs)
       - 1000 * (SELECT CAST(SUM(order_ctn_month) AS DOUBLE) FROM prod)
       - (SELECT CAST(SUM(salary_month_sum) AS DOUBLE) FROM net), 4) AS total_profit""")
def q_pnl_total(spark, sf):
    rows = P.materialize(report_rows(spark, sf), "parquet")
    net = P.campaign_net_profit(TD.marketing(spark, sf), P.campaign_rollup(R.with_salary(rows)), days=29)
    tot = P.total(P.product_rollup(rows), "order_ctn_month", "total_orders")
    out = P.pnl_total(net, TD.costs(spark, sf), tot, 1000)
    return out.select(F.round("total_profit", 4).alias("total_profit"))


# --- 2.5 windows ------------------------------------------------------------------------

def _with_recency(cells):
    return P.join_back(cells, T.product_month_recency(cells), ["product_id", MONTH])


register("last_sale_pair", fsql("SELECT date_block_num, campaign_id, product_id, item_campaign_last_sale FROM rec"))(
    lambda spark, sf: _cells(spark, sf).select(*KEY, T.last_sale(TARGET).alias("item_campaign_last_sale")))

register("last_sale_item", fsql("SELECT date_block_num, campaign_id, product_id, item_last_sale FROM rec"))(
    lambda spark, sf: _with_recency(cells_once(spark, sf)).select(*KEY, "item_last_sale"))

register("first_sale_pair", fsql("SELECT date_block_num, campaign_id, product_id, item_campaign_first_sale FROM rec"))(
    lambda spark, sf: _cells(spark, sf).select(*KEY, T.first_sale().alias("item_campaign_first_sale")))

register("first_sale_item", fsql("SELECT date_block_num, campaign_id, product_id, item_first_sale FROM rec"))(
    lambda spark, sf: _with_recency(cells_once(spark, sf)).select(*KEY, "item_first_sale"))


@register("row_position", BASE + "SELECT date_block_num, campaign_id, product_id, item_cnt_month, "
          "CAST(ROW_NUMBER() OVER (ORDER BY date_block_num, campaign_id, product_id) - 1 AS BIGINT) AS ID FROM cells")
def q_row_position(spark, sf):
    return C.row_position(_cells(spark, sf).select(*KEY, TARGET), list(KEY), "ID")


def _group_stats(spark, sf):
    out = panel_once(spark, sf)
    for keys, prefix, periods in SPEC.group_stats:
        out = T.add_group_stats(out, list(keys), TARGET, prefix, periods)
    return rounded(out)


register("group_trailing_avg", fsql("SELECT date_block_num, campaign_id, product_id, "
                                    + ", ".join(c for c in STAT_COLS if "_avg_" in c) + " FROM features"))(
    lambda spark, sf: _group_stats(spark, sf).select(*KEY, *[c for c in STAT_COLS if "_avg_" in c]))

register("group_trailing_std", fsql("SELECT date_block_num, campaign_id, product_id, "
                                    + ", ".join(c for c in STAT_COLS if "_std_" in c) + " FROM features"))(
    lambda spark, sf: _group_stats(spark, sf).select(*KEY, *[c for c in STAT_COLS if "_std_" in c]))

register("normalise_by_mean", fsql("SELECT * FROM gs_category"))(
    lambda spark, sf: rounded(T.group_trailing_stats(P.join_items(_cells(spark, sf), TD.items(spark, sf)),
                                                     ["categories_id"], TARGET, "category", (12,))))

TE_COLS = [f"{name}_lag_{i}" for _, name, lags in SPEC.encodings for i in lags]


@register("target_encoding", fsql("SELECT date_block_num, campaign_id, product_id, " + ", ".join(TE_COLS)
                                  + " FROM features"))
def q_target_encoding(spark, sf):
    out = panel_once(spark, sf)
    for keys, name, lags in SPEC.encodings:
        out = T.target_encoding(out, list(keys), TARGET, name, lags)
    return out.select(*KEY, *TE_COLS)


def _price_lags(spark, sf):
    cells = cells_once(spark, sf, null_keys=True)
    k_max = max(SPEC.price_lags)
    pm = T.product_month_prices(cells, k_max)
    j = P.join_back(P.panel_rows(cells), pm, ["product_id", MONTH]).withColumn("__j", T.within_cell_index())
    return j, k_max


@register("price_lag_rows", O.with_ctes(*FEATS) + "SELECT date_block_num, campaign_id, product_id, "
          + ", ".join(f"l{k} AS date_item_avg_item_price_lag_{k}" for k in SPEC.price_lags) + " FROM pr")
def q_price_row_lags(spark, sf):
    j, k_max = _price_lags(spark, sf)
    return j.select(*KEY, *[T.price_row_lag(k, k_max).alias(f"date_item_avg_item_price_lag_{k}")
                            for k in SPEC.price_lags])


register("delta_price_lag", fsql("SELECT date_block_num, campaign_id, product_id, delta_price_lag FROM prt"))(
    lambda spark, sf: T.create_revenue_features(cells_once(spark, sf, True), SPEC.price_lags).select(*KEY, "delta_price_lag"))

register("delta_revenue_lag", fsql("SELECT date_block_num, campaign_id, product_id, delta_revenue_lag_1 FROM features"))(
    lambda spark, sf: T.create_campaign_revenue_features(cells_once(spark, sf, True)).select(*KEY, "delta_revenue_lag_1"))

def _round9(df: DataFrame, *cols: str) -> DataFrame:
    """Results of float means at 9 places (their last bits depend on the order of summation)."""
    return df.withColumns({c: F.round(c, 9) for c in cols})


SEASONAL_SERIES = """ser AS (SELECT campaign_id, date_block_num, CAST(SUM(orders) AS BIGINT) AS orders FROM fact
  GROUP BY campaign_id, date_block_num)"""


def _seasonal_sql(keys: str, src: str, tail: str) -> str:
    part = f"PARTITION BY {keys}" if keys else ""
    pk = f"{keys}, " if keys else ""
    on = " AND ".join([f"p.{k.strip()} = t.{k.strip()}" for k in keys.split(",")] if keys else ["TRUE"])
    return O.with_ctes(O.FACT, src) + f""", b AS (
  SELECT {pk}date_block_num, CAST(orders AS DOUBLE) AS observed,
         ROW_NUMBER() OVER ({part} ORDER BY date_block_num) - 1 AS pos,
         COUNT(*) OVER ({part}) AS nobs, MIN(CAST(orders AS DOUBLE)) OVER ({part}) AS mn,
         CASE WHEN COUNT(orders) OVER ({part} ORDER BY date_block_num ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) = 7
              THEN AVG(orders) OVER ({part} ORDER BY date_block_num ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) END AS tr
  FROM ser),
t AS (SELECT *, CASE WHEN nobs >= 14 AND mn > 0 THEN tr END AS trend, pos % 7 AS phase FROM b),
ph AS (SELECT {pk}phase, AVG(observed / trend) AS pm FROM t WHERE trend IS NOT NULL GROUP BY {pk}phase),
phn AS (SELECT {pk}phase, pm / AVG(pm) OVER ({part}) AS s FROM ph),
d AS (SELECT t.*, CASE WHEN nobs >= 14 AND mn > 0 THEN p.s END AS seasonal FROM t LEFT JOIN phn p
      ON {on.replace('TRUE', '1=1')} AND p.phase = t.phase)
SELECT {tail} FROM d"""


register("seasonal_trend", _seasonal_sql("", """ser AS (SELECT date_block_num, CAST(SUM(orders) AS BIGINT) AS orders
  FROM fact GROUP BY date_block_num)""",
    "date_block_num, observed, trend, round(seasonal, 9) AS seasonal, "
    "round(observed / NULLIF(seasonal, 0) / NULLIF(trend, 0), 9) AS resid"))(
    lambda spark, sf: _round9(S.decompose(P.orders_by_month(TD.fact(spark, sf)), "orders", (), 7), "seasonal", "resid"))

register("seasonal_index", _seasonal_sql("campaign_id", SEASONAL_SERIES, "campaign_id, date_block_num, round(seasonal, 9) AS seasonal"))(
    lambda spark, sf: _round9(S.decompose(_campaign_series(spark, sf), "orders", ["campaign_id"], 7), "seasonal")
                       .select("campaign_id", MONTH, "seasonal"))

register("seasonal_residual", _seasonal_sql("campaign_id", SEASONAL_SERIES,
    "campaign_id, date_block_num, observed, trend, round(seasonal, 9) AS seasonal, "
    "round(observed / NULLIF(seasonal, 0) / NULLIF(trend, 0), 9) AS resid"))(
    lambda spark, sf: _round9(S.decompose(_campaign_series(spark, sf), "orders", ["campaign_id"], 7),
                              "seasonal", "resid"))


def _campaign_series(spark, sf):
    return (TD.fact(spark, sf).groupBy("campaign_id", MONTH)
              .agg(F.sum("orders").cast("bigint").alias("orders")))


# --- 2.6 / 2.7 sorts, limits, sets ---------------------------------------------------------

register("sort_matrix", BASE + "SELECT * REPLACE (CAST(profit_month AS DOUBLE) AS profit_month) FROM matrix "
         "ORDER BY date_block_num, campaign_id, product_id")(
    lambda spark, sf: P.sort_matrix(_money(matrix(spark, sf), "profit_month")))

register("head", BASE + "SELECT * REPLACE (CAST(profit_month AS DOUBLE) AS profit_month) FROM matrix "
         "ORDER BY date_block_num, campaign_id, product_id LIMIT 5")(
    lambda spark, sf: P.head(_money(matrix(spark, sf), "profit_month"), 5))


@register("union_all", BASE + f"""SELECT date_block_num, campaign_id, product_id, item_cnt_month,
  CASE WHEN date_block_num < {VM} THEN 'train' WHEN date_block_num = {VM} THEN 'valid' ELSE 'test' END AS split
FROM cells WHERE date_block_num <= {TM}""")
def q_union_all(spark, sf):
    cells = cells_once(spark, sf).select(*KEY, TARGET)
    parts = C.split_by_month(cells, SPEC)
    return P.union_all(*[df.withColumn("split", F.lit(name)) for name, df in parts.items()])


# --- 2.8 scalar functions and cleaning -----------------------------------------------------

LABEL_SQL = ", ".join(f"CAST(DENSE_RANK() OVER (ORDER BY {c} NULLS LAST) - 1 AS INT) AS {c}"
                      for c in SPEC.label_columns)
register("label_encode", BASE + f"SELECT date_block_num, campaign_id, product_id, {LABEL_SQL} FROM matrix")(
    lambda spark, sf: C.label_encode(P.materialize(matrix(spark, sf).select(*KEY, *SPEC.label_columns), "parquet"),
                                     SPEC.label_columns, by="product_id")
                       .select(*KEY, *SPEC.label_columns))


def _float_feature_cols():
    return ["delta_price_lag", "delta_revenue_lag_1"] + STAT_COLS + TE_COLS


register("inf_to_null", fsql("SELECT date_block_num, campaign_id, product_id, "
                             + ", ".join(f"CASE WHEN isnan({c}) OR isinf({c}) THEN NULL ELSE {c} END AS {c}"
                                         for c in _float_feature_cols()) + " FROM features"))(
    lambda spark, sf: C.inf_to_null(features(spark, sf).select(*KEY, *_float_feature_cols())))


def _clean_sql():
    from demandcast.plans.features import feature_columns
    cols = [c for c in feature_columns(SPEC) if c not in SPEC.drop_before_clean]
    lab = {c: f"CAST(DENSE_RANK() OVER (ORDER BY {c} NULLS LAST) - 1 AS INT)" for c in SPEC.label_columns}
    sel1 = [f"{lab[c]} AS {c}" if c in lab else c for c in cols]
    keep = set(KEY) | {TARGET}
    sel2 = []
    for c in cols:
        if c in keep:
            sel2.append(c)
        elif c in lab:
            sel2.append(f"CAST({c} AS DOUBLE) AS {c}")
        else:
            v = f"COALESCE(CAST({c} AS DOUBLE), CAST(AVG({c}) OVER () AS DOUBLE))"
            sel2.append(f"{f'round({v}, 9)' if c in _float_feature_cols() else v} AS {c}")
    return fsql(f"SELECT {', '.join(sel2)} FROM lab", f"lab AS (SELECT {', '.join(sel1)} FROM features)")


register("mean_impute", _clean_sql())(
    lambda spark, sf: _clean(spark, sf))


def _clean(spark, sf):
    out = C.clean_features(features(spark, sf), SPEC)
    return _round9(out, *[c for c in _float_feature_cols() if c in out.columns])


LAG_COLS = [f"{TARGET}_lag_{i}" for i in SPEC.count_lags]


def _count_lags(spark, sf):
    return T.lag_feature(_cells(spark, sf), SPEC.count_lags, TARGET).select(*KEY, *LAG_COLS)


register("zero_fill", fsql("SELECT date_block_num, campaign_id, product_id, "
                           + ", ".join(f"COALESCE({c}, 0) AS {c}" for c in LAG_COLS) + " FROM features"))(
    lambda spark, sf: C.zero_fill(_count_lags(spark, sf), LAG_COLS))


@register("coalesce_trend", O.with_ctes(*FEATS) + "SELECT date_block_num, campaign_id, product_id, "
          + ", ".join(f"(l{k} - ap) / NULLIF(ap, 0) AS delta_price_lag_{k}" for k in SPEC.price_lags)
          + ", COALESCE(" + ", ".join(f"(l{k} - ap) / NULLIF(ap, 0)" for k in SPEC.price_lags)
          + ", 0.0) AS delta_price_lag FROM pr")
def q_coalesce_trend(spark, sf):
    j, k_max = _price_lags(spark, sf)
    d = j.select(*KEY, *[FN.relative_change(T.price_row_lag(k, k_max), "item_avg_item_price")
                         .alias(f"delta_price_lag_{k}") for k in SPEC.price_lags])
    return d.withColumn("delta_price_lag", C.coalesce_trend([f"delta_price_lag_{k}" for k in SPEC.price_lags]))


register("cast_float", fsql("SELECT date_block_num, campaign_id, product_id, "
                            + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in LAG_COLS) + " FROM features"))(
    lambda spark, sf: C.cast_float(_count_lags(spark, sf), LAG_COLS))


# --- 2.9 modelling ---------------------------------------------------------------------------
# Written stages (the training table, the level-2 predictions) are shared by the keys of one application and
# data folder; ``release_models`` forgets them.

from demandcast.operators import learn as L  # noqa: E402
from demandcast.plans import forecast as FC  # noqa: E402

_STAGES: dict = {}
FIXED_A, FIXED_B = L.without_unmapped(L.BOOSTER_A_FIXED), L.without_unmapped(L.BOOSTER_B_FIXED)


def _stage(spark, sf, name, fn):
    app = spark.sparkContext.applicationId
    for key in [k for k in _STAGES if k[0] != app]:          # frames of an ended session
        del _STAGES[key]
    if (app, sf, name) not in _STAGES:
        _STAGES[app, sf, name] = fn()
    return _STAGES[app, sf, name]


def release_models() -> None:
    _STAGES.clear()


def prepared(spark, sf):
    return _stage(spark, sf, "prepared", lambda: FC.prepared_table(*TD.inputs(spark, sf), SPEC))


def level2(spark, sf):
    return _stage(spark, sf, "level2", lambda: FC.base_predictions(prepared(spark, sf), SPEC))


def ols_level2(spark, sf):
    """The fold ensemble and level 2 with the exact learner: a fold mean of least squares on two features each."""
    return _stage(spark, sf, "ols2", lambda: _ols_level2(spark, sf))


OLS_FEATURES = {"lgb": ("item_cnt_month_lag_1", "item_cnt_month_lag_2"), "xgb": ("item_cnt_month_lag_3",
                                                                                 "item_cnt_month_lag_6")}


def _ols_level2(spark, sf):
    lags = L.with_folds(C.zero_fill(T.lag_feature(_cells(spark, sf), SPEC.count_lags, TARGET), LAG_COLS)
                        .filter(F.col(MONTH) <= TM).select(*KEY, TARGET, *LAG_COLS))
    lags = P.materialize(lags, "parquet")
    scored = L.score_months(lags, SPEC).select(*KEY, TARGET)
    for name, cols in OLS_FEATURES.items():
        part = L.kfold_predictions(L.assemble(lags, cols), "ols", SPEC, 5, name)
        scored = scored.join(part.drop(TARGET), list(KEY))
    return P.materialize(scored, "parquet")


def _ols_ctes():
    """Fold-wise normal equations of two features with an intercept, solved by Cramer's rule, and their fold mean."""
    lagged = ", ".join(f"COALESCE(l{i}.item_cnt_month, 0) AS item_cnt_month_lag_{i}" for i in SPEC.count_lags)
    joins = " ".join(f"LEFT JOIN cells l{i} ON l{i}.campaign_id = m.campaign_id AND l{i}.product_id = m.product_id "
                     f"AND l{i}.date_block_num = m.date_block_num - {i}" for i in SPEC.count_lags)
    fold = FOLD_SQL
    for k in KEY:
        fold = fold.replace(f"CAST({k} AS VARCHAR)", f"CAST(m.{k} AS VARCHAR)")
    ctes = [f"lagged AS (SELECT m.date_block_num, m.campaign_id, m.product_id, m.item_cnt_month, {fold} AS fold, "
            f"{lagged} FROM cells m {joins} WHERE m.date_block_num <= {TM})"]
    for name, (a, b) in OLS_FEATURES.items():
        ctes.append(f"""{name}_s AS (SELECT f.k, CAST(COUNT(*) AS DOUBLE) AS n, CAST(SUM({a}) AS DOUBLE) AS sa,
    CAST(SUM({b}) AS DOUBLE) AS sb, CAST(SUM(item_cnt_month) AS DOUBLE) AS sy, CAST(SUM({a} * {a}) AS DOUBLE) AS saa,
    CAST(SUM({a} * {b}) AS DOUBLE) AS sab, CAST(SUM({b} * {b}) AS DOUBLE) AS sbb,
    CAST(SUM({a} * item_cnt_month) AS DOUBLE) AS say, CAST(SUM({b} * item_cnt_month) AS DOUBLE) AS sby
  FROM range(5) f(k) JOIN lagged ON fold <> f.k AND date_block_num < {VM} GROUP BY f.k),
{name}_d AS (SELECT *, n * (saa * sbb - sab * sab) - sa * (sa * sbb - sab * sb) + sb * (sa * sab - saa * sb) AS det
  FROM {name}_s),
{name}_c AS (SELECT k, (sy * (saa * sbb - sab * sab) - sa * (say * sbb - sab * sby) + sb * (say * sab - saa * sby)) / det AS c0,
    (n * (say * sbb - sab * sby) - sy * (sa * sbb - sab * sb) + sb * (sa * sby - say * sb)) / det AS c1,
    (n * (saa * sby - say * sab) - sa * (sa * sby - say * sb) + sy * (sa * sab - saa * sb)) / det AS c2 FROM {name}_d),
{name}_p AS (SELECT date_block_num, campaign_id, product_id, item_cnt_month, AVG(c0 + c1 * {a} + c2 * {b}) AS {name}
  FROM lagged, {name}_c WHERE date_block_num IN ({VM}, {TM})
  GROUP BY date_block_num, campaign_id, product_id, item_cnt_month)""")
    ctes.append("lvl2 AS (SELECT * FROM lgb_p JOIN xgb_p USING (date_block_num, campaign_id, product_id, item_cnt_month))")
    return ctes


register("kfold_ensemble_ols", O.with_ctes(O.FACT, O.CELLS, *_ols_ctes()) +
         "SELECT date_block_num, campaign_id, product_id, item_cnt_month, round(lgb, 6) AS lgb, round(xgb, 6) AS xgb "
         "FROM lvl2")(
    lambda spark, sf: ols_level2(spark, sf).withColumns({c: F.round(c, 6) for c in ("lgb", "xgb")}))

register("stack_meta_ols", O.with_ctes(O.FACT, O.CELLS, *_ols_ctes(), f"""st AS (SELECT CAST(COUNT(*) AS DOUBLE) AS n,
  SUM(lgb) AS sa, SUM(xgb) AS sb, SUM(CAST(item_cnt_month AS DOUBLE)) AS sy, SUM(lgb * lgb) AS saa, SUM(lgb * xgb) AS sab,
  SUM(xgb * xgb) AS sbb, SUM(lgb * item_cnt_month) AS say, SUM(xgb * item_cnt_month) AS sby
  FROM lvl2 WHERE date_block_num = {VM}),
sd AS (SELECT *, n * (saa * sbb - sab * sab) - sa * (sa * sbb - sab * sb) + sb * (sa * sab - saa * sb) AS det FROM st),
sc AS (SELECT (sy * (saa * sbb - sab * sab) - sa * (say * sbb - sab * sby) + sb * (say * sab - saa * sby)) / det AS c0,
  (n * (say * sbb - sab * sby) - sy * (sa * sbb - sab * sb) + sb * (sa * sby - say * sb)) / det AS c1,
  (n * (saa * sby - say * sab) - sa * (sa * sby - say * sb) + sy * (sa * sab - saa * sb)) / det AS c2 FROM sd)""")
         + "SELECT date_block_num, campaign_id, product_id, round(c0 + c1 * lgb + c2 * xgb, 4) "
           "AS item_cnt_month_forecast FROM lvl2, sc")(
    lambda spark, sf: L.stack_meta(ols_level2(spark, sf), ["lgb", "xgb"], SPEC, learner="ols")
                       .select(*KEY, F.round("item_cnt_month_forecast", 4).alias("item_cnt_month_forecast")))


def _assembled_sql():
    from demandcast.plans.features import feature_columns
    cols = [c for c in feature_columns(SPEC) if c not in SPEC.drop_before_clean and c != TARGET]
    outer = [c if c in KEY else f"round({c}, 6) AS {c}" if "_std_" in c else f"CAST({c} AS DOUBLE) AS {c}" for c in cols]
    return f"SELECT {', '.join(outer)}, item_cnt_month FROM ({_clean_sql()}) WHERE date_block_num <= {TM}"


@register("assemble_features", _assembled_sql())
def q_assemble_features(spark, sf):
    """The feature vector as columns again, to compare with the cleaning SQL."""
    from pyspark.ml.functions import vector_to_array
    p = prepared(spark, sf)
    attrs = json.loads(p.schema[L.FEATURES].json())["metadata"]["ml_attr"]["attrs"]
    names = {a["idx"]: a["name"] for kind in attrs.values() for a in kind}
    wide = p.withColumn("__v", vector_to_array(L.FEATURES))
    values = [F.col("__v")[i].alias(n) for i, n in sorted(names.items()) if n not in KEY]
    return rounded(_round9(wide.select(*KEY, *values, TARGET),
                           *[c for c in _float_feature_cols() if c in names.values() and "_std_" not in c]))


register("booster_a_fixed")(lambda spark, sf: L.fit_predict(prepared(spark, sf), FIXED_A, SPEC, "lgb"))

register("booster_b_fixed")(lambda spark, sf: L.fit_predict(prepared(spark, sf), FIXED_B, SPEC, "xgb"))

register("early_stop")(lambda spark, sf: L.fit_predict(prepared(spark, sf), FIXED_B, SPEC, "xgb",
                                                       patience=L.PATIENCE_B))


@register("categorical_features", fsql(
    f"SELECT 'categories_name' AS column_name, CAST(MAX(code) + 1 AS INT) AS num_vals FROM ("
    f"SELECT DENSE_RANK() OVER (ORDER BY categories_name NULLS LAST) - 1 AS code FROM features "
    f"WHERE date_block_num <= {TM}) UNION ALL "
    f"SELECT 'categories_id', CAST(trunc(MAX(COALESCE(categories_id, m))) + 1 AS INT) FROM (SELECT categories_id, "
    f"AVG(categories_id) OVER () AS m, date_block_num FROM features) WHERE date_block_num <= {TM}"))
def q_categorical_features(spark, sf):
    """Categorical columns and their number of values, as declared to the trees."""
    rows = [{"column_name": n, "num_vals": v} for n, v in L.nominal_sizes(prepared(spark, sf)).items()]
    return spark.createDataFrame(rows, "column_name string, num_vals int")


register("kfold_assign", BASE + f"SELECT date_block_num, campaign_id, product_id, {FOLD_SQL} AS fold FROM cells "
         f"WHERE date_block_num < {VM}")(
    lambda spark, sf: L.with_folds(_cells(spark, sf).filter(F.col(MONTH) < VM).select(*KEY)))

register("kfold_ensemble")(lambda spark, sf: level2(spark, sf).select(*KEY, TARGET, "lgb"))

register("stack_level2")(lambda spark, sf: level2(spark, sf))

register("stack_meta")(lambda spark, sf: L.stack_meta(level2(spark, sf), ["lgb", "xgb"], SPEC))


def _valid_forecasts(spark, sf):
    """Validation-month rows with the two SQL-expressible forecasts (lag 1, trailing 6-month mean)."""
    cells = T.lag_feature(P.build_cells(TD.fact(spark, sf, months=(VM - 6, VM))), [1], TARGET)
    return (cells.select(*KEY, TARGET, R.lag1_forecast(cells).alias("lag_1"),
                         R.trailing_mean_forecast(cells, 6).alias("mean_6"))
                 .filter(F.col(MONTH) == VM))


VALID_FC = f"""vf AS (SELECT m.date_block_num, m.campaign_id, m.product_id, m.item_cnt_month,
  CAST(COALESCE(l.item_cnt_month, 0) AS DOUBLE) AS lag_1,
  CAST(COALESCE((SELECT SUM(h.item_cnt_month) FROM cells h WHERE h.campaign_id = m.campaign_id
       AND h.product_id = m.product_id AND h.date_block_num BETWEEN m.date_block_num - 6 AND m.date_block_num - 1), 0)
       AS DOUBLE) / 6 AS mean_6
FROM cells m LEFT JOIN cells l ON l.campaign_id = m.campaign_id AND l.product_id = m.product_id
     AND l.date_block_num = m.date_block_num - 1
WHERE m.date_block_num = {VM})"""


@register("rmse", O.with_ctes(O.FACT, O.CELLS, VALID_FC) +
          "SELECT round(sqrt(avg((item_cnt_month - lag_1) * (item_cnt_month - lag_1))), 9) AS rmse_lag_1, "
          "round(sqrt(avg((item_cnt_month - mean_6) * (item_cnt_month - mean_6))), 9) AS rmse_mean_6 FROM vf")
def q_rmse(spark, sf):
    v = _valid_forecasts(spark, sf)
    a = R.rmse(v, TARGET, "lag_1").select(F.round("rmse", 9).alias("rmse_lag_1"))
    b = R.rmse(v, TARGET, "mean_6").select(F.round("rmse", 9).alias("rmse_mean_6"))
    return a.crossJoin(b)


@register("blend_alpha", O.with_ctes(O.FACT, O.CELLS, VALID_FC) + """, grid AS (SELECT CAST(range AS DOUBLE) * CAST(0.02 AS DOUBLE) AS alpha FROM range(50)),
scored AS (SELECT g.alpha, sqrt(avg(power(v.item_cnt_month - (g.alpha * v.lag_1 + (1 - g.alpha) * v.mean_6), 2))) AS rmse
  FROM grid g, vf v GROUP BY g.alpha)
SELECT alpha, round(rmse, 6) AS rmse FROM scored ORDER BY rmse, alpha LIMIT 1""")
def q_blend_alpha(spark, sf):
    b = R.blend_alpha(_valid_forecasts(spark, sf), TARGET, "lag_1", "mean_6")
    return b.select("alpha", F.round("rmse", 6).alias("rmse"))


@register("blend_ols", O.with_ctes(O.FACT, O.CELLS, VALID_FC) + """, s AS (SELECT CAST(COUNT(*) AS DOUBLE) AS n,
  SUM(lag_1) AS sa, SUM(mean_6) AS sb, SUM(CAST(item_cnt_month AS DOUBLE)) AS sy, SUM(lag_1 * lag_1) AS saa,
  SUM(lag_1 * mean_6) AS sab, SUM(mean_6 * mean_6) AS sbb, SUM(lag_1 * item_cnt_month) AS say,
  SUM(mean_6 * item_cnt_month) AS sby FROM vf),
d AS (SELECT *, n * (saa * sbb - sab * sab) - sa * (sa * sbb - sab * sb) + sb * (sa * sab - saa * sb) AS det FROM s)
SELECT round((sy * (saa * sbb - sab * sab) - sa * (say * sbb - sab * sby) + sb * (say * sab - saa * sby)) / det, 6) AS intercept,
       round((n * (say * sbb - sab * sby) - sy * (sa * sbb - sab * sb) + sb * (sa * sby - say * sb)) / det, 6) AS coef_1,
       round((n * (saa * sby - say * sab) - sa * (sa * sby - say * sb) + sy * (sa * sab - saa * sb)) / det, 6) AS coef_2
FROM d""")
def q_blend_ols(spark, sf):
    o = R.ols_two(_valid_forecasts(spark, sf), TARGET, "lag_1", "mean_6")
    return o.select(*[F.round(c, 6).alias(c) for c in ("intercept", "coef_1", "coef_2")])


def _two_forecasts(spark, sf):
    """Validation and test rows with the two SQL-expressible forecasts, written once."""
    cells = T.lag_feature(P.build_cells(TD.fact(spark, sf, months=(VM - 6, TM))), [1], TARGET)
    return P.materialize(cells.select(*KEY, TARGET, R.lag1_forecast(cells).alias("lag_1"),
                                      R.trailing_mean_forecast(cells, 6).alias("mean_6"))
                         .filter(F.col(MONTH).isin(VM, TM)), "parquet")


def _blend_file(spark, rows, name, digits=4):
    out = rows.filter(F.col(MONTH) == TM).withColumn(R.FORECAST, F.round(R.FORECAST, digits))
    return SK.write_forecast_csv(out, SK.scratch_dir(out, name), ["campaign_id", "product_id"], R.FORECAST)


TEST_FC = VALID_FC.replace("vf AS", "tf AS").replace(f"WHERE m.date_block_num = {VM}", f"WHERE m.date_block_num = {TM}")
FILE_SQL = ("SELECT CAST(ROW_NUMBER() OVER (ORDER BY campaign_id, product_id) - 1 AS BIGINT) AS ID, "
            "round({0}, 4) AS item_cnt_month FROM tf, best")


@register("blend_alpha_forecast", SQL["blend_alpha"].replace(O.with_ctes(O.FACT, O.CELLS, VALID_FC),
                                                             O.with_ctes(O.FACT, O.CELLS, VALID_FC, TEST_FC))
          .replace("SELECT alpha, round(rmse, 6)", ", best AS (SELECT alpha, round(rmse, 6)")
          + ")\n" + FILE_SQL.format("alpha * lag_1 + (1 - alpha) * mean_6"))
def q_blend_alpha_forecast(spark, sf):
    """The best weight of the validation month, applied to the test month and written as a forecast file."""
    f = _two_forecasts(spark, sf)
    best = R.blend_alpha(f.filter(F.col(MONTH) == VM), TARGET, "lag_1", "mean_6")
    return _blend_file(spark, R.apply_blend(f, best, "lag_1", "mean_6"), "blend-alpha")


@register("blend_ols_forecast", SQL["blend_ols"].replace(O.with_ctes(O.FACT, O.CELLS, VALID_FC),
                                                         O.with_ctes(O.FACT, O.CELLS, VALID_FC, TEST_FC))
          .replace("FROM s)\nSELECT", "FROM s),\nbest AS (SELECT").replace(", 6) AS", ", 12) AS")
          + ")\n" + FILE_SQL.format("intercept + coef_1 * lag_1 + coef_2 * mean_6"))
def q_blend_ols_forecast(spark, sf):
    """The least-squares blend of the validation month, applied to the test month and written as a forecast file."""
    f = _two_forecasts(spark, sf)
    best = R.ols_two(f.filter(F.col(MONTH) == VM), TARGET, "lag_1", "mean_6")
    return _blend_file(spark, R.apply_ols(f, best, "lag_1", "mean_6"), "blend-ols")


@register("blend_booster")
def q_blend_booster(spark, sf):
    """The second library's booster with its documented defaults on the base predictions; test month as a file."""
    out = L.stack_meta(level2(spark, sf), ["lgb", "xgb"], SPEC, L.DEFAULTS_B, R.FORECAST)
    return _blend_file(spark, out, "blend-booster", 12)


@register("stacked_forecast")
def q_stacked_forecast(spark, sf):
    fc = FC.stacked_forecast(prepared(spark, sf), SPEC, level2(spark, sf))
    rows = FC.forecast_rows(fc, SPEC)
    return SK.write_forecast_csv(rows, SK.scratch_dir(rows, "stacked-submission"), ["campaign_id", "product_id"],
                                 "item_cnt_month_forecast")


register("forecast_vs_actual", RSQL(f"SELECT date_block_num, campaign_id, product_id, item_cnt_month_forecast, "
                                    f"item_cnt_month, {JITTER_SQL} AS target FROM rows"))(
    lambda spark, sf: R.forecast_vs_actual(report_rows(spark, sf)))


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict:
    return dict(SQL)
