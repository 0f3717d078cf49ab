"""The feature matrix (flagship): the whole feature chain as one lazy plan.

Physical shape (see README "Plan"):

1. ``build_cells``: one scan of the order lines, partial + final aggregation
   to (month, campaign, product), written once with the item's category and the
   row's index inside its (product, month) cell (the one narrow shuffle).
2. Three aggregates of the cells: product-month sums (written once; the category
   and month tables are rolled up from them), campaign-month and
   campaign-category-month; windows over each table's own key (at most one row
   per month per key).
3. One LEFT JOIN per group table onto the panel (broadcast only below the
   threshold; the month table has one row per month).
4. One window pass over (campaign, product) that produces all 18 pair lags,
   last sale and first sale together: the one panel-wide exchange, numbers only.
5. The item's strings, joined last.

The 68 merges and 72 group-bys of the original chain become 3 aggregates and 6
joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandcast.operators.panel import (
    CELL_SUMS, build_cells, complete_key, join_back, join_back_sized, join_items, materialize, materialize_with_sizes,
    panel_rows,
)
from demandcast.operators.temporal import (
    PRODUCT_SUMS, UNBOUNDED, last_sale, lag_columns, month_window, normalise, price_trend_columns, product_month_sums,
    product_prices, trailing_stat_columns, within_cell_index,
)
from demandcast.functions.columns import calendar_month, calendar_year, relative_change
from demandcast.spec import KEY, FactSpec, MONTH, PAIR, TARGET

BASE_COLUMNS = ["date_block_num", "campaign_id", "product_id", "item_cnt_month", "profit_month",
                "name", "short_description", "categories_id", "categories_name"]


def feature_columns(spec: FactSpec) -> list[str]:
    """Column order of the reference feature matrix."""
    cols = list(BASE_COLUMNS) + (["month", "year"] if spec.calendar else [])
    cols += [f"{TARGET}_lag_{i}" for i in spec.count_lags]
    for _, prefix, periods in spec.group_stats:
        for p in periods:
            cols += [f"{prefix}_avg_sale_last_{p}", f"{prefix}_std_sale_last_{p}"]
    for _, name, lags in spec.encodings:
        cols += [f"{name}_lag_{i}" for i in lags]
    cols += ["delta_price_lag", "delta_revenue_lag_1", "item_campaign_last_sale", "item_last_sale",
             "item_campaign_first_sale", "item_first_sale"]
    return cols


def _stats_spec(spec: FactSpec, key: tuple):
    for keys, prefix, periods in spec.group_stats:
        if tuple(keys) == tuple(key):
            return prefix, periods
    return None


def _encoding(spec: FactSpec, key: tuple):
    for keys, name, lags in spec.encodings:
        if tuple(keys) == tuple(key):
            return name, lags
    return None


def product_month_table(sums: DataFrame, spec: FactSpec) -> DataFrame:
    """All product-grain features at (product, month), from the product-month sums."""
    pm = product_prices(sums, max(spec.price_lags))
    whole = Window.partitionBy("product_id")
    cols = {"item_last_sale": last_sale("__best", ["product_id"], spec.max_month),
            "item_first_sale": (F.col(MONTH) - F.min(MONTH).over(whole)).cast("int")}
    enc = _encoding(spec, ("product_id",))
    if enc:
        cols[enc[0]] = F.col("__x").cast("double") / F.col("__rows")
    names, norm = [], {}
    st = _stats_spec(spec, ("product_id",))
    if st:
        raw, norm, names = trailing_stat_columns(["product_id"], st[0], st[1])
        cols.update(raw)
    pm = pm.withColumns(cols)
    if names:
        pm = normalise(pm, names, norm)
    return pm.drop(*PRODUCT_SUMS, "categories_id")


def campaign_month_table(cells: DataFrame, spec: FactSpec) -> DataFrame:
    """Campaign-grain features at (campaign, month): stats, encoding, revenue delta.

    Cells without a product (R8) add to the revenue only; months that have nothing else count for
    the campaign's mean revenue and then leave.
    """
    inside = complete_key()
    cm = (cells.filter(complete_key(["campaign_id", MONTH])).groupBy("campaign_id", MONTH)
               .agg(F.coalesce(F.sum(F.when(inside, F.col(TARGET))), F.lit(0)).alias("__x"),
                    F.count(F.when(inside, 1)).alias("__n"),
                    F.coalesce(F.sum("margin_sum"), F.lit(0)).alias("__rev")))
    whole = Window.partitionBy("campaign_id")
    avg = F.sum("__rev").over(whole).cast("double") / F.count(F.lit(1)).over(whole)
    cm = cm.withColumn("delta_revenue", relative_change(F.col("__rev").cast("double"), avg)).filter("__n > 0")
    cols = {}
    enc = _encoding(spec, ("campaign_id",))
    if enc:
        cols[enc[0]] = F.col("__x").cast("double") / F.col("__n")
    names, norm = [], {}
    st = _stats_spec(spec, ("campaign_id",))
    if st:
        raw, norm, names = trailing_stat_columns(["campaign_id"], st[0], st[1])
        cols.update(raw)
    cm = cm.withColumns(cols)
    if names:
        cm = normalise(cm, names, norm)
    return cm.drop("__x", "__n", "__rev")


def group_source(panel: DataFrame, sums: DataFrame, keys: tuple) -> DataFrame:
    """(month, *keys, __x, __n) sums: rolled up from the product-month sums where the product decides the
    keys (the category, or none), from the panel otherwise."""
    if set(keys) <= {"categories_id"}:
        return (sums.filter(complete_key(keys)).groupBy(MONTH, *keys)
                    .agg(F.sum("__x").alias("__x"), F.sum("__rows").alias("__n")).filter("__n > 0"))
    return (panel.filter(complete_key(keys)).groupBy(MONTH, *keys)
                 .agg(F.sum(TARGET).alias("__x"), F.count(F.lit(1)).alias("__n")))


def keyed_stats_table(source: DataFrame, keys: tuple, prefix: str, periods) -> DataFrame:
    raw, norm, names = trailing_stat_columns(list(keys), prefix, periods)
    return normalise(source.withColumns(raw), names, norm).select(MONTH, *keys, *names)


def encoding_table(source: DataFrame, keys: tuple, name: str) -> DataFrame:
    return source.select(MONTH, *keys, (F.col("__x").cast("double") / F.col("__n")).alias(name))


def feature_matrix(lines: DataFrame, items: DataFrame, spec: FactSpec = FactSpec(),
                   materialize_panel: str = "parquet") -> DataFrame:
    # One scan of the raw lines.  The cells carry numbers only (the item's category, no strings) and the
    # row's index inside its (product, month) cell, which the price row lags (R3) need.
    # The row count of every group table, estimated while the cells are written,
    # decides broadcast vs shuffle join for it.
    groupings = {"pm": ["product_id", MONTH], "cm": ["campaign_id", MONTH]}
    extra = [tuple(k) for k, _, _ in spec.group_stats] + [tuple(k) for k, _, _ in spec.encodings if k]
    for keys in extra:
        if keys not in (("product_id",), ("campaign_id",)):
            groupings["_".join(keys)] = [MONTH, *keys]
    cells = join_items(build_cells(lines, null_keys=True), items.select("id", "categories_id"))
    cells = cells.withColumn("__j", within_cell_index())
    cells, est = materialize_with_sizes(cells, groupings, materialize_panel)
    panel = panel_rows(cells).drop(*CELL_SUMS)
    category = cells.select("product_id", "categories_id").filter(complete_key(["product_id"])).distinct()
    sums = materialize(join_back(product_month_sums(cells), category, ["product_id"]), materialize_panel)

    x = panel
    x = join_back_sized(x, product_month_table(sums, spec), ["product_id", MONTH], est["pm"])
    x = join_back_sized(x, campaign_month_table(cells, spec), ["campaign_id", MONTH], est["cm"])
    for keys, prefix, periods in spec.group_stats:
        if tuple(keys) not in (("product_id",), ("campaign_id",)):
            source = group_source(panel, sums, tuple(keys))
            x = join_back_sized(x, keyed_stats_table(source, tuple(keys), prefix, periods), [MONTH, *keys],
                                est["_".join(keys)])
    for keys, name, _ in spec.encodings:
        if not keys:   # one row per month: proven small
            x = join_back(x, encoding_table(group_source(panel, sums, ()), (), name), [MONTH], bounded=True)
        elif tuple(keys) not in (("product_id",), ("campaign_id",)):
            x = join_back_sized(x, encoding_table(group_source(panel, sums, tuple(keys)), tuple(keys), name),
                                [MONTH, *keys], est["_".join(keys)])
    x = x.withColumn("delta_price_lag", price_trend_columns(spec.price_lags))

    # one window pass at (campaign, product) grain for every pair-grain column
    pair = {}
    pair.update(lag_columns(TARGET, spec.count_lags))
    for _, name, lags in spec.encodings:
        pair.update(lag_columns(name, lags))
    pair.update(lag_columns("delta_revenue", [1]))
    pair["item_campaign_last_sale"] = last_sale(TARGET, PAIR, spec.max_month)
    pair["item_campaign_first_sale"] = (
        F.col(MONTH) - F.min(MONTH).over(month_window(PAIR).rowsBetween(UNBOUNDED, Window.unboundedFollowing))
    ).cast("int")
    x = x.withColumns(pair)
    # the item's strings come last, so that no exchange carries them
    strings = items.drop("categories_id").withColumnRenamed("id", "product_id")
    x = join_back(x, strings, ["product_id"])
    if spec.calendar:
        x = x.withColumns({"month": calendar_month(), "year": calendar_year()})
    return x.select(*[F.col(c).cast("double").alias(c) if c == "profit_month" else F.col(c)
                      for c in feature_columns(spec)])


def feature_matrix_chain(lines: DataFrame, items: DataFrame, spec: FactSpec = FactSpec()) -> DataFrame:
    """The same table built by chaining the reference-shaped operators one by one.

    Used by tests as a differential check of ``feature_matrix``'s fused plan.
    """
    from demandcast.operators import temporal as T
    cells = materialize(join_items(build_cells(lines, null_keys=True), items))
    m = T.lag_feature(panel_rows(cells), spec.count_lags, TARGET)
    for keys, prefix, periods in spec.group_stats:
        m = materialize(T.add_group_stats(m, list(keys), TARGET, prefix, periods))
    for keys, name, lags in spec.encodings:
        m = materialize(T.target_encoding(m, list(keys), TARGET, name, lags))
    price = T.create_revenue_features(cells, spec.price_lags).select(*KEY, "delta_price_lag")
    revenue = T.create_campaign_revenue_features(cells).select(*KEY, "delta_revenue_lag_1")
    m = materialize(m.join(price, list(KEY)).join(revenue, list(KEY)))
    m = T.add_sales_features(m, TARGET, spec.max_month)
    return m.select(*[F.col(c).cast("double").alias(c) if c == "profit_month" else F.col(c)
                      for c in feature_columns(spec)])
