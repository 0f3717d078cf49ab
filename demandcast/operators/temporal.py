"""Time-aware features over the monthly panel.

Two kinds of "previous" exist and must not be mixed up:

* month lags (R2): the value exactly ``i`` months back for the same key, or
  missing.  Written as a RANGE frame ``[i PRECEDING, i PRECEDING]`` over the
  month; one Window pass over one (partition, order) spec produces every lag
  column, so all pair lags share a single Exchange + Sort.
* row lags (R3): the price shift of the original pipeline walks rows of one
  product in (month, campaign) order, so lag 1 can be another campaign in the
  same month.  ``price_row_lags`` reproduces that without a window over a
  whole product (a hot product could hold a third of the panel): the row's
  index inside its (product, month) cell plus the sizes and prices of the
  product's previous months (a window over the small product-month table)
  locate the row ``k`` places back.

Group statistics are computed on a group-grain table (one row per group and
month), windowed there (partition = group key, at most one row per month) and
joined back once.  Nothing here windows the panel on a low-cardinality key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandcast.functions.columns import ratio, relative_change
from demandcast.operators.panel import attach_scalar, cached, complete_key, join_back, panel_rows
from demandcast.spec import MONTH, PAIR, TARGET

UNBOUNDED = Window.unboundedPreceding


def month_window(partition: Sequence[str]) -> Window:
    return Window.partitionBy(*partition).orderBy(MONTH)


def month_lag(col: str, i: int, partition: Sequence[str] = PAIR) -> Column:
    """Value of ``col`` exactly ``i`` months earlier for the same key (R2)."""
    return F.max(col).over(month_window(partition).rangeBetween(-i, -i))


def lag_columns(col: str, lags: Sequence[int], partition: Sequence[str] = PAIR) -> dict:
    return {f"{col}_lag_{i}": month_lag(col, i, partition) for i in lags}


def lag_feature(df: DataFrame, lags: Sequence[int], col: str) -> DataFrame:
    """Add ``{col}_lag_{i}`` for every ``i`` in ``lags`` at (campaign, product) grain."""
    return df.withColumns(lag_columns(col, lags))


def union_lag_feature(df: DataFrame, lags: Sequence[int], col: str) -> DataFrame:
    """The literal self-join form of ``lag_feature`` (one left join per lag).

    Kept as the differential reference for tests and the bench; ``lag_feature``
    is the form to use.
    """
    out = df
    base = df.select(MONTH, *PAIR, col)
    for i in lags:
        shifted = base.select((F.col(MONTH) + i).alias(MONTH), *PAIR, F.col(col).alias(f"{col}_lag_{i}"))
        out = out.join(shifted, [MONTH, *PAIR], "left")
    return out


# --- group-grain statistics -------------------------------------------------

def group_sums(df: DataFrame, keys: Sequence[str], target: str = TARGET) -> DataFrame:
    """Sum of ``target`` per (month, *keys); rows whose key is NULL are dropped."""
    return (df.filter(complete_key(keys)).groupBy(MONTH, *keys)
              .agg(F.sum(target).alias("__x"), F.count(F.lit(1)).alias("__n")))


def trailing_stat_columns(keys: Sequence[str], prefix: str, periods: Sequence[int],
                          value: str = "__x") -> tuple[dict, dict, list]:
    """Trailing zero-filled mean and population std of ``value`` over the previous ``p`` months.

    Returns (raw columns, normaliser aggregates, final names).  R5: missing months
    count as 0 and the divisor is always ``p``; R6: population std, clamped at 0.
    """
    raw, norm, names = {}, {}, []
    w_base = month_window(keys)
    x = F.col(value).cast("double")
    for p in periods:
        w = w_base.rangeBetween(-p, -1)
        s = F.coalesce(F.sum(value).over(w), F.lit(0))
        q = F.coalesce(F.sum(x * x).over(w), F.lit(0.0))
        mean = s.cast("double") / F.lit(p)
        std = F.sqrt(F.greatest(q / F.lit(p) - mean * mean, F.lit(0.0)))
        a, sd = f"{prefix}_avg_sale_last_{p}", f"{prefix}_std_sale_last_{p}"
        raw[f"__s_{a}"] = s
        raw[a] = mean
        raw[sd] = std
        # R7 normaliser: unweighted mean over group rows.  For the mean it is
        # computed from the exact integer sum: sum(s)/(p*n).
        norm[f"__m_{a}"] = F.sum(f"__s_{a}").cast("double") / (F.lit(p) * F.count(F.lit(1)))
        norm[f"__m_{sd}"] = F.avg(sd)
        names += [a, sd]
    return raw, norm, names


def normalise(df: DataFrame, names: Sequence[str], norm: dict) -> DataFrame:
    """Divide each stat by its mean over the group rows (1-row aggregate, broadcast).

    The group table feeds both the 1-row aggregate and the output; the two
    branches prune different columns, so without caching the panel would be
    aggregated twice.  The table is small (one row per key and month) and is
    persisted (recomputed from its source if an executor is lost).
    """
    df = cached(df)
    one = df.agg(*[v.alias(k) for k, v in norm.items()])
    j = attach_scalar(df, one)
    out = {n: ratio(F.col(n), F.col(f"__m_{n}")) for n in names}
    return j.withColumns(out).drop(*one.columns).drop(*[c for c in j.columns if c.startswith("__s_")])


def group_trailing_stats(df: DataFrame, keys: Sequence[str], target: str, prefix: str,
                         periods: Sequence[int]) -> DataFrame:
    """Group-grain table ``(month, *keys, <prefix>_avg/std_sale_last_<p> ...)``, normalised."""
    g = group_sums(df, keys, target)
    raw, norm, names = trailing_stat_columns(keys, prefix, periods)
    g = g.withColumns(raw)
    return normalise(g, names, norm).select(MONTH, *keys, *names)


def add_group_stats(df: DataFrame, keys: Sequence[str], target: str, prefix: str,
                    periods: Sequence[int]) -> DataFrame:
    """Reference-shaped operator: stats per (month, *keys) joined back onto ``df``."""
    return join_back(df, group_trailing_stats(df, keys, target, prefix, periods), [MONTH, *keys])


def group_mean(df: DataFrame, keys: Sequence[str], target: str, name: str) -> DataFrame:
    """Mean of ``target`` per (month, *keys): exact integer sum over count, one division."""
    return (df.filter(complete_key(keys)).groupBy(MONTH, *keys)
              .agg((F.sum(target).cast("double") / F.count(F.lit(1))).alias(name)))


def target_encoding(df: DataFrame, keys: Sequence[str], target: str, name: str,
                    lags: Sequence[int]) -> DataFrame:
    """Group mean joined back, then pair-lagged (R4), the unlagged mean dropped."""
    enc = group_mean(df, keys, target, name)
    j = join_back(df, enc, [MONTH, *keys], bounded=not keys)
    return lag_feature(j, lags, name).drop(name)


# --- price and revenue trends ----------------------------------------------

def product_month_prices(cells: DataFrame, k_max: int) -> DataFrame:
    """Per (product, month): mean price, row count, and both for the ``k_max`` previous months.

    Also the product's mean price over all months (``item_avg_item_price``).
    Windows run over the product-month table (at most one row per month).
    """
    return product_prices(product_month_sums(cells), k_max).drop(*PRODUCT_SUMS)


PRODUCT_SUMS = ("__x", "__ps", "__pc", "__best")


def product_month_sums(cells: DataFrame) -> DataFrame:
    """Per (product, month): sums of the cells.  Cells without a campaign (R8) add to the prices only;
    ``__rows`` counts panel rows and may be 0."""
    inside = complete_key()
    return (cells.filter(complete_key(["product_id", MONTH])).groupBy("product_id", MONTH)
                 .agg(F.coalesce(F.sum(F.when(inside, F.col(TARGET))), F.lit(0)).alias("__x"),
                      F.count(F.when(inside, 1)).alias("__rows"), F.max(F.when(inside, F.col(TARGET))).alias("__best"),
                      F.sum("price_sum").alias("__ps"), F.sum("price_count").alias("__pc")))


def product_prices(sums: DataFrame, k_max: int) -> DataFrame:
    """Month price, overall mean price, and the previous months' prices and row counts, on ``product_month_sums``.

    Months without panel rows count for the overall mean, then leave (a row shift cannot reach them).
    """
    w = month_window(["product_id"])
    pm = sums.withColumns({
        "__pr": ratio(F.col("__ps").cast("double"), F.col("__pc")),
        "item_avg_item_price": ratio(F.sum("__ps").over(Window.partitionBy("product_id")).cast("double"),
                                     F.sum("__pc").over(Window.partitionBy("product_id")))})
    pm = pm.filter(F.col("__rows") > 0)
    cols = {}
    for t in range(1, k_max + 1):
        cols[f"__pr{t}"] = F.lag("__pr", t).over(w)
        cols[f"__rows{t}"] = F.lag("__rows", t).over(w)
    return pm.withColumns(cols)


def price_row_lag(k: int, k_max: int) -> Column:
    """Row lag ``k`` of the month price inside the product, in (month, campaign) order.

    Needs ``__j`` (0-based index of the row inside its (product, month) cell, by
    campaign), ``__pr`` and ``__pr{t}``/``__rows{t}`` for previous months: the
    row ``k`` places back lies in the first previous month ``t`` whose
    cumulative row count reaches ``k - __j``.  Built as one SQL CASE (a single
    call to the JVM instead of one per sub-expression).
    """
    return F.expr(price_row_lag_sql(k, k_max))


def price_row_lag_sql(k: int, k_max: int) -> str:
    whens = [f"WHEN __j >= {k} THEN __pr"]
    cum = []
    for t in range(1, k_max + 1):
        cum.append(f"__rows{t}")
        whens.append(f"WHEN {k} - __j <= {' + '.join(cum)} THEN __pr{t}")
    return "CASE " + " ".join(whens) + " END"


def price_trend_columns(lags: Sequence[int]) -> Column:
    """First non-missing relative price change over lags 1..6, else 0."""
    k_max = max(lags)
    deltas = [f"try_divide(({price_row_lag_sql(k, k_max)}) - item_avg_item_price, item_avg_item_price)"
              for k in lags]
    return F.expr(f"coalesce({', '.join(deltas)}, 0.0D)")


def within_cell_index() -> Column:
    return F.row_number().over(Window.partitionBy("product_id", MONTH).orderBy(F.asc_nulls_last("campaign_id"))) - 1


def create_revenue_features(cells: DataFrame, lags: Sequence[int] = (1, 2, 3, 4, 5, 6)) -> DataFrame:
    """Reference-shaped: add ``delta_price_lag`` to a panel that still carries the cell sums."""
    pm = product_month_prices(cells, max(lags))
    j = join_back(panel_rows(cells), pm, ["product_id", MONTH]).withColumn("__j", within_cell_index())
    out = j.withColumn("delta_price_lag", price_trend_columns(lags))
    return out.drop(*[c for c in pm.columns if c.startswith("__")], "item_avg_item_price", "__j")


def campaign_month_delta(cells: DataFrame) -> DataFrame:
    """Per (month, campaign): ``delta_revenue`` = (month revenue - campaign mean) / campaign mean."""
    cm = (cells.filter(complete_key([MONTH, "campaign_id"])).groupBy(MONTH, "campaign_id")
               .agg(F.coalesce(F.sum("margin_sum"), F.lit(0)).alias("__rev")))
    wall = Window.partitionBy("campaign_id")
    avg = F.sum("__rev").over(wall).cast("double") / F.count(F.lit(1)).over(wall)
    return cm.select(MONTH, "campaign_id",
                     relative_change(F.col("__rev").cast("double"), avg).alias("delta_revenue"))


def create_campaign_revenue_features(cells: DataFrame) -> DataFrame:
    """Reference-shaped: add ``delta_revenue_lag_1`` (pair-grain lag of the campaign delta)."""
    j = join_back(panel_rows(cells), campaign_month_delta(cells), [MONTH, "campaign_id"])
    return lag_feature(j, [1], "delta_revenue").drop("delta_revenue")


# --- recency and tenure ---------------------------------------------------

def last_sale(target: str = TARGET, partition: Sequence[str] = PAIR,
              max_month: int | None = None) -> Column:
    """Latest earlier month with a positive count (absolute month number)."""
    w = month_window(partition).rangeBetween(UNBOUNDED, -1)
    v = F.max(F.when(F.col(target) > 0, F.col(MONTH))).over(w)
    if max_month is not None:
        v = F.when(F.col(MONTH) <= max_month, v)
    return v.cast("int")


def first_sale(partition: Sequence[str] = PAIR) -> Column:
    """Months since the key's first month in the panel (no positive-count filter)."""
    return (F.col(MONTH) - F.min(MONTH).over(Window.partitionBy(*partition))).cast("int")


def product_month_recency(df: DataFrame, target: str = TARGET, max_month: int | None = None) -> DataFrame:
    """Per (product, month): ``item_last_sale`` and ``item_first_sale`` on the product-month table."""
    pm = df.groupBy("product_id", MONTH).agg(F.max(target).alias("__best"))
    return pm.select("product_id", MONTH,
                     last_sale("__best", ["product_id"], max_month).alias("item_last_sale"),
                     first_sale(["product_id"]).alias("item_first_sale"))


def add_sales_features(df: DataFrame, target: str = TARGET, max_month: int | None = None) -> DataFrame:
    """Reference-shaped: last sale (pair, product) and months since first sale (pair, product)."""
    pair = df.withColumns({"item_campaign_last_sale": last_sale(target, PAIR, max_month),
                           "item_campaign_first_sale": first_sale(PAIR)})
    rec = product_month_recency(df, target, max_month)
    out = join_back(pair, rec, ["product_id", MONTH])
    cols = [c for c in df.columns] + ["item_campaign_last_sale", "item_last_sale",
                                      "item_campaign_first_sale", "item_first_sale"]
    return out.select(*cols)


def last_sale_loop(df: DataFrame, months: Sequence[int], keys: Sequence[str], name: str,
                   target: str = TARGET) -> DataFrame:
    """The literal as-of form: one group-by per month, UNION ALL, then a join.

    Kept as the differential reference for ``last_sale``; it scales with the
    number of months, the window form does not.
    """
    from demandcast.operators.panel import union_all
    parts = [df.filter((F.col(MONTH) < m) & (F.col(target) > 0)).groupBy(*keys)
               .agg(F.max(MONTH).alias(name)).withColumn(MONTH, F.lit(m).cast("int"))
             for m in months]
    return df.join(union_all(*parts), [MONTH, *keys], "left")
