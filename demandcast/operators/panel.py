"""The monthly panel: roll order lines up to (month, campaign, product) and the
aggregations, joins and rollups around it.

Scale notes
-----------
* ``build_cells`` is the only operator that touches the raw order lines in the
  feature chain.  It is one ``groupBy`` with partial (map-side) aggregation, so
  a hot key is combined inside every map task before the shuffle and no task
  ever sees more than one row per key per map task.  Besides the two reference
  measures it keeps the sums every later per-line statistic needs (price sum,
  price count, margin sum): mean prices and campaign revenues are then derived
  from the cells and the raw table is scanned once.
* Money is summed as DECIMAL (exact, order independent) and only turned into
  DOUBLE for ratios.
* Aggregates joined back onto the panel go through ``join_back``: only sides
  whose row count has a proven bound (one row per month) get an explicit
  broadcast; everything else is a plain join that AQE turns into a broadcast
  when the measured size is under the threshold and otherwise shuffles with
  skew splitting.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandcast.functions.columns import clip, line_profit, unit_margin
from demandcast.sources.readers import assert_unique
from demandcast.spec import KEY, MONTH, TARGET

CELL_SUMS = ("price_sum", "price_count", "margin_sum")


def with_margins(lines: DataFrame) -> DataFrame:
    """``revenue`` (unit margin) and ``profit`` (= margin x orders) columns."""
    margin = unit_margin("price", "purchase_price")
    return lines.withColumns({"revenue": margin, "profit": line_profit(margin, "orders")})


def complete_key(keys: Sequence[str] = KEY):
    """A row whose key has a missing part belongs to no group."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond


def panel_rows(cells: DataFrame) -> DataFrame:
    """The cells that are rows of the monthly panel: those with a complete key."""
    return cells.filter(complete_key())


def build_cells(lines: DataFrame, null_keys: bool = False) -> DataFrame:
    """One row per (month, campaign, product): the reference measures plus the sums
    later features are derived from.  ``item_cnt_month`` is BIGINT, money DECIMAL.

    Lines with a missing key part are no panel rows (R8).  ``null_keys`` keeps them as cells of
    their own: their prices still count for the product's means and their margins for the
    campaign's revenue, which are grouped by one key only.
    """
    margin = unit_margin("price", "purchase_price")
    src = lines if null_keys else lines.filter(complete_key())
    zero = F.lit(0)
    return (src.groupBy(*KEY)
               .agg(F.coalesce(F.sum("orders"), zero).cast("bigint").alias(TARGET),
                    F.coalesce(F.sum(line_profit(margin, "orders")), zero).alias("profit_month"),
                    F.sum("price").alias("price_sum"),
                    F.count("price").alias("price_count"),
                    F.coalesce(F.sum(margin), zero).alias("margin_sum"))
               .select(F.col(MONTH).cast("int"), F.col("campaign_id").cast("int"),
                       F.col("product_id").cast("int"), TARGET, "profit_month", *CELL_SUMS))


_WRITTEN: list[str] = []
_CACHED: list[DataFrame] = []


def release(spark, paths: Sequence[str] | None = None) -> None:
    """Delete materialised tables (all, or only ``paths``) and drop cached group tables.

    For callers whose results have been written: nothing that still reads the tables may follow.
    """
    for path in list(paths if paths is not None else _WRITTEN):
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
        if path in _WRITTEN:
            _WRITTEN.remove(path)
    while _CACHED:
        _CACHED.pop().unpersist()


def written_tables() -> list[str]:
    return list(_WRITTEN)


def cached(df: DataFrame) -> DataFrame:
    """A small group table kept for its two readers; recomputed if lost, dropped by ``release``."""
    from pyspark import StorageLevel
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    _CACHED.append(df)
    return df


def materialize(df: DataFrame, how: str = "checkpoint") -> DataFrame:
    """Compute ``df`` once for several consumers.

    ``parquet`` writes a Parquet table in the shared folder and reads it back:
    columnar, so every consumer reads only the columns it needs (best for a
    wide table read by many consumers).
    ``checkpoint`` (default) writes it to the shared folder named by
    ``spark.checkpoint.dir`` and cuts the lineage, so a lost executor costs a
    re-read, not a re-scan of the raw lines; the recorded output partitioning
    is kept.  ``persist`` keeps it in executor memory/disk (recomputed from
    lineage on loss).  Without one of them Catalyst prunes a different column
    set out of the aggregate for every consumer and the raw table is scanned
    once per consumer.
    """
    if how == "checkpoint":
        from demandcast.session import ensure_checkpoint_dir
        ensure_checkpoint_dir(df.sparkSession)
        return df.checkpoint(eager=True)
    if how == "parquet":
        import uuid
        from demandcast.session import shared_path
        path = shared_path(df.sparkSession, f"table-{uuid.uuid4().hex[:12]}")
        df.write.mode("overwrite").parquet(path)
        _WRITTEN.append(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)
    if how == "persist":
        return cached(df)
    return df


def join_items(matrix: DataFrame, items: DataFrame) -> DataFrame:
    """matrix LEFT JOIN items ON product_id = id, ``id`` dropped.  A repeated id is an error."""
    assert_unique(items, "id")
    it = items.withColumnRenamed("id", "__item_id")
    return (matrix.join(it, matrix["product_id"] == it["__item_id"], "left")
                  .drop("__item_id"))


def build_matrix(lines: DataFrame, items: DataFrame | None = None, keep_sums: bool = False) -> DataFrame:
    """The monthly fact table: (month, campaign, product, item_cnt_month, profit_month) + item columns."""
    cells = build_cells(lines)
    if not keep_sums:
        cells = cells.drop(*CELL_SUMS)
    return join_items(cells, items) if items is not None else cells


def join_back(df: DataFrame, agg: DataFrame, keys: Sequence[str], bounded: bool = False) -> DataFrame:
    """LEFT JOIN an aggregate back onto ``df`` on its group keys.

    ``bounded=True`` only for aggregates with a proven small row count (one row
    per calendar month, one row in total): those are broadcast explicitly.
    """
    return df.join(F.broadcast(agg) if bounded else agg, list(keys), "left")


def broadcast_budget_rows(agg: DataFrame) -> int:
    """Rows of ``agg`` that fit the session's broadcast threshold (conservative width estimate)."""
    spark = agg.sparkSession
    conf = str(spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760"))
    limit = -1 if conf.startswith("-") else spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(conf)
    width = 0
    for f in agg.schema.fields:
        width += 32 if f.dataType.typeName() == "string" else 16
    return max(limit, 0) // max(width, 1)


def join_back_checked(df: DataFrame, agg: DataFrame, keys: Sequence[str]) -> DataFrame:
    """LEFT JOIN with a broadcast chosen by a measured size, a shuffle join beyond it.

    The aggregate is persisted and counted (one small job on an already
    aggregated table); it is broadcast only when its exact row count times a
    conservative row width is under ``spark.sql.autoBroadcastJoinThreshold``.
    Beyond that the join is a shuffle join on the keys (AQE splits skewed
    partitions).  This keeps the large side from being shuffled just because
    the planner over-estimates an aggregate's output.
    """
    agg = cached(agg)
    small = agg.count() <= broadcast_budget_rows(agg)
    return df.join(F.broadcast(agg) if small else agg, list(keys), "left")


def group_row_estimates(df: DataFrame, groupings: dict, rsd: float = 0.02) -> dict:
    """Estimated row counts of several group-by results of ``df`` in ONE job.

    ``groupings`` maps a name to its key columns; each estimate is an
    ``approx_count_distinct`` (HyperLogLog, relative error ``rsd``) of the key
    tuple, so the size checks of many joins cost one pass over ``df``.
    """
    return df.agg(*size_metrics(groupings, rsd)).first().asDict()


def size_metrics(groupings: dict, rsd: float = 0.02) -> list:
    """``approx_count_distinct`` of each key tuple, usable in ``agg`` or ``observe``."""
    return [F.approx_count_distinct(F.struct(*keys), rsd).alias(name) for name, keys in groupings.items()]


def materialize_with_sizes(df: DataFrame, groupings: dict, how: str = "checkpoint") -> tuple[DataFrame, dict]:
    """Materialise ``df`` and estimate the row counts of its group-bys.

    With ``checkpoint`` the estimates are observed metrics of the checkpoint
    job itself (``DataFrame.observe``): no extra pass.  Otherwise one
    aggregate job over the materialised frame.
    """
    if how in ("checkpoint", "parquet"):
        from pyspark.sql import Observation
        obs = Observation("group_sizes")
        out = materialize(df.observe(obs, *size_metrics(groupings)), how)
        return out, dict(obs.get)
    out = materialize(df, how)
    return out, group_row_estimates(out, groupings)


def join_back_sized(df: DataFrame, agg: DataFrame, keys: Sequence[str], est_rows: int,
                    margin: float = 1.25) -> DataFrame:
    """LEFT JOIN, broadcasting ``agg`` only when ``est_rows`` (with a margin for the
    estimate's error) fits the broadcast threshold; a shuffle join otherwise."""
    small = est_rows * margin <= broadcast_budget_rows(agg)
    return df.join(F.broadcast(agg) if small else agg, list(keys), "left")


def attach_scalar(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Cross join with a 1-row aggregate (size proven: exactly one row)."""
    return df.crossJoin(F.broadcast(one_row))


# --- aggregations ---------------------------------------------------------

def orders_by_month(lines: DataFrame) -> DataFrame:
    return (lines.filter(complete_key([MONTH])).groupBy(MONTH)
                 .agg(F.coalesce(F.sum("orders"), F.lit(0)).cast("bigint").alias("orders")))


def block_item_sales(lines: DataFrame) -> DataFrame:
    return (lines.filter(complete_key()).groupBy(MONTH, "product_id", "campaign_id")
                 .agg(F.coalesce(F.sum("orders"), F.lit(0)).cast("bigint").alias("orders")))


def sales_histogram(sales: DataFrame, col: str = "orders", bins: int = 20,
                    lo: float = 0, hi: float = 20) -> DataFrame:
    """Equal-width histogram of ``clip(col, lo, hi)`` over the data range (last bin closed).

    Bin edges follow the usual convention: ``bins`` equal bins between the
    minimum and maximum of the clipped data (``+-0.5`` when they are equal).
    Empty bins are reported with count 0.
    """
    v = sales.select(clip(col, lo, hi).cast("double").alias("v"))
    rng = v.agg(F.min("v").alias("mn"), F.max("v").alias("mx")).select(
        F.when(F.col("mn") == F.col("mx"), F.col("mn") - 0.5).otherwise(F.col("mn")).alias("mn"),
        F.when(F.col("mn") == F.col("mx"), F.col("mx") + 0.5).otherwise(F.col("mx")).alias("mx"))
    b = F.least(F.lit(bins - 1),
                F.floor((F.col("v") - F.col("mn")) * F.lit(bins) / (F.col("mx") - F.col("mn")))).cast("int")
    counts = attach_scalar(v, rng).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    grid = v.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    edges = attach_scalar(grid, rng).select(
        "bin",
        (F.col("mn") + (F.col("mx") - F.col("mn")) * F.col("bin") / F.lit(bins)).alias("bin_lo"),
        (F.col("mn") + (F.col("mx") - F.col("mn")) * (F.col("bin") + 1) / F.lit(bins)).alias("bin_hi"))
    return (edges.join(F.broadcast(counts), "bin", "left")
                 .select("bin", "bin_lo", "bin_hi", F.coalesce("count", F.lit(0)).alias("count")))


def _mean_from(df: DataFrame, value: str, keys: Sequence[str], alias: str) -> DataFrame:
    """Mean of a per-line DECIMAL value, from raw lines or from cells (exact sums, one division)."""
    if f"{value}_sum" in df.columns:
        s, n = F.sum(f"{value}_sum"), F.sum(f"{value}_count")
    else:
        s, n = F.sum(value), F.count(value)
    return df.filter(complete_key(keys)).groupBy(*keys).agg(F.try_divide(s.cast("double"), n).alias(alias))


def item_mean_price(df: DataFrame) -> DataFrame:
    """Mean line price per product over all months."""
    return _mean_from(df, "price", ["product_id"], "item_avg_item_price")


def month_item_mean_price(df: DataFrame) -> DataFrame:
    """Mean line price per (month, product)."""
    return _mean_from(df, "price", [MONTH, "product_id"], "date_item_avg_item_price")


def campaign_month_revenue(df: DataFrame) -> DataFrame:
    """Sum of the per-line unit margin per (month, campaign) (DECIMAL)."""
    v = F.col("margin_sum") if "margin_sum" in df.columns else unit_margin("price", "purchase_price")
    return (df.filter(complete_key([MONTH, "campaign_id"])).groupBy(MONTH, "campaign_id")
              .agg(F.coalesce(F.sum(v), F.lit(0)).alias("date_campaign_revenue")))


def campaign_mean_revenue(month_revenue: DataFrame) -> DataFrame:
    """Mean over months of the campaign's monthly revenue (aggregate of an aggregate)."""
    return (month_revenue.groupBy("campaign_id")
                         .agg((F.sum("date_campaign_revenue").cast("double") / F.count(F.lit(1)))
                              .alias("campaign_avg_revenue")))


def product_rollup(rows: DataFrame, value: str = TARGET, alias: str = "order_ctn_month") -> DataFrame:
    return (rows.filter(complete_key(["product_id"])).groupBy("product_id")
                .agg(F.coalesce(F.sum(value), F.lit(0)).cast("bigint").alias(alias)))


def campaign_rollup(rows: DataFrame) -> DataFrame:
    """Sum of profit and pay per campaign (DECIMAL sums)."""
    zero = F.lit(0)
    return (rows.filter(complete_key(["campaign_id"])).groupBy("campaign_id")
                .agg(F.coalesce(F.sum("profit_month"), zero).alias("profit_month_sum"),
                     F.coalesce(F.sum("salary"), zero).alias("salary_month_sum")))


def total(df: DataFrame, value: str, alias: str) -> DataFrame:
    return df.agg(F.sum(value).alias(alias))


def campaign_net_profit(marketing: DataFrame, rollup: DataFrame, days: int = 29) -> DataFrame:
    """marketing LEFT JOIN campaign rollup; net profit = profit sum - days x daily marketing cost."""
    j = marketing.join(rollup, marketing["ID"] == rollup["campaign_id"], "left").drop("ID")
    return (j.withColumn("profit_month",
                         F.col("profit_month_sum").cast("double") - F.lit(days) * F.col("Marketing_Cost_Day"))
             .drop("profit_month_sum"))


def pnl_total(net: DataFrame, costs: DataFrame, total_orders: DataFrame,
              per_order_cost: int = 1000, cost_col: str = "cost") -> DataFrame:
    """Sum(net profit) - Sum(expenses) - per_order_cost x orders - Sum(salary): four 1-row aggregates.

    An empty or all-missing part counts as 0 (R9).
    """
    def whole(col):
        return F.coalesce(F.sum(col).cast("double"), F.lit(0.0))
    a = net.agg(whole("profit_month").alias("p"), whole("salary_month_sum").alias("s"))
    b = costs.agg(whole(cost_col).alias("e"))
    c = total_orders.select(F.coalesce(F.col(total_orders.columns[0]).cast("double"), F.lit(0.0)).alias("o"))
    return (a.crossJoin(b).crossJoin(c)
             .select((F.col("p") - F.col("e") - F.lit(per_order_cost) * F.col("o") - F.col("s"))
                     .alias("total_profit")))


def union_all(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def sort_matrix(df: DataFrame) -> DataFrame:
    """Global order by the natural key (range-partitioned sort; only at sinks)."""
    return df.orderBy(*KEY)


def head(df: DataFrame, n: int = 5, order: Sequence[str] = KEY) -> DataFrame:
    """First ``n`` rows in key order (TakeOrderedAndProject: a top-k per task, then merge)."""
    return df.orderBy(*order).limit(n)
