"""Classical multiplicative seasonal decomposition of many monthly series at once.

Per series (``series_keys``), observations in month order:

* trend: centred moving average of ``period`` observations (odd period), or
  of ``period + 1`` with half-weight end terms (even period); missing where the
  window runs off either end;
* seasonal: mean of ``observed / trend`` per phase (position modulo period),
  rescaled so the phase means average to 1, repeated along the series;
* residual: ``observed / seasonal / trend``.

Positions ignore calendar gaps (the observations are taken as consecutive).
Guards: a series needs at least two full periods and only positive
observations; otherwise its trend, seasonal and residual are NULL (the rows
are kept).  Every window is partitioned by the series key; the phase table
has ``period`` rows per series.  A single global series is one partition: it has
one row per month of the calendar.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandcast.spec import MONTH


def decompose(series: DataFrame, value: str, series_keys: Sequence[str] = (), period: int = 7,
              order: str = MONTH) -> DataFrame:
    keys = list(series_keys)
    if not keys:  # one global series: give it a constant key so windows stay partitioned
        series = series.withColumn("__series", F.lit(0))
        keys = ["__series"]
    w = Window.partitionBy(*keys).orderBy(order)
    whole = Window.partitionBy(*keys)
    h = period // 2
    x = F.col(value).cast("double")
    base = series.select(*keys, order, x.alias("observed"),
                         (F.row_number().over(w) - 1).alias("__pos"),
                         F.count(F.lit(1)).over(whole).alias("__nobs"),
                         F.min(x).over(whole).alias("__min"))
    if period % 2:
        frame = w.rowsBetween(-h, h)
        trend = F.when(F.count("observed").over(frame) == period, F.avg("observed").over(frame))
    else:
        frame = w.rowsBetween(-h, h)
        s = F.sum("observed").over(frame)
        ends = F.lag("observed", h).over(w) + F.lead("observed", h).over(w)
        trend = F.when(F.count("observed").over(frame) == period + 1,
                       (s - F.lit(0.5) * ends) / F.lit(period))
    ok = (F.col("__nobs") >= 2 * period) & (F.col("__min") > 0)
    t = base.withColumns({"trend": F.when(ok, trend), "__phase": F.pmod(F.col("__pos"), F.lit(period))})
    phase = (t.filter(F.col("trend").isNotNull())
              .groupBy(*keys, "__phase").agg(F.avg(F.col("observed") / F.col("trend")).alias("__pm")))
    phase = phase.withColumn("__seasonal", F.col("__pm") / F.avg("__pm").over(Window.partitionBy(*keys)))
    out = (t.join(phase.select(*keys, "__phase", "__seasonal"), [*keys, "__phase"], "left")
            .withColumn("seasonal", F.when(ok, F.col("__seasonal")))
            .withColumn("resid", F.try_divide(F.try_divide(F.col("observed"), F.col("seasonal")), F.col("trend"))))
    cols = [k for k in keys if k != "__series"]
    return out.select(*cols, order, "observed", "trend", "seasonal", "resid")
