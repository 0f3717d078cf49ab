"""Forecast reporting: forecast vs actual, pay tiers, volume bands, campaign P&L,
error metrics and two-forecast blends.

Blends are computed from sufficient statistics (one aggregate over the rows),
never by multiplying the rows by the grid of weights:

* weighted average ``a*p1 + (1-a)*p2``: SSE(a) = Sdd - 2a Sde + a^2 See with
  d = y - p2, e = p1 - p2, evaluated on the (parameter-sized) weight grid;
* OLS ``y ~ 1 + p1 + p2``: the 3x3 normal equations from nine sums, solved in
  closed form (Cramer's rule).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandcast.functions.columns import salary_share, target_jitter, volume_band
from demandcast.operators.panel import attach_scalar, join_back
from demandcast.spec import KEY, PAIR, TARGET

FORECAST = "item_cnt_month_forecast"


# --- SQL-expressible forecasters (baselines, and stand-ins for the oracle) ---

def lag1_forecast(features: DataFrame) -> Column:
    """Forecast = last month's count for the pair (0 when the pair did not exist)."""
    return F.coalesce(F.col(f"{TARGET}_lag_1"), F.lit(0)).cast("double")


def trailing_mean_forecast(features: DataFrame, months: int = 6) -> Column:
    """Forecast = zero-filled mean count of the pair over the previous ``months`` months."""
    from demandcast.operators.temporal import month_window
    w = month_window(PAIR).rangeBetween(-months, -1)
    return F.coalesce(F.sum(TARGET).over(w), F.lit(0)).cast("double") / F.lit(months)


def attach_forecast(rows: DataFrame, forecasts: DataFrame, name: str = FORECAST,
                    value: str = "prediction") -> DataFrame:
    """Forecast put on the rows by natural key (not by position)."""
    return join_back(rows, forecasts.select(*KEY, F.col(value).alias(name)), list(KEY))


def forecast_vs_actual(rows: DataFrame, forecast: str = FORECAST) -> DataFrame:
    """Rows with forecast, actual and a jittered target (D12: keyed-hash offset in [-15, 21))."""
    return rows.select(*KEY, F.col(forecast), F.col(TARGET),
                       target_jitter(list(KEY), TARGET).alias("target"))


def with_salary(rows: DataFrame) -> DataFrame:
    """Pay tier per row: a share of ``profit_month`` chosen by ``item_cnt_month`` (no UDF)."""
    return rows.withColumn("salary", salary_share(TARGET, "profit_month"))


def filter_campaign(rows: DataFrame, campaign_id: int) -> DataFrame:
    return rows.filter(F.col("campaign_id") == campaign_id)


def volume_bands(product_totals: DataFrame, total: str = "order_ctn_month") -> DataFrame:
    return product_totals.withColumn("volume_band", volume_band(total))


def negative_profit(net: DataFrame, col: str = "profit_month") -> DataFrame:
    return net.filter(F.col(col) < 0)


# --- metrics and blends ---------------------------------------------------------

def rmse(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """sqrt(mean((y - y_hat)^2)), optionally per group."""
    err = F.col(label).cast("double") - F.col(prediction).cast("double")
    agg = F.sqrt(F.avg(err * err)).alias("rmse")
    return df.groupBy(*by).agg(agg) if by else df.agg(agg)


def blend_alpha(df: DataFrame, label: str, p1: str, p2: str, step: float = 0.02,
                steps: int = 50) -> DataFrame:
    """Best ``a`` in ``0, step, ..., (steps-1)*step`` for ``a*p1 + (1-a)*p2`` by RMSE.

    Ties keep the smallest ``a`` (strict improvement only, as a scan in
    increasing order does).  One aggregate over the rows + a ``steps``-row grid.
    """
    y, a, b = (F.col(c).cast("double") for c in (label, p1, p2))
    d, e = y - b, a - b
    stats = df.agg(F.sum(d * d).alias("__sdd"), F.sum(d * e).alias("__sde"),
                   F.sum(e * e).alias("__see"), F.count(F.lit(1)).alias("__n"))
    grid = df.sparkSession.range(steps).select((F.col("id") * F.lit(step)).alias("alpha"))
    al = F.col("alpha")
    sse = F.col("__sdd") - F.lit(2.0) * al * F.col("__sde") + al * al * F.col("__see")
    scored = attach_scalar(grid, stats).select(
        "alpha", F.sqrt(F.greatest(sse, F.lit(0.0)) / F.col("__n")).alias("rmse"))
    return scored.orderBy(F.col("rmse"), F.col("alpha")).limit(1)


def ols_two(df: DataFrame, label: str, p1: str, p2: str) -> DataFrame:
    """Closed-form OLS of ``label`` on (1, p1, p2) from nine sums: intercept, coef_1, coef_2."""
    y, a, b = (F.col(c).cast("double") for c in (label, p1, p2))
    s = df.agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum(a).alias("sa"), F.sum(b).alias("sb"),
               F.sum(y).alias("sy"), F.sum(a * a).alias("saa"), F.sum(a * b).alias("sab"),
               F.sum(b * b).alias("sbb"), F.sum(a * y).alias("say"), F.sum(b * y).alias("sby"))
    c = F.col

    def det3(m):
        return (m[0][0] * (m[1][1] * m[2][2] - m[1][2] * m[2][1])
                - m[0][1] * (m[1][0] * m[2][2] - m[1][2] * m[2][0])
                + m[0][2] * (m[1][0] * m[2][1] - m[1][1] * m[2][0]))

    A = [[c("n"), c("sa"), c("sb")], [c("sa"), c("saa"), c("sab")], [c("sb"), c("sab"), c("sbb")]]
    r = [c("sy"), c("say"), c("sby")]
    det = det3(A)
    sol = []
    for k in range(3):
        M = [[r[i] if j == k else A[i][j] for j in range(3)] for i in range(3)]
        sol.append(F.try_divide(det3(M), det))
    return s.select(sol[0].alias("intercept"), sol[1].alias("coef_1"), sol[2].alias("coef_2"))


def apply_blend(df: DataFrame, weight: DataFrame, p1: str, p2: str, name: str = FORECAST) -> DataFrame:
    """``alpha * p1 + (1 - alpha) * p2`` with the one-row result of ``blend_alpha``."""
    j = attach_scalar(df, weight.select(F.col("alpha").alias("__a")))
    return j.withColumn(name, F.col("__a") * F.col(p1) + (F.lit(1) - F.col("__a")) * F.col(p2)).drop("__a")


def apply_ols(df: DataFrame, fit: DataFrame, p1: str, p2: str, name: str = FORECAST) -> DataFrame:
    """``intercept + coef_1 * p1 + coef_2 * p2`` with the one-row result of ``ols_two``."""
    j = attach_scalar(df, fit.select(*[F.col(c).alias(f"__{c}") for c in ("intercept", "coef_1", "coef_2")]))
    return (j.withColumn(name, F.col("__intercept") + F.col("__coef_1") * F.col(p1) + F.col("__coef_2") * F.col(p2))
             .drop("__intercept", "__coef_1", "__coef_2"))
