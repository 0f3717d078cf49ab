"""Column expressions (all native Catalyst expressions, no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def month_index(date, base_year: int) -> Column:
    """1-based month number, January of ``base_year`` = 1."""
    d = _c(date)
    return ((F.year(d) - F.lit(base_year)) * 12 + F.month(d)).cast("int")


def month_start(block: int, base_year: int):
    """First day of month ``block`` (R1 numbering) as a ``datetime.date``."""
    import datetime
    y, m = divmod(block - 1, 12)
    return datetime.date(base_year + y, m + 1, 1)


def month_range(date, base_year: int, lo: int, hi: int) -> Column:
    """``lo <= month_index(date) <= hi`` written on the raw date column.

    Unlike a predicate on the derived month number this is a plain range on a
    scan column, so Parquet row groups and partitions outside it are skipped
    (``PushedFilters``).
    """
    d = _c(date)
    return (d >= F.lit(month_start(lo, base_year))) & (d < F.lit(month_start(hi + 1, base_year)))


def unit_margin(price="price", purchase_price="purchase_price") -> Column:
    """Per-line unit margin ``price - purchase_price`` (exact DECIMAL)."""
    return _c(price) - _c(purchase_price)


def line_profit(margin, orders="orders") -> Column:
    """Line profit = unit margin x ordered quantity."""
    return _c(margin) * _c(orders)


def calendar_month(block="date_block_num") -> Column:
    """``block % 12`` (so December maps to 0)."""
    return F.pmod(_c(block), F.lit(12)).cast("int")


def calendar_year(block="date_block_num") -> Column:
    """``int(block / 12)`` (December counts into the next year)."""
    return (_c(block) / F.lit(12)).cast("int")


def clip(x, lo, hi) -> Column:
    return F.least(F.greatest(_c(x), F.lit(lo)), F.lit(hi))


def ratio(num, den) -> Column:
    """Division that yields NULL instead of raising on a zero divisor."""
    return F.try_divide(_c(num), _c(den))


def relative_change(value, base) -> Column:
    """``(value - base) / base``; NULL when ``base`` is 0 or missing."""
    return F.try_divide(_c(value) - _c(base), _c(base))


def finite_or_null(x) -> Column:
    """+/-inf and NaN -> NULL, everything else unchanged."""
    c = _c(x)
    return F.when(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), F.lit(None)).otherwise(c)


# Fixed values of the pay-tier rule: count thresholds and profit shares.
SALARY_TIERS = ((100, 0.5), (200, 0.52), (500, 0.55))
SALARY_TOP_SHARE = 0.6


def salary_share(count="item_cnt_month", profit="profit_month") -> Column:
    """Pay tier: a share of the month's profit chosen by the month's count."""
    cnt, prof = _c(count), _c(profit)
    expr = None
    for bound, share in SALARY_TIERS:
        cond = cnt < F.lit(bound)
        val = prof * F.lit(share).cast("decimal(4,2)")
        expr = F.when(cond, val) if expr is None else expr.when(cond, val)
    return expr.otherwise(prof * F.lit(SALARY_TOP_SHARE).cast("decimal(4,2)"))


# Fixed values of the volume bands: product counts below 100, 100..499, 500+.
VOLUME_BANDS = ((100, "lt_100"), (500, "100_to_500"))
VOLUME_TOP = "ge_500"


def volume_band(total) -> Column:
    c = _c(total)
    expr = None
    for bound, label in VOLUME_BANDS:
        expr = F.when(c < bound, F.lit(label)) if expr is None else expr.when(c < bound, F.lit(label))
    return expr.otherwise(F.lit(VOLUME_TOP))


def key_hash_bucket(cols, buckets: int) -> Column:
    """Stable bucket of a row key: first 32 bits of md5 of the '|'-joined key, mod ``buckets``.

    Independent of partitioning and row order (unlike ``rand``), and equal to
    ``('0x'||substr(md5(k),1,8))::UBIGINT % buckets`` in DuckDB.
    """
    key = F.concat_ws("|", *[_c(c).cast("string") for c in cols])
    return F.pmod(F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint"), F.lit(buckets)).cast("int")


def target_jitter(cols, value, low: int = -15, high: int = 21) -> Column:
    """``value + offset`` with offset in [low, high) chosen by a keyed hash (seedless rand)."""
    return _c(value) + key_hash_bucket(cols, high - low) + F.lit(low)
