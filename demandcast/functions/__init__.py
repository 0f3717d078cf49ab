from demandcast.functions.columns import (  # noqa: F401
    calendar_month, calendar_year, clip, finite_or_null, key_hash_bucket,
    line_profit, month_index, ratio, relative_change, salary_share, target_jitter,
    unit_margin, volume_band,
)
