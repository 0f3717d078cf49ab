"""Parameters of the monthly panel: where month 1 starts, split months, lag lists.

Everything that the pipeline hard-codes is collected here so that the same
operators run on the original calendar (month 1 = January of ``base_year``)
and on the test fixture (``FIXTURE``).
"""

from __future__ import annotations

from dataclasses import dataclass

KEY = ("date_block_num", "campaign_id", "product_id")
PAIR = ("campaign_id", "product_id")
MONTH = "date_block_num"
TARGET = "item_cnt_month"


@dataclass(frozen=True)
class FactSpec:
    base_year: int = 2021
    valid_month: int = 25
    test_month: int = 26
    count_lags: tuple = (1, 2, 3, 6, 12)
    price_lags: tuple = (1, 2, 3, 4, 5, 6)
    # group statistics: (group key, feature prefix, trailing periods)
    group_stats: tuple = (
        (("product_id",), "product", (6, 12)),
        (("campaign_id",), "campaign", (6, 12)),
        (("categories_id",), "category", (12,)),
    )
    # target encodings: (group key besides the month, feature name, lags)
    encodings: tuple = (
        ((), "date_avg_item_cnt", (1,)),
        (("campaign_id",), "date_campaign_avg_item_cnt", (1, 2, 3, 6, 12)),
        (("product_id",), "date_item_avg_item_cnt", (1, 2, 3, 6, 12)),
        (("campaign_id", "categories_id"), "date_campaign_cat_avg_item_cnt", (1,)),
    )
    # columns dropped before cleaning (fixed values of the original pipeline)
    drop_before_clean: tuple = ("item_campaign_last_sale", "item_cnt_month_lag_12",
                                "date_campaign_avg_item_cnt_lag_12", "date_item_avg_item_cnt_lag_12")
    label_columns: tuple = ("name", "short_description", "categories_name")
    # last-sale months are produced up to this month (None = no cap)
    max_month: int | None = None
    # calendar month and year that the notebook carries into its saved table
    calendar: bool = False


# The test fixture: base year 1995, train < 81, valid = 81, test = 82.
FIXTURE = FactSpec(base_year=1995, valid_month=81, test_month=82)
