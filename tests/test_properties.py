"""Properties of the panel and feature table; plan shape."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from demandcast.plans.features import feature_matrix
from demandcast.plans.registry import rounded
from demandcast.sources import testdata as TD
from demandcast.spec import FIXTURE, KEY, TARGET

from conftest import SF_SMALL


def test_feature_rows_equal_matrix_rows_and_key_unique(spark):
    q = E.queries()
    fm = q["feature_matrix"](spark, SF_SMALL)
    m = q["build_matrix"](spark, SF_SMALL)
    assert fm.count() == m.count() == fm.select(*KEY).distinct().count()


def test_counts_are_conserved(spark):
    lines = TD.fact(spark, SF_SMALL)
    m = E.queries()["build_matrix"](spark, SF_SMALL)
    assert lines.agg(F.sum("orders")).first()[0] == m.agg(F.sum(TARGET)).first()[0]


def test_normalised_stats_average_to_one(spark):
    fm = E.queries()["normalise_by_mean"](spark, SF_SMALL)
    assert abs(fm.agg(F.avg("category_avg_sale_last_12")).first()[0] - 1) < 1e-9


def test_no_missing_after_imputation(spark):
    clean = E.queries()["mean_impute"](spark, SF_SMALL)
    feats = [c for c in clean.columns if c not in KEY and c != TARGET]
    nulls = clean.agg(*[F.sum(F.when(F.col(c).isNull() | F.isnan(c), 1).otherwise(0)).alias(c) for c in feats]).first()
    assert all(v == 0 for v in nulls.asDict().values())


def test_result_independent_of_partitioning(spark):
    lines, items = TD.inputs(spark, SF_SMALL)
    a = rounded(feature_matrix(lines, items, FIXTURE))
    b = rounded(feature_matrix(lines.repartition(3), items.repartition(2), FIXTURE))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_row_positions_dense_and_ordered(spark):
    r = E.queries()["row_position"](spark, SF_SMALL)
    n = r.count()
    ids = [x[0] for x in r.orderBy(*KEY).select("ID").collect()]
    assert ids == list(range(n))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plan_one_pair_exchange_no_udf_no_single_partition_over_panel(spark):
    fm = E.queries()["feature_matrix"](spark, SF_SMALL)
    plan = _plan(fm)
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    pair_exchanges = [ln for ln in plan.splitlines()
                      if "Exchange hashpartitioning(campaign_id" in ln and "product_id" in ln
                      and "date_block_num" not in ln]
    assert len(pair_exchanges) == 1, pair_exchanges
    # and it carries numbers only: the item's strings are joined after it
    window = plan.splitlines().index(pair_exchanges[0])
    assert not any("short_description" in ln for ln in plan.splitlines()[window:window + 3])
    # the only single-partition exchanges are the 1-row normaliser aggregates
    for ln in plan.splitlines():
        if "Exchange SinglePartition" in ln:
            assert "Window" not in ln


def test_report_scan_reads_only_needed_months(spark):
    from demandcast.plans.registry import report_rows
    plan = report_rows(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    scan = [ln for ln in plan.splitlines() if "FileScan parquet" in ln and "l_shipdate" in ln][0]
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate" in scan


def test_shuffle_join_path_equals_broadcast_path(spark):
    # with the broadcast threshold off, every size-checked join takes the shuffle-join path
    lines, items = TD.inputs(spark, SF_SMALL)
    a = [tuple(r) for r in rounded(feature_matrix(lines, items, FIXTURE)).collect()]
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fm = feature_matrix(lines, items, FIXTURE)
        plan = _plan(fm)
        assert "SortMergeJoin" in plan
        b = [tuple(r) for r in rounded(fm).collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert sorted(map(repr, a)) == sorted(map(repr, b))


@pytest.mark.parametrize("name", [
    "last_sale_item", "first_sale_item", "asof_last_sale", "delta_price_lag", "price_lag_rows", "delta_revenue_lag",
    "join_group_features", "pnl_total", "attach_forecast", "coalesce_trend", "union_all", "group_trailing_avg",
    "target_encoding", "zero_fill"])
def test_standalone_keys_scan_the_lines_once(spark, name, monkeypatch):
    from demandcast.operators import panel
    scans = []
    real = panel.materialize

    def counted(df, how="checkpoint"):
        scans.append(len(re.findall(r"lineitem[.]parquet", _plan(df))))
        return real(df, how)
    monkeypatch.setattr(panel, "materialize", counted)
    out = E.queries()[name](spark, SF_SMALL)
    assert sum(scans) + len(re.findall(r"lineitem[.]parquet", _plan(out))) == 1
