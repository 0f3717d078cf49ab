"""Model fitting: rows, finite predictions, reproducibility, better than the mean."""

import math
import os

import pytest
from pyspark.sql import functions as F

from demandcast.operators import learn as L
from demandcast.operators.panel import written_tables
from demandcast.plans import forecast as FC
from demandcast.sources import testdata as TD
from demandcast.spec import FIXTURE, KEY, MONTH

from conftest import SF_SMALL


def test_folds_stable_under_repartition(spark):
    df = TD.fact(spark, SF_SMALL).select(*KEY).distinct()
    a = L.with_folds(df)
    b = L.with_folds(df.repartition(7))
    assert a.exceptAll(b).count() == 0
    sizes = [r[1] for r in a.groupBy("fold").count().collect()]
    assert len(sizes) == 5 and min(sizes) > 0


@pytest.fixture(scope="module")
def prep(spark):
    return FC.prepared_table(*TD.inputs(spark, SF_SMALL), FIXTURE)


def test_stacked_forecast_end_to_end(spark, prep):
    small = {"max_depth": 3, "n_estimators": 3}
    l2 = FC.base_predictions(prep, FIXTURE, small, small, k=3, parallelism=2)
    fc = FC.stacked_forecast(prep, FIXTURE, l2, {"max_depth": 2, "n_estimators": 5, "learning_rate": 0.1})
    rows = fc.final.collect()
    n_expected = prep.filter(F.col(MONTH).isin(FIXTURE.valid_month, FIXTURE.test_month)).count()
    assert len(rows) == n_expected > 0
    assert all(math.isfinite(r["item_cnt_month_forecast"]) for r in rows)
    assert fc.rmse_valid_in_sample < fc.rmse_mean_baseline
    again = FC.stacked_forecast(prep, FIXTURE, l2, {"max_depth": 2, "n_estimators": 5, "learning_rate": 0.1})
    assert math.isclose(again.rmse_valid_in_sample, fc.rmse_valid_in_sample)


def test_prepared_table_keeps_no_panel_tables_and_reads_one_month(spark, prep):
    assert not [p for p in written_tables() if not os.path.isdir(p.replace("file:", ""))]
    plan = prep.filter(F.col(MONTH) == 81)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date_block_num" in plan


def test_fits_get_no_more_partitions_than_their_rows_fill(prep, monkeypatch):
    train = prep.filter(F.col(MONTH) < FIXTURE.valid_month)
    rows, scattered = train.count(), prep.repartition(90)
    monkeypatch.setattr(L, "LEAST_PARTS", 2)
    monkeypatch.setattr(L, "TREE_ROWS", -(-rows // 5))
    assert L.full_parts(train.coalesce(1)).rdd.getNumPartitions() == 1          # never more than before
    assert L.full_parts(train.repartition(90)).count() == rows
    seen, booster = [], L.booster
    monkeypatch.setattr(L, "booster", lambda params, data, *a: (seen.append(data.rdd.getNumPartitions()),
                                                                booster(params, data, *a))[1])
    small = {"max_depth": 1, "n_estimators": 1}
    L.kfold_models(scattered, small, FIXTURE, k=2)
    L.fit_predict(scattered, small, FIXTURE)
    L.cv_search(scattered, {"max_depth": [1], "n_estimators": [1]}, FIXTURE, trials=1, k=2)
    assert seen == [5] * 5
    level2 = prep.select(*KEY, L.TARGET, F.lit(1.0).alias("lgb"), F.lit(2.0).alias("xgb")).repartition(90)
    L.stack_meta(level2, ["lgb", "xgb"], FIXTURE, small)
    assert seen[5] == 2


def test_best_iteration_by_patience():
    assert L.best_iteration([5, 4, 3, 3.5, 2], 100) == 5
    assert L.best_iteration([5, 4, 3, 3.5, 3.6, 2], 2) == 3      # two rounds without improvement: stop
    assert L.best_iteration([5], 1) == 1


def test_fit_keeps_the_asked_trees_or_the_best_iteration(prep):
    train = prep.filter(F.col(MONTH) < FIXTURE.valid_month)
    data, held = train.filter("fold <> 0"), train.filter("fold = 0")
    params = L.without_unmapped(L.BOOSTER_A_FIXED)
    model, errors = L.fit_with_patience(params, data, held, L.PATIENCE_A)
    assert len(errors) == 9
    assert model.getNumTrees == L.best_iteration(errors, L.PATIENCE_A)
    if model.getNumTrees < 9:      # the refit is the head of the full fit
        assert math.isclose(model.evaluateEachIteration(held, "squared")[-1], min(errors), rel_tol=1e-9)


def test_large_category_stays_nominal(spark):
    df = spark.createDataFrame([(float(i % 65), float(i)) for i in range(400)], "c double, item_cnt_month double")
    v = L.assemble(L.declare_categorical(df, ["c"]), ["c"])
    assert L.nominal_sizes(v) == {"c": 65} and L.bins_for(v) == 65
    model = L.booster({"n_estimators": 1, "max_depth": 2}, v).fit(v)
    assert model.getNumTrees == 1


def test_missing_values_are_an_error_and_empty_columns_reported(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None)], "a double, b double")
    assert L.drop_all_missing(df, ["a", "b"])[1] == ["b"]
    with pytest.raises(Exception):
        L.assemble(df, ["a", "b"]).collect()


def test_gbt_parameter_mapping():
    p = L.gbt_params(L.without_unmapped(L.BOOSTER_B_NOTEBOOK))
    assert p["maxDepth"] == 7 and p["maxIter"] == 1000 and p["minInstancesPerNode"] == 300
    assert p["subsamplingRate"] == 0.8 and p["featureSubsetStrategy"] == "0.8" and p["stepSize"] == 0.1
    assert L.gbt_params(L.without_unmapped(L.BOOSTER_A_FIXED))["minInstancesPerNode"] == 1
    assert set(L.unmapped(L.BOOSTER_A_FIXED)) == {"reg_alpha", "reg_lambda"}
    for bad in (L.BOOSTER_A_FIXED, {"max_depth": 31}, {"num_leaves": 3}):
        with pytest.raises(ValueError):
            L.gbt_params(bad)
    decoded = L.decode(L.BOOSTER_A_FIXED, L.SPACE_A)
    assert (decoded["max_depth"], decoded["n_estimators"], decoded["min_child_weight"]) == (11, 1000, 100)


def test_search_draws_from_both_spaces(prep):
    few = {"n_estimators": [2, 3], "max_depth": [2, 3]}
    for space in (L.SPACE_A, L.SPACE_B):
        best, scores = L.cv_search(prep, space | few, FIXTURE, trials=2, k=2, parallelism=2)
        assert len(scores) == 2 and set(best) == set(space) and all(s > 0 for s in scores)


def test_tuned_forecast_searches_and_stacks(prep):
    few = {"n_estimators": [2], "max_depth": [2]}
    fc = FC.tuned_forecast(prep, FIXTURE, 1, 2, L.SPACE_A | few, L.SPACE_B | few, 2)
    assert fc.final.count() == L.score_months(prep, FIXTURE).count()
    assert math.isfinite(fc.rmse_test)
