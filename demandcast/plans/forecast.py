"""End-to-end forecast: feature matrix -> cleaning -> fold-averaged boosters -> stacked
meta model -> RMSE and forecast file.

Fits are ``pyspark.ml`` jobs on the checkpointed training table; fold fits run
concurrently.  The meta model is trained on the validation month's base
predictions (as the original does, so its validation RMSE is in-sample: it is
reported as ``rmse_valid_in_sample``) and the honest number is the test-month
RMSE ``rmse_test``.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandcast.operators import learn as L
from demandcast.operators.clean import clean_features
from demandcast.operators.panel import materialize, release, written_tables
from demandcast.plans.features import feature_matrix
from demandcast.spec import KEY, MONTH, TARGET, FactSpec

# Label-encoded columns declared categorical for the trees (explicit list).
CATEGORICAL = ("categories_id", "categories_name")


@dataclass
class Forecast:
    prepared: DataFrame
    level2: DataFrame          # KEY, TARGET, lgb, xgb  (valid + test months)
    final: DataFrame           # KEY, TARGET, lgb, xgb, item_cnt_month_forecast
    rmse_valid_in_sample: float
    rmse_test: float
    rmse_mean_baseline: float


def prepared_table(lines: DataFrame, items: DataFrame, spec: FactSpec, k: int = 5) -> DataFrame:
    """The training table, written by month; the panel tables that led to it are deleted."""
    before = set(written_tables())
    clean = clean_features(feature_matrix(lines, items, spec), spec)
    out = L.prepare(clean, spec, CATEGORICAL, k)
    release(lines.sparkSession, [p for p in written_tables() if p not in before])
    return out


def base_predictions(prepared: DataFrame, spec: FactSpec, params_a: dict | str = L.without_unmapped(L.BOOSTER_A_FIXED),
                     params_b: dict | str = L.without_unmapped(L.BOOSTER_B_FIXED), k: int = 5, parallelism: int = 3,
                     patience_a: int | None = L.PATIENCE_A, patience_b: int | None = L.PATIENCE_B) -> DataFrame:
    """Both learners' fold means as two columns of one scored frame, written once.

    The two fold sets are fitted concurrently; their models run as transforms over the same rows (no join).
    """
    with ThreadPoolExecutor(max_workers=2) as pool:
        fa = pool.submit(L.kfold_models, prepared, params_a, spec, k, patience_a, parallelism)
        fb = pool.submit(L.kfold_models, prepared, params_b, spec, k, patience_b, parallelism)
        models_a, models_b = fa.result(), fb.result()
    scored = L.with_fold_mean(L.with_fold_mean(L.score_months(prepared, spec), models_a, "lgb"), models_b, "xgb")
    return materialize(scored.select(*KEY, TARGET, "lgb", "xgb"), "parquet")


def stacked_forecast(prepared: DataFrame, spec: FactSpec, level2: DataFrame | None = None,
                     meta_params: dict = L.META_PARAMS, learner: str = "gbt") -> Forecast:
    level2 = level2 if level2 is not None else base_predictions(prepared, spec)
    final = L.stack_meta(level2, ["lgb", "xgb"], spec, meta_params, learner=learner)
    valid = final.filter(F.col(MONTH) == spec.valid_month)
    test = final.filter(F.col(MONTH) == spec.test_month)
    mean_y = valid.agg(F.avg(TARGET)).first()[0]
    return Forecast(prepared, level2, final,
                    L.rmse_value(valid, TARGET, "item_cnt_month_forecast"),
                    L.rmse_value(test, TARGET, "item_cnt_month_forecast"),
                    L.rmse_value(valid.withColumn("__m", F.lit(float(mean_y or 0.0))), TARGET, "__m"))


def tuned_forecast(prepared: DataFrame, spec: FactSpec, trials: int = 100, k: int = 5, space_a: dict = L.SPACE_A,
                   space_b: dict = L.SPACE_B, parallelism: int = 4) -> Forecast:
    """Search both boosters over their declared spaces, then fit and stack the best of each."""
    best_a, _ = L.cv_search(prepared, space_a, spec, trials, k, L.PATIENCE_A, parallelism)
    best_b, _ = L.cv_search(prepared, space_b, spec, trials, k, L.PATIENCE_SEARCH_B, parallelism)
    level2 = base_predictions(prepared, spec, L.without_unmapped(best_a), L.without_unmapped(best_b), k, parallelism)
    return stacked_forecast(prepared, spec, level2)


def forecast_rows(fc: Forecast, spec: FactSpec) -> DataFrame:
    """Test-month rows with the stacked forecast (the data behind the forecast file)."""
    return fc.final.filter(F.col(MONTH) == spec.test_month).select(*KEY, TARGET, "lgb", "xgb",
                                                                   "item_cnt_month_forecast")
