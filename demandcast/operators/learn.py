"""Model fitting on the cleaned feature table with ``pyspark.ml`` (distributed fits).

* features: every column but the target, assembled into one vector;
* categorical columns are declared through ML attribute metadata (an explicit
  list, not a substring match), so the trees split them as categories;
* folds: md5-of-key bucket (stable under repartitioning and re-execution,
  unlike ``rand``);
* fold-averaged ensemble: one fit per fold, validation/test predictions
  averaged; fits of different folds run as concurrent Spark jobs;
* stacking: base predictions side by side (joined on the natural key), a
  meta booster on them;
* early stopping: all asked trees are fitted, the held-out error after each is
  read, and patience picks the best iteration;
* search: seeded random draws from the declared space, each scored by k-fold
  RMSE at its best iteration (parallel trials).

Boosters map onto ``GBTRegressor`` (see README for the parameter mapping).
Before fitting, the training table is written by month to the shared folder so
iterative fits do not recompute the feature chain and survive executor loss.
"""

from __future__ import annotations

import json
import random
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandcast.functions.columns import key_hash_bucket
from demandcast.operators import boost
from demandcast.session import shared_path
from demandcast.spec import KEY, MONTH, TARGET, FactSpec

# Fixed values of the original fixed-path models (as written in its code).
BOOSTER_A_FIXED = {"colsample_bytree": 0.8089140355585571, "max_depth": 8, "min_child_weight": 0,
                   "n_estimators": 9, "reg_alpha": 0.7633695810217804, "reg_lambda": 0.6705049189470987}
BOOSTER_B_FIXED = {"colsample_bytree": 0.8911958012150187, "gamma": 0.0070999104149873475,
                   "learning_rate": 0.1961063283600617, "max_depth": 8, "min_child_weight": 0,
                   "n_estimators": 8, "subsample": 0.9946360807263804}
META_PARAMS = {"max_depth": 5, "n_estimators": 100, "learning_rate": 0.05, "subsample": 0.7,
               "colsample_bytree": 0.7}
# Fixed values of the notebook's single boosters.
BOOSTER_A_NOTEBOOK = {"max_depth": 8, "n_estimators": 500, "colsample_bytree": 0.7, "min_child_weight": 300,
                      "reg_alpha": 0.1, "reg_lambda": 1}
BOOSTER_B_NOTEBOOK = {"max_depth": 7, "n_estimators": 1000, "min_child_weight": 300, "colsample_bytree": 0.8,
                      "subsample": 0.8, "gamma": 0.005, "learning_rate": 0.1}
# Fixed values of the declared search spaces (ranges as declared).
SPACE_A = {"max_depth": list(range(3, 12)), "n_estimators": list(range(100, 1001, 100)),
           "colsample_bytree": (0.5, 1.0), "min_child_weight": list(range(100, 601, 100)),
           "reg_alpha": (0.0, 1.0), "reg_lambda": (0.0, 2.0)}
SPACE_B = {"max_depth": list(range(3, 12)), "n_estimators": list(range(100, 1001, 100)),
           "colsample_bytree": (0.5, 1.0), "min_child_weight": list(range(100, 601, 100)),
           "subsample": (0.5, 1.0), "gamma": (0.0, 0.1), "learning_rate": (0.01, 0.2)}

# Patience (rounds without improvement) of the fixed-path models and of the search objective.
PATIENCE_A, PATIENCE_B, PATIENCE_SEARCH_B = 100, 40, 50
# The second library's documented defaults, for the blend that sets no parameters.
DEFAULTS_B = {"max_depth": 6, "n_estimators": 100, "learning_rate": 0.3}

# Regularisation terms without a GBTRegressor counterpart.  ``gamma`` is not converted either (other units):
# whoever wants a least gain sets ``min_info_gain``.
UNMAPPED = ("reg_alpha", "reg_lambda", "gamma")
KNOWN = ("max_depth", "n_estimators", "learning_rate", "subsample", "colsample_bytree", "min_child_weight",
         "min_info_gain")
DEEPEST = 30                    # Spark's own limit on the depth of a tree
LEAST_BINS = 32
TREE_ROWS = 1_000_000           # rows that fill a partition of a fit
LEAST_PARTS = 32                # partitions that a fit may have whatever its rows

FEATURES = "features"


def decode(raw: dict, space: dict) -> dict:
    """Parameters of a search result that names choices by their index (D2): values in place of indices."""
    return {k: space[k][int(v)] if isinstance(space.get(k), list) else v for k, v in raw.items()}


def without_unmapped(p: dict) -> dict:
    """``p`` without the terms that have no counterpart: the caller drops them in plain sight."""
    return {k: v for k, v in p.items() if k not in UNMAPPED}


def unmapped(p: dict) -> list[str]:
    return [k for k in p if k in UNMAPPED]


def gbt_params(p: dict, seed: int = 42) -> dict:
    """Map booster parameters onto GBTRegressor parameters; what cannot be mapped is an error."""
    if bad := [k for k in p if k not in KNOWN]:
        raise ValueError(f"no GBTRegressor counterpart for {bad}; drop them (without_unmapped) or set min_info_gain")
    if p.get("max_depth", 0) > DEEPEST:
        raise ValueError(f"max_depth {p['max_depth']} is over Spark's limit of {DEEPEST}")
    out = {"seed": seed}
    if "max_depth" in p:
        out["maxDepth"] = int(p["max_depth"])
    if "n_estimators" in p:
        out["maxIter"] = int(p["n_estimators"])
    if "learning_rate" in p:
        out["stepSize"] = float(p["learning_rate"])
    if "subsample" in p:
        out["subsamplingRate"] = float(p["subsample"])
    if "colsample_bytree" in p:
        out["featureSubsetStrategy"] = repr(float(p["colsample_bytree"]))
    if "min_child_weight" in p:
        out["minInstancesPerNode"] = max(int(p["min_child_weight"]), 1)
    if "min_info_gain" in p:
        out["minInfoGain"] = float(p["min_info_gain"])
    return out


def feature_names(df: DataFrame, label: str = TARGET, exclude: Sequence[str] = ()) -> list[str]:
    return [c for c in df.columns if c != label and c not in exclude and not c.startswith("__")
            and c not in ("fold", "split", "is_valid")]


def declare_categorical(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Attach nominal-attribute metadata (number of values = max code + 1) to ``cols``.

    Every column that is listed stays nominal, whatever its size: ``bins_for`` gives the trees a bin per value.
    """
    if not cols:
        return df
    sizes = df.agg(*[(F.max(F.col(c)).cast("int") + 1).alias(c) for c in cols]).first().asDict()
    return df.withColumns({
        c: F.col(c).cast("double").alias(c, metadata={"ml_attr": {"type": "nominal", "name": c,
                                                                   "num_vals": int(sizes[c] or 1)}})
        for c in cols})


def nominal_sizes(df: DataFrame, features: str = FEATURES) -> dict[str, int]:
    """Declared categorical columns of the feature vector and their number of values."""
    attrs = json.loads(df.schema[features].json())["metadata"].get("ml_attr", {}).get("attrs", {})
    return {a["name"]: int(len(a.get("vals", [])) or a.get("num_vals")) for a in attrs.get("nominal", [])}


def bins_for(df: DataFrame, features: str = FEATURES) -> int:
    """maxBins: a bin for every value of the largest declared category, and no less than Spark's default."""
    return max([LEAST_BINS, *nominal_sizes(df, features).values()])


def drop_all_missing(df: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Leave out the columns of ``cols`` that have no value at all; also returns their names."""
    counts = df.agg(*[F.count(c).alias(c) for c in cols]).first().asDict()
    empty = [c for c in cols if counts[c] == 0]
    return df.drop(*empty), empty


def assemble(df: DataFrame, cols: Sequence[str], out: str = FEATURES) -> DataFrame:
    """``VectorAssembler`` over ``cols``; a missing value is an error (impute or drop the column first)."""
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="error").transform(df)


def with_folds(df: DataFrame, k: int = 5, key: Sequence[str] = KEY) -> DataFrame:
    return df.withColumn("fold", key_hash_bucket(list(key), k))


def booster(params: dict, data: DataFrame, label: str = TARGET, seed: int = 42) -> GBTRegressor:
    return GBTRegressor(featuresCol=FEATURES, labelCol=label, maxBins=bins_for(data), **gbt_params(params, seed))


def full_parts(data: DataFrame) -> DataFrame:
    """``data`` in no more partitions than its rows fill (``LEAST_PARTS`` at least); the rows are not shuffled.

    At every level of a tree each partition sends the sums of all its nodes, features and bins, however few rows it
    has, and a table written by month is read in as many partitions as its files make, not its rows.
    """
    most = max(LEAST_PARTS, -(-data.count() // TREE_ROWS))
    return data.coalesce(most) if data.rdd.getNumPartitions() > most else data


def ols(label: str = TARGET) -> LinearRegression:
    """Exact least squares by normal equations (an affine learner whose results SQL can solve too)."""
    return LinearRegression(featuresCol=FEATURES, labelCol=label, solver="normal", regParam=0.0)


def best_iteration(errors: Sequence[float], patience: int) -> int:
    """1-based round of the least error, reading until ``patience`` rounds brought no improvement."""
    best = 0
    for i, e in enumerate(errors):
        if e < errors[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def fit_with_patience(params: dict, data: DataFrame, held: DataFrame, patience: int, label: str = TARGET,
                      seed: int = 42):
    """Fit all asked trees, read the held-out error after each, and keep the best iteration.

    Returns (model, errors).  The same seed gives the same first trees, so the shorter model is a refit with the
    best number of rounds; if all rounds helped, the fitted model itself.
    """
    est = booster(params, data, label, seed)
    model = est.fit(data)
    errors = model.evaluateEachIteration(held, "squared")
    best = best_iteration(errors, patience)
    if best < len(errors):
        model = est.setMaxIter(best).fit(data)
    return model, errors


def month_table(prepared: DataFrame) -> DataFrame:
    """The training table as Parquet partitioned by month: a month filter reads that month only."""
    path = shared_path(prepared.sparkSession, f"training-{uuid.uuid4().hex[:12]}")
    prepared.write.partitionBy(MONTH).parquet(path)
    return prepared.sparkSession.read.schema(prepared.schema).parquet(path).select(*prepared.columns)


def prepare(clean: DataFrame, spec: FactSpec, categorical: Sequence[str] = (), k: int = 5) -> DataFrame:
    """Train/valid/test rows with folds, declared categoricals and the feature vector, written by month."""
    df = clean.filter(F.col(MONTH) <= spec.test_month)
    df = declare_categorical(df, [c for c in categorical if c in df.columns])
    df = with_folds(df, k)
    df, _ = drop_all_missing(df, feature_names(df))
    names = feature_names(df)
    df = assemble(df, names).select(*KEY, TARGET, "fold", FEATURES)
    attrs = df.schema[FEATURES].metadata
    back = month_table(df)
    return back.withColumn(FEATURES, F.col(FEATURES).alias(FEATURES, metadata=attrs))


def score_months(prepared: DataFrame, spec: FactSpec) -> DataFrame:
    return prepared.filter(F.col(MONTH).isin(spec.valid_month, spec.test_month))


def kfold_models(prepared: DataFrame, params: dict | str, spec: FactSpec, k: int = 5, patience: int | None = None,
                 parallelism: int = 2, label: str = TARGET) -> list:
    """One model per fold, fitted on the others (``params="ols"``: least squares); fits run as concurrent jobs."""
    train = prepared.filter(F.col(MONTH) < spec.valid_month)
    if params != "ols":
        train = full_parts(train)

    def fit(fold: int):
        data, held = train.filter(F.col("fold") != fold), train.filter(F.col("fold") == fold)
        if params == "ols":
            return ols(label).fit(data)
        if patience is None:
            return booster(params, data, label).fit(data)
        return fit_with_patience(params, data, held, patience, label)[0]

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        return list(pool.map(fit, range(k)))


def with_fold_mean(scored: DataFrame, models: list, name: str) -> DataFrame:
    """Add the mean prediction of ``models`` as ``name``: transforms over one frame, no join."""
    columns = [f"__{name}_{i}" for i in range(len(models))]
    for column, model in zip(columns, models):
        scored = model.setPredictionCol(column).transform(scored)
    total = F.col(columns[0])
    for c in columns[1:]:
        total = total + F.col(c)
    return scored.withColumn(name, total / F.lit(len(models))).drop(*columns)


def kfold_predictions(prepared: DataFrame, params: dict | str, spec: FactSpec, k: int = 5, name: str = "pred",
                      patience: int | None = None, parallelism: int = 2, label: str = TARGET) -> DataFrame:
    """Fold-averaged predictions on the valid and test months."""
    models = kfold_models(prepared, params, spec, k, patience, parallelism, label)
    return with_fold_mean(score_months(prepared, spec), models, name).select(*KEY, label, name)


def fit_predict(prepared: DataFrame, params: dict, spec: FactSpec, name: str = "pred",
                patience: int | None = None, label: str = TARGET) -> DataFrame:
    """One booster on the training months (with ``patience``: best iteration by the valid month)."""
    m = F.col(MONTH)
    train = full_parts(prepared.filter(m < spec.valid_month))
    if patience is None:
        model = booster(params, train, label).fit(train)
    else:
        model, _ = fit_with_patience(params, train, prepared.filter(m == spec.valid_month), patience, label)
    return model.setPredictionCol(name).transform(score_months(prepared, spec)).select(*KEY, label, name)


def fit_regularised(prepared: DataFrame, params: dict, spec: FactSpec, name: str = "pred", leaves: int = 31,
                    at_once: int = 1, patience: int | None = None, label: str = TARGET) -> DataFrame:
    """``boost`` with the terms GBTRegressor lacks (L1, L2, gamma, leaf-wise growth), on the valid and test months.

    With ``patience`` the valid month ends the fit.  Row and column sampling have no counterpart here and are not used;
    nominal columns are split by the order of their codes.
    """
    width = prepared.schema[FEATURES].metadata["ml_attr"]["num_attrs"]
    names = [f"__f{i}" for i in range(width)]

    def wide(df: DataFrame) -> DataFrame:
        values = vector_to_array(F.col(FEATURES))
        return df.withColumn("__x", values).withColumns({c: F.col("__x")[i] for i, c in enumerate(names)}).drop("__x")

    m = F.col(MONTH)
    train, held = wide(prepared.filter(m < spec.valid_month)), wide(prepared.filter(m == spec.valid_month))
    penalty = boost.Penalty(params.get("reg_alpha", 0.0), params.get("reg_lambda", 0.0), params.get("gamma", 0.0),
                            params.get("min_child_weight", 1.0))
    model = boost.fit(train, held if patience is not None else None, names, label, params["n_estimators"],
                      params.get("learning_rate", 0.1), penalty, leaves, params["max_depth"], at_once=at_once,
                      patience=patience)
    return model.transform(wide(score_months(prepared, spec)), names, name).select(*KEY, label, name)


def stack_level2(*preds: DataFrame) -> DataFrame:
    """Base predictions side by side, joined on the natural key (not by position)."""
    out = preds[0]
    for p in preds[1:]:
        out = out.join(p.drop(TARGET), list(KEY), "inner")
    return out


def stack_meta(level2: DataFrame, inputs: Sequence[str], spec: FactSpec, params: dict = META_PARAMS,
               name: str = "item_cnt_month_forecast", label: str = TARGET, learner: str = "gbt") -> DataFrame:
    """Meta model trained on the validation month's base predictions, applied to valid and test."""
    data = assemble(level2, inputs, FEATURES)
    train = data.filter(F.col(MONTH) == spec.valid_month)
    if learner != "ols":
        train = full_parts(train)
    est = ols(label) if learner == "ols" else booster(params, train, label)
    model = est.fit(train)
    return model.setPredictionCol(name).transform(data).drop(FEATURES)


def rmse_value(df: DataFrame, label: str, pred: str) -> float:
    return RegressionEvaluator(labelCol=label, predictionCol=pred, metricName="rmse").evaluate(
        df.withColumn(label, F.col(label).cast("double")))


def random_trials(space: dict, n: int, seed: int = 42) -> list[dict]:
    """Seeded random draws: choice lists pick a value, (lo, hi) tuples draw uniformly."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        t = {}
        for k, v in space.items():
            t[k] = rng.choice(v) if isinstance(v, list) else rng.uniform(*v)
        out.append(t)
    return out


def cv_search(prepared: DataFrame, space: dict, spec: FactSpec, trials: int = 100, k: int = 5, patience: int = 100,
              parallelism: int = 4, seed: int = 42, label: str = TARGET) -> tuple[dict, list[float]]:
    """Mean k-fold RMSE of each drawn trial at its best iteration; returns (best parameters, all scores).

    The folds are the hashed ones; a trial's fold fits stop by ``patience`` on the held-out fold, as the
    objective asks.  Trials are evaluated ``parallelism`` at a time, every fit distributed.
    """
    draws = random_trials(space, trials, seed)
    train = full_parts(prepared.filter(F.col(MONTH) < spec.valid_month))

    def score(draw: dict) -> float:
        total = 0.0
        for fold in range(k):
            data, held = train.filter(F.col("fold") != fold), train.filter(F.col("fold") == fold)
            errors = booster(without_unmapped(draw), data, label, seed).fit(data).evaluateEachIteration(held, "squared")
            total += errors[best_iteration(errors, patience) - 1] ** 0.5
        return total / k

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        scores = list(pool.map(score, draws))
    return draws[min(range(len(scores)), key=scores.__getitem__)], scores
