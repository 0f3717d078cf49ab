"""Cleaning, encoding, splitting and row positions.

* ``row_position``: dense 0..n-1 positions in a global order without a
  single-partition window: range-partition + sort inside partitions, the
  per-partition index from ``monotonically_increasing_id`` (its low 33 bits),
  and per-partition offsets from a table with one row per partition.
* ``label_encode``: sorted distinct values -> ``row_position`` -> join back;
  NULL gets the last code (R16).
* ``mean_impute``: one aggregate over all columns, attached as a 1-row
  broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandcast.functions.columns import finite_or_null
from demandcast.operators.panel import attach_scalar, join_back_checked, materialize
from demandcast.spec import KEY, MONTH, TARGET, FactSpec

FLOATING = (T.DoubleType, T.FloatType)
NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DoubleType, T.FloatType, T.DecimalType)

_LOW33 = (1 << 33) - 1


def row_position(df: DataFrame, order: Sequence[str], name: str = "ID",
                 partitions: int | None = None, how: str = "checkpoint") -> DataFrame:
    """Add ``name`` = 0-based position of the row in ``order`` (a unique key gives a stable result)."""
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions", "8"))
    mid = F.monotonically_increasing_id()
    s = (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
           .withColumn("__mid", mid)
           .withColumns({"__pid": F.shiftright("__mid", 33), "__local": F.col("__mid").bitwiseAND(F.lit(_LOW33))}))
    # Both branches below must see the same partitions: the range bounds are
    # sampled, and a re-planned (column-pruned) exchange may sample others.
    s = materialize(s, how)
    counts = s.groupBy("__pid").agg(F.count(F.lit(1)).alias("__cnt"))
    # one row per partition: a window without PARTITION BY is fine here
    offsets = counts.select("__pid", F.coalesce(
        F.sum("__cnt").over(Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("__off"))
    return (s.join(F.broadcast(offsets), "__pid")
             .withColumn(name, F.col("__off") + F.col("__local"))
             .drop("__mid", "__pid", "__local", "__off"))


def label_codes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(__column, __value, __code)``: dense codes of the sorted distinct non-null values of
    every column in ``cols``, from ONE distinct + position pass (values compared as strings)."""
    kv = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("__column"), F.col(c).cast("string").alias("__value")) for c in cols
    ])).alias("__kv")).select("__kv.*").filter(F.col("__value").isNotNull()).distinct()
    pos = row_position(kv, ["__column", "__value"], "__pos")
    first = pos.groupBy("__column").agg(F.min("__pos").alias("__first"))   # one row per column
    return (pos.join(F.broadcast(first), "__column")
               .select("__column", "__value", (F.col("__pos") - F.col("__first")).cast("int").alias("__code")))


def label_encode(df: DataFrame, cols: Sequence[str], by: str | None = None) -> DataFrame:
    """Replace each string column by its code (R16: sorted order, NULL gets the last code).

    The code tables of all columns come from one pass; each is joined back with a
    size-checked broadcast.  ``by`` names a key that decides the columns (the product
    decides its item's strings): then one row per key is encoded, not every row of
    ``df``, and the codes are joined on the key.
    """
    cols = list(cols)
    if by is not None:
        keyed = materialize(df.select(by, *cols).distinct(), "persist")
        return join_back_checked(df.drop(*cols), label_encode(keyed, cols), [by]).select(*df.columns)
    codes = materialize(label_codes(df, cols), "persist")
    out = df
    for c in cols:
        cc = codes.filter(F.col("__column") == c).select(F.col("__value").alias(f"{c}__value"),
                                                         F.col("__code").alias(f"{c}__code"))
        k = cc.agg(F.count(F.lit(1)).cast("int").alias(f"{c}__k"))      # always one row
        j = join_back_checked(out.withColumn(f"{c}__value", F.col(c).cast("string")), cc, [f"{c}__value"])
        out = (attach_scalar(j, k)
               .withColumn(c, F.coalesce(F.col(f"{c}__code"), F.col(f"{c}__k")).cast("int"))
               .drop(f"{c}__value", f"{c}__code", f"{c}__k"))
    return out.select(*df.columns)


def floating_columns(df: DataFrame, cols: Sequence[str] | None = None) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, FLOATING) and (cols is None or f.name in cols)]


def numeric_columns(df: DataFrame, cols: Sequence[str] | None = None) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NUMERIC) and (cols is None or f.name in cols)]


def inf_to_null(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """+/-inf and NaN -> NULL on floating columns."""
    return df.withColumns({c: finite_or_null(c) for c in floating_columns(df, cols)})


def cast_float(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in cols})


def zero_fill(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.fillna(0, subset=list(cols))


def coalesce_trend(cols: Sequence[str], default: float = 0.0):
    """R15 as an expression: first non-missing of ``cols``, else ``default``."""
    return F.coalesce(*[F.col(c) for c in cols], F.lit(default))


def column_means(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """1-row table of column means (NULL for all-missing columns)."""
    return df.agg(*[F.avg(c).alias(f"{c}__mean") for c in cols])


def mean_impute(df: DataFrame, cols: Sequence[str] | None = None, fit: DataFrame | None = None) -> DataFrame:
    """Missing -> column mean.  ``fit`` (default ``df``) is the frame the means come from,
    e.g. the training months only for a leak-free variant.  Integer columns holding
    missing values are widened to DOUBLE (as the original casts them to float); by
    default every numeric column but the key and the target is imputed.""" 
    if cols is None:
        cols = [c for c in numeric_columns(df) if c not in (*KEY, TARGET)]
    cols = list(cols)
    src = fit if fit is not None else df
    means = column_means(src, cols)
    j = attach_scalar(df, means)
    filled = {}
    for c in cols:
        base = F.col(c) if isinstance(df.schema[c].dataType, FLOATING) else F.col(c).cast("double")
        filled[c] = F.coalesce(base, F.col(f"{c}__mean").cast("double"))
    return j.withColumns(filled).select(*df.columns)


def split_label(spec: FactSpec):
    """'train' before the validation month, 'valid', 'test', NULL elsewhere."""
    m = F.col(MONTH)
    return (F.when(m < spec.valid_month, "train").when(m == spec.valid_month, "valid")
             .when(m == spec.test_month, "test"))


def split_by_month(df: DataFrame, spec: FactSpec) -> dict[str, DataFrame]:
    """Train (< valid), valid (= valid), test (= test) frames (filters pushed to the scan)."""
    m = F.col(MONTH)
    return {"train": df.filter(m < spec.valid_month), "valid": df.filter(m == spec.valid_month),
            "test": df.filter(m == spec.test_month)}


def clean_features(features: DataFrame, spec: FactSpec, fit_before: int | None = None,
                   how: str = "parquet") -> DataFrame:
    """The cleaning stage: drop helper columns, label-encode, non-finite -> NULL -> mean.

    The input is materialised first (where the original pickles its feature
    table): label codes, column means and the output all read it, instead of
    each re-running the feature chain.
    """
    df = materialize(features.drop(*spec.drop_before_clean), how)
    df = label_encode(df, spec.label_columns, by="product_id")
    df = inf_to_null(df)
    fit = df.filter(F.col(MONTH) < fit_before) if fit_before is not None else None
    return mean_impute(df, fit=fit)
