"""Table profiling: value counts, column profile, non-finite cells.

All three are one distributed job over the table: columns are unpivoted
(``stack``) into (column, value) pairs and aggregated together, instead of one
pass per column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandcast.operators.clean import floating_columns


def _unpivot(df: DataFrame, cols: Sequence[str], value: str = "value") -> DataFrame:
    return df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias(value)) for c in cols
    ])).alias("__kv")).select("__kv.*")


def value_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Per column: value -> count, missing values left out (as a value count does)."""
    cols = list(cols or df.columns)
    kv = _unpivot(df, cols)
    return (kv.filter(F.col("value").isNotNull())
              .groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("count")))


def table_profile(df: DataFrame) -> DataFrame:
    """Column name, position, type, non-null and null counts (one aggregate job)."""
    aggs = [F.count(F.col(c)).alias(f"__nn_{i}") for i, c in enumerate(df.columns)]
    one = df.agg(F.count(F.lit(1)).alias("__rows"), *aggs)
    rows = [F.struct(F.lit(c).alias("column_name"), F.lit(i).alias("ordinal"),
                     F.lit(df.schema[c].dataType.simpleString()).alias("data_type"),
                     F.col(f"__nn_{i}").alias("non_null_count"),
                     (F.col("__rows") - F.col(f"__nn_{i}")).alias("null_count"))
            for i, c in enumerate(df.columns)]
    return one.select(F.explode(F.array(*rows)).alias("__p")).select("__p.*")


def nonfinite_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Per column: number of NULL / NaN / +-inf cells (only columns that have any)."""
    cols = list(cols or df.columns)
    floating = set(floating_columns(df, cols))
    aggs = []
    for i, c in enumerate(cols):
        bad = F.col(c).isNull()
        if c in floating:
            bad = bad | F.isnan(c) | (F.abs(F.col(c)) == F.lit(float("inf")))
        aggs.append(F.sum(F.when(bad, 1).otherwise(0)).cast("bigint").alias(f"__b_{i}"))
    one = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(f"__b_{i}").alias("nonfinite_count"))
            for i, c in enumerate(cols)]
    out = one.select(F.explode(F.array(*rows)).alias("__p")).select("__p.*")
    return out.filter(F.col("nonfinite_count") > 0)


def nonfinite_cells(df: DataFrame, key: Sequence[str], cols: Sequence[str] | None = None) -> DataFrame:
    """The individual cells (row key, column) holding NULL / NaN / +-inf."""
    cols = [c for c in (cols or df.columns) if c not in key]
    floating = set(floating_columns(df, cols))
    cells = []
    for c in cols:
        bad = F.col(c).isNull()
        if c in floating:
            bad = bad | F.isnan(c) | (F.abs(F.col(c)) == F.lit(float("inf")))
        cells.append(F.when(bad, F.lit(c)))
    return (df.select(*key, F.explode(F.array(*cells)).alias("column_name"))
              .filter(F.col("column_name").isNotNull()))
