"""Sinks: forecast CSV, partitioned Parquet checkpoint of a table, filtered CSV export.

Every sink writes under a caller-given directory; the registered queries use a
folder under the shared ``spark.checkpoint.dir`` (never a machine-local temp
folder) and read the written data back, so a lost executor after the write
costs nothing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from demandcast.operators.clean import row_position
from demandcast.session import shared_path


def scratch_dir(df: DataFrame, name: str) -> str:
    return shared_path(df.sparkSession, f"{name}-{uuid.uuid4().hex[:12]}")


def write_forecast_csv(forecasts: DataFrame, path: str, order, value: str = "prediction") -> DataFrame:
    """``(ID, item_cnt_month)`` CSV with a header; ID = 0..n-1 in ``order``.  Returns the re-read file."""
    out = row_position(forecasts, order, "ID").select("ID", forecasts[value].alias("item_cnt_month"))
    out.write.mode("overwrite").option("header", True).csv(path)
    schema = T.StructType([T.StructField("ID", T.LongType()), T.StructField("item_cnt_month", T.DoubleType())])
    return forecasts.sparkSession.read.schema(schema).option("header", True).csv(path)


def checkpoint_table(df: DataFrame, path: str, partition_by=("date_block_num",)) -> DataFrame:
    """Write ``df`` as Parquet partitioned by month and read it back (month filters prune partitions)."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    back = df.sparkSession.read.parquet(path)
    return back.select(*df.columns)


def export_csv(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as CSV with a header and read it back with the same schema."""
    df.write.mode("overwrite").option("header", True).csv(path)
    return df.sparkSession.read.schema(df.schema).option("header", True).csv(path)


def save_predictions(df: DataFrame, path: str) -> DataFrame:
    """Save a prediction table (with its natural key) as Parquet and read it back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
