"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from demandcast.session import shared_path

#: ASCII white space the contracts name: [\x20\x09-\x0D]
SPACES = " \t\n\x0b\x0c\r"
_SPACE, _WORD = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]"

FILTER_BITS = 1 << 26          # bits of the filters that go before exact joins: 8 MB broadcast

_WRITTEN: list[str] = []


BATCH_ROWS = 1000               # rows in an Arrow batch: texts are long, and a batch is held several times over


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, once per application (a zip by ``addPyFile``, as ``--py-files`` does).

    Also lowers the session's Arrow batches to ``BATCH_ROWS`` rows, which bounds the memory beside the heap.
    """
    sc = spark.sparkContext
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(batch, "10000")) <= BATCH_ROWS:
        spark.conf.set(batch, str(BATCH_ROWS))
    if getattr(sc, "_demandcast_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="demandcast-zip-"), "demandcast.zip")   # sent by Spark from here
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("demandcast", os.path.relpath(full, root)))
    sc.addPyFile(path)
    sc._demandcast_shipped = True


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text: every word with the space around it becomes one character."""
    marks = F.regexp_replace(text, f"{_SPACE}*{_WORD}+{_SPACE}*", "w")
    return F.length(F.translate(marks, SPACES, "")).cast("long")


def packed(docs: DataFrame, *columns: str | Column) -> DataFrame:
    """``docs`` as one struct ``__doc`` beside the named columns, so that no column of a caller can clash."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__doc"), *columns)


def unpacked(df: DataFrame) -> DataFrame:
    return df.select("__doc.*")


def materialize(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet under the shared checkpoint folder and read it back.

    It cuts the lineage (a lost executor costs a re-read), keeps the columns prunable, and gives the
    planner real file sizes, so that it broadcasts the table only when it is small enough.
    """
    spark = df.sparkSession
    path = shared_path(spark, f"llm/{label}-{uuid.uuid4().hex}")
    df.write.parquet(path, compression=compression)
    _WRITTEN.append(path)
    return spark.read.schema(df.schema).parquet(path)


def written_tables() -> list[str]:
    """Paths written by ``materialize`` and not yet dropped."""
    return list(_WRITTEN)


def drop_tables(spark: SparkSession, paths: list[str]) -> None:
    """Delete materialised tables whose results have been written elsewhere."""
    for path in paths:
        hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
        hpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hpath, True)
        if path in _WRITTEN:
            _WRITTEN.remove(path)


def _marked(rows: DataFrame, column: str, wanted: DataFrame, bits: int) -> DataFrame:
    """``rows`` with ``__likely``: whether ``column`` may be among the values of ``wanted`` (one column).

    A bitmap of hashed values is broadcast: ``bits`` / 8 bytes at most, whatever the tables hold.
    """
    bit = lambda c: F.pmod(F.xxhash64(c), F.lit(bits))
    marks = wanted.select(bit(F.col(wanted.columns[0])).alias("bit")).groupBy(F.shiftright("bit", 15).alias("__part")) \
        .agg(F.bitmap_construct_agg(F.col("bit").bitwiseAND(F.lit(32767))).alias("__map"))
    hashed = rows.withColumn("__bit", bit(F.col(column))).withColumn("__part", F.shiftright("__bit", 15))
    inside = F.col("__bit").bitwiseAND(F.lit(32767))
    byte = F.conv(F.hex(F.substring("__map", (F.shiftright(inside, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    set_ = F.getbit(byte, inside.bitwiseAND(F.lit(7)).cast("int")) == 1
    return (hashed.join(F.broadcast(marks), "__part", "left")
            .withColumn("__likely", F.coalesce(set_, F.lit(False))).drop("__bit", "__part", "__map"))


def likely_rows(rows: DataFrame, column: str, wanted: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """The rows whose ``column`` may be among the values of ``wanted``; none that is gets lost.

    It only spares the exact join that follows from shuffling rows that have no partner.
    """
    return _marked(rows, column, wanted, bits).where("__likely").drop("__likely")


def split_rows(rows: DataFrame, column: str, wanted: DataFrame,
               bits: int = FILTER_BITS) -> tuple[DataFrame, DataFrame]:
    """The rows whose ``column`` may be among the values of ``wanted``, and those whose surely is not."""
    marked = _marked(rows, column, wanted, bits)
    return marked.where("__likely").drop("__likely"), marked.where("not __likely").drop("__likely")


def map_rows(df: DataFrame, columns: list[str], schema: str | StructType, make: Callable[[], Callable[..., tuple]],
             rows_at_once: int = 256) -> DataFrame:
    """One output row per input row from a Python function, in Arrow batches.

    ``make`` runs once per task and returns the row function (it may hold caches); the function gets the
    values of ``columns`` and returns the values of ``schema``.  At most ``rows_at_once`` texts are Python
    objects at any time, so memory does not follow the batch size.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in batches:
            for at in range(0, batch.num_rows, rows_at_once):
                part = batch.slice(at, rows_at_once)
                rows = [fn(*values) for values in zip(*(c.to_pylist() for c in part.columns))]
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), arrow)],
                                                 schema=arrow)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    struct = schema if isinstance(schema, StructType) else _parse_datatype_string(schema)
    assert isinstance(struct, StructType)
    arrow = to_arrow_schema(struct)
    return df.select(*columns).mapInArrow(run, struct)
