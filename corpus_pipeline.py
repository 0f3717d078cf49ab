"""The corpus pipeline: documents to a mixed, encoded training set in five stages.

Each stage takes the documents that its predecessor kept, applies one operator of ``demandcast.llm`` and lets its
decisions take effect.  All but the last return the columns of ``documents``.  ``run`` writes every stage as Parquet
in the shared folder and reads it again for the next one, so a lost executor costs at most one stage's tasks.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from demandcast.llm import bpe, exactdup, mixing, neardup, quality
from demandcast.llm.common import drop_tables, read_table, ship_package, written_tables
from demandcast.session import shared_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bradley-Terry quality (2): documents that score below the threshold go."""
    ship_package(spark)
    return quality.accepted_documents(docs, read_table(spark, sf_dir, "labels")).select(*COLUMNS)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Minimal perfect hash (7): of equal texts one stays."""
    ship_package(spark)
    return exactdup.keep_winners(docs, exactdup.deduplicate_by_age(docs)).select(*COLUMNS)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """HyperMinHash (3): five-word shingles, similarity 0.8 or more; the smallest doc_id of a group stays."""
    ship_package(spark)
    return neardup.keep_first(docs, words=5, percent=80).select(*COLUMNS)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Efraimidis-Spirakis mixing (8): every document as often as its source's target takes it."""
    return mixing.mixed_documents(docs).select(*COLUMNS)


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Prefix dynamic programming (10): ids and the decoded bytes of every document, by digest."""
    ship_package(spark)
    return bpe.round_trip_digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [("quality", quality_stage), ("exact", exact_stage), ("near", near_stage), ("mix", mix_stage),
          ("encode", encode_stage)]

#: The quality stage fits a model and the near-duplicate stage hashes texts: SQL cannot express the rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply STAGES to ``documents``; the result is the last stage's table."""
    docs = read_table(spark, sf_dir, "documents")
    folder = shared_path(spark, f"llm/pipeline-{uuid.uuid4().hex}")
    before = set(written_tables())
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{folder}/{name}")
        drop_tables(spark, [p for p in written_tables() if p not in before])   # what the stage wrote on its way
        docs = spark.read.schema(out.schema).parquet(f"{folder}/{name}")
    return docs
