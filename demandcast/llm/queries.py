"""The registered queries of the training-data operators and, where SQL can express them, their DuckDB SQL.

Every query applies its operator with production parameters to the whole intended table.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from demandcast.llm import (ann, bpe, centroids, divergence, exactdup, htmlmain, mixing, neardup, packing, pii, quality,
                            sharding, tokencount)
from demandcast.llm.common import read_table, ship_package


def op1_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(read_table(spark, sf_dir, "documents"), shards=24)


def op2_pairwise_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op3_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(read_table(spark, sf_dir, "documents"), words=2, percent=80)


def op4_heap_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.count_tokens(read_table(spark, sf_dir, "documents"),
                                   public_tokenizers.path("byte_bpe_50k.json"))


def op5_host_suffix_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmlmain.extract_main_text(read_table(spark, sf_dir, "pages"))


def op6_anchor_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(read_table(spark, sf_dir, "documents"))


def op7_perfect_hash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exactdup.deduplicate_by_age(read_table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op8_weighted_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents"))


def op9_one_bit_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(read_table(spark, sf_dir, "embeddings"), neighbours=10, every=100)


def op10_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(read_table(spark, sf_dir, "documents"),
                                  public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op11_simplex_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(read_table(spark, sf_dir, "embeddings"), k=8, rounds=10, dims=64, scale=1024, seed="3")


def op12_swap_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                  end_id=2, capacity=1024)


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read_table(spark, sf_dir, "documents"), least=3, top=200)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = [op1_kd_sharding, op2_pairwise_quality, op3_hyperminhash, op4_heap_token_counts,
           op5_host_suffix_extraction, op6_anchor_pii, op7_perfect_hash_dedup, op8_weighted_mix, op9_one_bit_search,
           op10_prefix_bpe, op11_simplex_clusters, op12_swap_packing, op13_source_divergence]
    return {f.__name__: _shipped(f) for f in own}


def _shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)
    return run


def oracle_sql() -> dict[str, str]:
    return {"op7_perfect_hash_dedup": exactdup.ORACLE_SQL, "op8_weighted_mix": mixing.ORACLE_SQL,
            "op9_one_bit_search": ann.ORACLE_SQL, "op11_simplex_clusters": centroids.ORACLE_SQL,
            "op13_source_divergence": divergence.ORACLE_SQL}
