"""The registered queries of this package and, where SQL can express them, the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from assayer.llm import twins
from assayer.llm.bpe import count_tokens
from assayer.llm.common import table
from assayer.llm.embedding_dedup import near_duplicate_vectors
from assayer.llm.language import languages
from assayer.llm.merkle import manifest
from assayer.llm.mixing import mix
from assayer.llm.ngram_join import near_duplicates
from assayer.llm.packing import pack
from assayer.llm.prefix_trie import prefix_trie
from assayer.llm.quality_rules import judge_quality
from assayer.llm.secrets import secret_digest
from assayer.llm.sharding import assign_shards
from assayer.llm.substring_dedup import passage_digest
from assayer.llm.token_files import read_documents, write_token_shards
from assayer.plans.scratch import scratch_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
TWINS: dict[str, str] = {
    "op3_quality_rules": twins.QUALITY_RULES,
    "op5_embedding_dedup": twins.EMBEDDING_DEDUP,
    "op10_ngram_join": twins.NGRAM_JOIN,
    "op11_prefix_trie": twins.PREFIX_TRIE,
    "op12_substring_dedup": twins.SUBSTRING_DEDUP,
    "op13_merkle_manifest": twins.MERKLE_MANIFEST,
}


def _query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


@_query
def op1_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


@_query
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=1024)


@_query
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_quality(table(spark, sf_dir, "documents"))


@_query
def op4_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_digest(table(spark, sf_dir, "documents"), scratch_dir(spark, "secret-ledger"))


@_query
def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(table(spark, sf_dir, "embeddings"), threshold=0.93)


@_query
def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_shards(table(spark, sf_dir, "documents"), shards=8)


@_query
def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "token-files")
    write_token_shards(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return read_documents(spark, path).withColumnRenamed("key", "doc_id")


@_query
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), capacity=4096, end_id=2)


@_query
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages(table(spark, sf_dir, "documents"))


@_query
def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), threshold=0.8, width=5)


@_query
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


@_query
def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passage_digest(table(spark, sf_dir, "documents"))


@_query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(table(spark, sf_dir, "documents"))
