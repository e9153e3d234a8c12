"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again as the next one's input.

Stage functions take (spark, docs, sf_dir). All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer.llm.common import table, written
from assayer.llm.language import UNKNOWN, identify, train
from assayer.llm.mixing import taken_copies
from assayer.llm.ngram_join import first_of_each
from assayer.llm.packing import pack
from assayer.llm.secrets import redacted
from assayer.plans.scratch import scratch_dir

#: A document goes when no language has this share of its words.
LEAST_SHARE = 0.4


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without letters and those that no language has a large enough share of."""
    # The row stays in the JVM: only the text goes to Python, and only two values come back.
    judged = identify(docs.select(F.struct("*").alias("row"), "text"), train(docs))
    return judged.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_SHARE)).select("row.*")


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the least id of each class of 5-word shingle similarity 0.8 or more."""
    return first_of_each(docs, threshold=0.8, width=5)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps every document and replaces what the secret rules find in it by a mark."""
    clean = redacted(docs, scratch_dir(spark, "secret-ledger"))
    # The number of characters follows the text where it was right before.
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else clean


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each document 0, 1 or 2 times, so that sources come near their share of words."""
    return taken_copies(docs, weights=(5.0, 2.0, 1.0), share=1.5, most=2)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs all documents into sequences of at most 4096 tokens; one row per piece."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=4096, end_id=2)


STAGES = [
    ("language_id", known_language),
    ("ngram_join", one_of_near_duplicates),
    ("secret_scans", without_secrets),
    ("source_mixing", mixed_sources),
    ("packing", packed_sequences),
]

#: Near-duplicate classes and a fitted model have no SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
