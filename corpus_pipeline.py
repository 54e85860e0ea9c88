"""From raw documents to token files: five operators, one after another.

Each stage takes the documents that the one before kept, with all their columns, and writes
Parquet; the last returns one row for every document in the token files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from seatledger.llm import decontaminate, mixing, near_dedup, quality, token_files
from seatledger.llm.components import stored
from seatledger.llm.queries import mix_levels, table, tokenizer_path
from seatledger.session import scratch_path

#: The mixture: 60 % of the tokens at hand, no source more than once. Domains of about equal size
#: can give what their weights ask for up to two thirds; beyond, they are filled up and weights bind no more.
WEIGHTS = {"domain": {"0": 2, "1": 3, "2": 2, "3": 1}, "lang": {"en": 6, "de": 2, "fr": 2, "es": 2}, "source": {}}
SHARE, EPOCHS = 0.6, 1


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on ``labels``, does not reject."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that with the smallest id."""
    return near_dedup.representatives(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an item of ``benchmark``."""
    return decontaminate.without_items(docs, table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture's documents; the one in which a leaf's quota ends keeps its first words."""
    return mixing.mixed_rows(docs, WEIGHTS, mix_levels(), share=SHARE, epochs=EPOCHS)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` read back from the written token files."""
    folder = scratch_path(spark, "tokens")
    token_files.write_token_files(docs, folder, tokenizer_path(), keep_words=False, split_marks=True)
    return token_files.read_token_files(spark, folder)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("minhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("source_mixing", source_mixing),
    ("token_files", token_output),
]

#: SQL has no word for boosted trees and tokenizers; tests/llm compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
