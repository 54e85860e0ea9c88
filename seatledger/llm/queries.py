"""The operators as queries over whole tables, with SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seatledger.llm import chat, decontaminate, hard_negatives, lines, mixing, near_dedup, prefix_trie, quality, rules, simhash, substrings, token_files, toxicity
from seatledger.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

#: Vocabulary of operator 9, by its name among the installed public tokenizers. Its words are runs of
#: letters, single digits, runs of other characters, and 's 't 're 've 'm 'll 'd: marks split from letters and digits.
VOCABULARY = "word_bpe_49k.json"

#: Target weights of operator 3; domains of the synthetic sources are their numbers modulo 4.
MIX_WEIGHTS = {"domain": {"0": 2, "1": 3, "2": 2, "3": 1}, "lang": {"en": 6, "de": 2, "fr": 2, "es": 2}, "source": {}}


def mix_levels() -> dict:
    number = F.regexp_extract(F.col("source").cast("string"), r"(\d{1,9})$", 1)
    return {"domain": F.when(number != "", number.try_cast("bigint") % 4), "lang": F.col("lang"), "source": F.col("source")}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.deduplicate_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    taken = mixing.mix(docs, MIX_WEIGHTS, mix_levels(), share=0.5, epochs=2)
    return taken.select(
        "doc_id", F.col("_domain").alias("domain"), F.col("_lang").alias("lang"), F.col("_source").alias("source"),
        F.col("_epoch").alias("epoch"), F.col("_tokens").alias("n_tokens"), F.col("_take").alias("take_tokens"),
    )


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.apply_rules(table(spark, sf_dir, "documents")).drop("failed")


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_conversations(table(spark, sf_dir, "conversations"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "tokens")
    token_files.write_token_files(table(spark, sf_dir, "documents"), folder, tokenizer_path(), split_marks=True)
    return token_files.read_token_files(spark, folder)


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.repeated_passages(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes, ends = prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))
    named = nodes.join(prefix_trie.end_digests(ends), ["conv_id", "depth"], "left")
    return named.withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


def op13_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_near_duplicates(table(spark, sf_dir, "documents"))


def llm_queries() -> dict[str, Query]:
    own = (
        op1_quality_classifier, op2_line_dedup, op3_source_mixing, op4_benchmark_decontamination, op5_minhash_near_dedup,
        op6_quality_rules, op7_chat_formatting, op8_toxicity, op9_token_files, op10_substring_dedup, op11_prefix_trie, op12_hard_negatives, op13_simhash_near_dedup,
    )
    return {f.__name__: f for f in own}
