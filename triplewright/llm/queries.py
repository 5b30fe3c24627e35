"""One query per operator, over the whole of its table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triplewright.llm import (
    alignment,
    bpe,
    licenses,
    line_dedup,
    lm_scoring,
    mixing,
    near_dups,
    nn_descent,
    quality,
    sharding,
    spelling,
    token_counts,
    warc,
)
from triplewright.session import materialize, scratch_path

BPE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
BPE_PATTERN = public_tokenizers.PATTERN
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
TOKEN_LIMIT = 1024
N_SHARDS = 24


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    _, manifest = warc.archive_pages(pages)
    read = warc.read_back(pages, manifest, payloads=False)
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_setsketch_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dups.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_shingles",
        "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"),
    )


def op3_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip(documents, BPE_RANKS, BPE_PATTERN)


def op4_license_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts.count_tokens(documents, TOKENIZER, scratch_path(spark, "token_cache"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


def op6_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.pareto_mix(_table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


def op7_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = nn_descent.nearest(_table(spark, sf_dir, "embeddings"), "vec_id % 50 = 0", 5)
    return found.select(F.col("query_id").cast("long"), F.col("rank").cast("int"), F.col("vec_id").cast("long"), "score")


def op8_gru_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.lm_scores(_table(spark, sf_dir, "documents"))


def op9_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = sharding.shard_table(_table(spark, sf_dir, "documents"), N_SHARDS)
    numbered = sharding.number_in_shard(materialize(shards, "sharded"), ["doc_id", "text_crc32"])
    return numbered.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
        "rebalanced_shard",
    )


def op10_quality_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    ledger = materialize(quality.ledger(documents), "quality_ledger")
    base = (1 << 0) | (1 << 1)  # few_words, repeated_words
    return quality.apply_policy(ledger).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (F.col("failed_bits").bitwiseAND(F.lit(base).cast("long")) != 0).alias("base_failed"),
        "kept",
        "failed_bits",
    )


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = line_dedup.drop_repeated_lines(documents)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return alignment.align(documents, TOKENIZER, BPE_PATTERN, PIECES)


QUERIES = {
    "op1_warc_index": op1_warc_index,
    "op2_setsketch_dedup": op2_setsketch_dedup,
    "op3_bpe_round_trip": op3_bpe_round_trip,
    "op4_license_rules": op4_license_rules,
    "op5_token_counts": op5_token_counts,
    "op6_pareto_mix": op6_pareto_mix,
    "op7_nn_descent": op7_nn_descent,
    "op8_gru_scores": op8_gru_scores,
    "op9_virtual_slots": op9_virtual_slots,
    "op10_quality_ledger": op10_quality_ledger,
    "op11_line_dedup": op11_line_dedup,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_token_alignment": op13_token_alignment,
}
