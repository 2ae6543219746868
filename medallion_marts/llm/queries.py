"""The corpus queries over the given tables, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, collocations, context_mixing, conversation_repair, exact_dedup, language_id, licence_scan, near_dedup, packing, permutation_index, quality, token_counts, toxicity
from .common import read_table


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_mixing.assess(read_table(spark, sf_dir, "documents"))


def op2_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permutation_index.search(read_table(spark, sf_dir, "embeddings"), every=20, top=20)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.assess(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assess(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_copies(read_table(spark, sf_dir, "documents"), percent=85)


def op6_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licence_scan.scan(read_table(spark, sf_dir, "documents"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.encode_and_decode(read_table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.find_copies(read_table(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(read_table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conversation_repair.damaged(read_table(spark, sf_dir, "conversations"))
    return conversation_repair.summarise(conversation_repair.repair(rows, gone=F.col("gone")))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read_table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_lm_score": op1_lm_score,
    "op2_nearest_vectors": op2_nearest_vectors,
    "op3_toxicity": op3_toxicity,
    "op4_quality": op4_quality,
    "op5_near_dedup": op5_near_dedup,
    "op6_licence_scan": op6_licence_scan,
    "op7_bpe": op7_bpe,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_language_id": op9_language_id,
    "op10_packing": op10_packing,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_token_counts": op12_token_counts,
    "op13_collocations": op13_collocations,
}
ORACLE_SQL = {"op5_near_dedup": near_dedup.ORACLE_SQL, "op8_exact_dedup": exact_dedup.ORACLE_SQL, "op13_collocations": collocations.ORACLE_SQL}
