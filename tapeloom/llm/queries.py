"""The numbered operators over their whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tapeloom.llm.common import table
from tapeloom.llm.conversations import repair_conversations
from tapeloom.llm.decontaminate import benchmark_leaks
from tapeloom.llm.divergence import source_divergence
from tapeloom.llm.embeddings import vector_groups
from tapeloom.llm.language import languages
from tapeloom.llm.language_model import score_texts
from tapeloom.llm.oracle import ORACLE  # noqa: F401
from tapeloom.llm.secrets import scan_secrets
from tapeloom.llm.sentencepiece import encode_digest
from tapeloom.llm.sharding import byte_shards
from tapeloom.llm.simhash import simhash_groups
from tapeloom.llm.suffix_dedup import suffix_dedup
from tapeloom.llm.token_counts import token_counts
from tapeloom.llm.toxicity import toxicity

Query = Callable[[SparkSession, str], DataFrame]

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(table(spark, sf_dir, "documents"), length=400)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), VOCABULARY)


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_shards(table(spark, sf_dir, "documents"), 8)


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_groups(table(spark, sf_dir, "embeddings"), threshold=0.95)


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_digest(table(spark, sf_dir, "documents"), PIECE_MODEL)


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmark_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"), size=3, max_bits=3)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages(table(spark, sf_dir, "documents"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents"), min_docs=30, top=50)


def op12_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_conversations(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Query] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_token_counts": op2_token_counts,
    "op3_sharding": op3_sharding,
    "op4_embedding_dedup": op4_embedding_dedup,
    "op5_lm_scoring": op5_lm_scoring,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_decontamination": op7_decontamination,
    "op8_simhash": op8_simhash,
    "op9_toxicity": op9_toxicity,
    "op10_language": op10_language,
    "op11_source_divergence": op11_source_divergence,
    "op12_secret_scans": op12_secret_scans,
    "op13_conversation_repair": op13_conversation_repair,
}
