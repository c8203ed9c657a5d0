"""The registered queries of this package and their DuckDB SQL.

Each query reads whole tables, gets its rows through its operator and derives the digest
columns from the operator's output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import (bpe, chat, divergence, exact_dedup, fill_middle, mixing, near_dedup, pii,
               substring_dedup, token_files, topk, toxicity, url_filter)
from .common import table


def tokenizer_path(name: str) -> str:
    """Where the public vocabulary file of this name lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_dedup(table(spark, sf_dir, "documents"), words=4, percent=80)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_documents(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op4_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"),
                      is_query=lambda vec_id: vec_id % 50 == 0, k=5)


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_passages(table(spark, sf_dir, "documents"))


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.collapse_and_render(table(spark, sf_dir, "conversations"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(table(spark, sf_dir, "documents"),
                                  tokenizer_path("byte_bpe_50k.json"), end_id=2)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.digest(pii.find_spans(docs, pii.fit(docs)))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(table(spark, sf_dir, "documents"),
                             tokenizer_path("word_bpe_49k.json"),
                             outputs=("ids_sha256", "decoded_sha256"))


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.digests(table(spark, sf_dir, "documents"))


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = url_filter.fit(url_filter.labelled_urls(spark))
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), model)


QUERIES = {
    "op1_near_dedup": op1_near_dedup,
    "op2_toxicity": op2_toxicity,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_exact_topk": op4_exact_topk,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_chat_format": op6_chat_format,
    "op7_token_files": op7_token_files,
    "op8_mixing": op8_mixing,
    "op9_pii": op9_pii,
    "op10_bpe": op10_bpe,
    "op11_divergence": op11_divergence,
    "op12_fill_middle": op12_fill_middle,
    "op13_url_filter": op13_url_filter,
}

# What learned models, vocabularies or drawn samples decide has no SQL; tests/llm compares
# those queries with plain versions.
ORACLE_SQL = {
    "op1_near_dedup": near_dedup.ORACLE_SQL,
    "op3_exact_dedup": exact_dedup.ORACLE_SQL,
    "op4_exact_topk": topk.ORACLE_SQL,
    "op6_chat_format": chat.ORACLE_SQL,
    "op11_divergence": divergence.ORACLE_SQL,
    "op12_fill_middle": fill_middle.ORACLE_SQL,
}
