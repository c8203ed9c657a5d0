"""A corpus pipeline over `documents`: each stage works on all that the one before kept.

  toxicity     documents that the clause grammar rejects go
  exact_dedup  of equal texts the row with the largest doc_id stays
  near_dedup   of each near-duplicate group (five-word shingles, similarity 0.8) the row with the
               smallest doc_id stays; of a group without any id one row stays
  mixing       documents are drawn so that source, language and topic reach target shares
  bpe          what is left is encoded and decoded; the decoded text is returned as its digest
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from basketlens.llm import bpe, exact_dedup, mixing, near_dedup, toxicity
from basketlens.llm.common import ship, staged, table
from basketlens.llm.queries import tokenizer_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
MIXING_SEED = 8


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = docs.select(*COLUMNS)
    grammar = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, grammar)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return exact_dedup.drop_copies(docs.select(*COLUMNS))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return near_dedup.drop_near_copies(docs.select(*COLUMNS), words=5, percent=80, unnamed=True)


def draw_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return mixing.sample(docs.select(*COLUMNS), seed=MIXING_SEED)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return bpe.encode_decode(docs, tokenizer_path("word_bpe_49k.json"), outputs=("ids", "decoded_sha256"))


STAGES = [
    ("toxicity", reject_toxic),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", draw_mixture),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to `documents`; each stage's rows are written and read back."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(spark, stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs


# The learned grammar, the drawn mixture and the vocabulary have no SQL: tests/llm compares the
# pipeline with a plain version.
ORACLE_SQL = None
