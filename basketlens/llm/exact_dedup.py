"""Exact dedup through content-defined chunk recipes (DataFrame functions only).

A text is cut into chunks where its own content says so: a chunk ends after at least
MIN_CHUNK characters at the first place that follows a vowel, one of "nrst" and a
blank, and after MAX_CHUNK characters at the latest. Equal texts therefore have equal
chunk lists. Every chunk gets a 128-bit identifier. The identifiers are verified over
the whole corpus: chunks are grouped by (identifier, content), where each map task sends
a content once, and no identifier may have two contents; if one has, a new seed is taken.
With verified identifiers two texts are equal exactly when their identifier lists
are, so the long texts are not moved again: groups are formed on the lists.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import filled_text, staged

MIN_CHUNK, MAX_CHUNK = 256, 4096
CHUNK_PATTERN = (r"(?s).{%d,%d}?(?<=[aeiou][nrst]\x20)|.{1,%d}"
                 % (MIN_CHUNK, MAX_CHUNK, MAX_CHUNK))
MAX_SEEDS = 8


def _chunks(text):
    return F.regexp_extract_all(text, F.lit(CHUNK_PATTERN), F.lit(0))


def _identifier(chunk, seed: int):
    """128 bits as two longs: the content hashed before and after the seed."""
    return F.xxhash64(chunk, F.lit(seed)), F.xxhash64(F.lit(seed + 1), chunk)


def clashing_identifiers(texts: DataFrame, seed: int) -> DataFrame:
    """Identifiers that stand for two or more different chunk contents."""
    pieces = texts.select(F.explode(_chunks(F.col("text"))).alias("chunk"))
    high, low = _identifier(F.col("chunk"), seed)
    contents = (pieces.select(high.alias("high"), low.alias("low"), "chunk")
                .groupBy("high", "low", "chunk").agg(F.count(F.lit(1)).alias("n")))
    return (contents.groupBy("high", "low").agg(F.count(F.lit(1)).alias("n_contents"))
            .filter("n_contents > 1"))


def verified_seed(texts: DataFrame) -> int:
    for seed in range(MAX_SEEDS):
        if clashing_identifiers(texts, seed).isEmpty():
            return seed
    raise ValueError(f"no collision-free chunk identifiers under {MAX_SEEDS} seeds")


def recipes(texts: DataFrame, seed: int) -> DataFrame:
    """One row per document: doc_id, text_sha256 and the ordered identifier list."""
    ids = F.flatten(F.transform(_chunks(F.col("text")),
                                lambda c: F.array(*_identifier(c, seed))))
    return texts.select("doc_id", F.sha2("text", 256).alias("text_sha256"),
                        ids.alias("recipe"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, keep_id, group_size, kept, text_sha256.

    A null text counts as empty; all empty texts form one group with the empty recipe.
    The largest doc_id of a group stays (a null id only where the group has no other);
    of fully repeated rows (same id, same text) one stays. An empty table gives an empty
    result. Only the two named columns are read, so further columns cannot clash.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), filled_text(text_col).alias("text"))
    rows = staged(docs.sparkSession, recipes(texts, verified_seed(texts))
                  .groupBy("recipe", "text_sha256", "doc_id")
                  .agg(F.count(F.lit(1)).alias("copies")), "recipes")
    # Written out, so that both sides of the join are plain shuffles, which adaptive execution
    # splits where one group holds many rows.
    groups = staged(docs.sparkSession, rows.groupBy(F.col("recipe").alias("group_recipe"))
                    .agg(F.max("doc_id").alias("keep_id"), F.sum("copies").alias("group_size"))
                    .filter("group_size > 1"), "copy_groups")
    joined = rows.join(groups, F.col("recipe") == F.col("group_recipe"), "left")
    alone = F.col("group_size").isNull()
    return (joined
            .select("doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id"))
                    .alias("keep_id"), F.coalesce("group_size", "copies").alias("group_size"),
                    "text_sha256",
                    F.explode(F.sequence(F.lit(1).cast("bigint"), "copies")).alias("copy"))
            .select("doc_id", "keep_id", "group_size",
                    (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1))
                    .alias("kept"), "text_sha256"))


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that stay, with all their columns. Where a row is repeated
    with the same id and text, the one with the smallest other columns stays."""
    kept = (exact_dedup(docs).filter("kept")
            .select(F.col("doc_id").alias("k_id"), F.col("text_sha256").alias("k_sha")))
    sha = F.sha2(filled_text(), 256)
    rows = docs.select(F.col("doc_id").alias("g_id"), sha.alias("g_sha"),
                       F.struct(*[F.col(c) for c in docs.columns]).alias("row"))
    match = F.col("g_id").eqNullSafe(F.col("k_id")) & (F.col("g_sha") == F.col("k_sha"))
    return (rows.join(kept, match, "left_semi").groupBy("g_id", "g_sha")
            .agg(F.min("row").alias("row")).select("row.*"))


ORACLE_SQL = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""
