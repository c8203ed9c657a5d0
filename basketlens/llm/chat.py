"""Chat formatting: collapse logged snapshots of a conversation, render what is left
(DataFrame functions only).

A chat that is logged after every turn appears as many conversations, each a prefix of the
next. Every turn is hashed with its number, role and text; the rolling hash of a prefix
is the exclusive-or of its turns' hashes (two 64-bit hashes, the number being part of
what is hashed) together with its number of turns. A conversation is dropped when its full
hash is the hash of a proper prefix of another (an anti-join), and equal ones
are one. Prefixes are summed in blocks of BLOCK_TURNS turns, so a very long conversation is
spread over tasks; keys that many conversations share (a common first turn) are counted
before they are shuffled. Texts move only for the conversations that stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

BLOCK_TURNS = 64
KEY = ["n", "x", "y"]
ROLE_OPEN, ROLE_CLOSE, TURN_END = "<|", "|>\n", "<|end|>\n"


def _turns(conversations: DataFrame) -> DataFrame:
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return (conversations.filter("conv_id IS NOT NULL AND turn IS NOT NULL")
            .select(F.col("conv_id").cast("bigint").alias("conv_id"),
                    F.col("turn").cast("bigint").alias("turn"),
                    text("role").alias("role"), text("text").alias("text")))


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, n, x, y): number of turns and hash of each prefix."""
    hashed = (turns.select("conv_id", "turn", F.xxhash64("turn", "role", "text").alias("x"),
                           F.xxhash64(F.lit(17), "text", "role", "turn").alias("y"))
              .groupBy("conv_id", "turn", "x", "y").agg(F.count(F.lit(1)).alias("copies")))
    points = (hashed.groupBy("conv_id", "turn")
              .agg(F.count(F.lit(1)).alias("n"), F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"))
              .withColumn("block", F.floor(F.col("turn") / BLOCK_TURNS)))
    inside = (Window.partitionBy("conv_id", "block").orderBy("turn")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rolling = points.select("conv_id", "turn", "block", F.sum("n").over(inside).alias("n"),
                            F.bit_xor("x").over(inside).alias("x"),
                            F.bit_xor("y").over(inside).alias("y"))
    blocks = points.groupBy("conv_id", "block").agg(
        F.sum("n").alias("bn"), F.bit_xor("x").alias("bx"), F.bit_xor("y").alias("by"))
    before = (Window.partitionBy("conv_id").orderBy("block")
              .rowsBetween(Window.unboundedPreceding, -1))
    none = F.lit(0).cast("bigint")
    offsets = blocks.select("conv_id", "block", *[
        F.coalesce(f(c).over(before), none).alias(c)
        for f, c in ((F.sum, "bn"), (F.bit_xor, "bx"), (F.bit_xor, "by"))])
    return rolling.join(offsets, ["conv_id", "block"]).select(
        "conv_id", "turn", (F.col("n") + F.col("bn")).alias("n"),
        F.col("x").bitwiseXOR(F.col("bx")).alias("x"), F.col("y").bitwiseXOR(F.col("by")).alias("y"))


def maximal(conversations: DataFrame) -> DataFrame:
    """conv_id, n_turns, n_copies of the conversations that stay; of equal ones the smallest
    conv_id stays and n_copies counts them."""
    # read three times below, so the scan and the windows run once
    points = staged(conversations.sparkSession, prefix_hashes(_turns(conversations)), "prefixes")
    full = points.groupBy("conv_id").agg(F.max(F.struct("n", "x", "y")).alias("f")).select(
        "conv_id", "f.n", "f.x", "f.y")
    whole = full.groupBy(*KEY).agg(F.min("conv_id").alias("conv_id"),
                                   F.count(F.lit(1)).alias("n_copies"))
    # every conversation gives a point at each of its lengths, one of them the full one
    points_at = points.groupBy(*KEY).agg(F.count(F.lit(1)).alias("points"))
    proper = (points_at.join(whole.select(*KEY, "n_copies"), KEY, "inner")
              .filter("points > n_copies").select(*KEY))
    return (whole.join(proper, KEY, "left_anti")
            .select("conv_id", F.col("n").alias("n_turns"), "n_copies"))


def render(conversations: DataFrame) -> DataFrame:
    """conv_id, chat: the turns in order, each with its role."""
    lines = F.transform(F.array_sort(F.collect_set(F.struct("turn", "role", "text"))), lambda t:
                        F.concat(F.lit(ROLE_OPEN), t["role"], F.lit(ROLE_CLOSE), t["text"],
                                 F.lit("\n" + TURN_END)))
    return (_turns(conversations).groupBy("conv_id")
            .agg(F.array_join(lines, "").alias("chat")))


def collapse_and_render(conversations: DataFrame) -> DataFrame:
    """conv_id, n_turns, n_copies, chat of every maximal conversation.

    Rows without conv_id or turn take no part; null role or text counts as empty; a row
    repeated in full counts once; different rows of the same turn are one step, in the order
    of role and text. Two conversations agree on a turn if number, role and text
    agree. A rendered conversation is one value of one row, so its turns meet in one task.
    Other columns are not read. An empty table gives an empty result.
    """
    stay = staged(conversations.sparkSession, maximal(conversations), "chats")
    kept = conversations.join(stay.select(F.col("conv_id").alias("stay_id")),
                              F.col("conv_id") == F.col("stay_id"), "left_semi")
    return stay.join(render(kept), "conv_id")


ORACLE_SQL = """
WITH t AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
c AS (
  SELECT conv_id, count(*) AS n, list(struct_pack(turn := turn, role := role, text := text)
                                      ORDER BY turn, role, text) AS l
  FROM t GROUP BY conv_id),
u AS (SELECT min(conv_id) AS conv_id, n, l, count(*) AS n_copies FROM c GROUP BY n, l)
SELECT conv_id, n AS n_turns, n_copies, array_to_string(
         ['<|' || x.role || '|>' || chr(10) || x.text || chr(10) || '<|end|>' || chr(10)
          FOR x IN l], '') AS chat
FROM u WHERE NOT EXISTS (
  SELECT 1 FROM u b WHERE b.l[1] = u.l[1] AND b.n > u.n AND b.l[1:u.n] = u.l)
"""
