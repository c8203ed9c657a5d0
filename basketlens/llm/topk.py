"""Exact top-k search by inner product: tiled matrix products, partial selection in each
tile, tree merging of the per-query lists.

The candidates are dealt over shards of about `shard_rows` rows and the queries over
blocks of about `block_rows`; every (block, shard) pair is one tile, computed by one
matrix product in one task. A tile holds block_rows + shard_rows vectors whatever the
size of the table, and it returns k rows per query.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE = 256
FAN_IN = 16
LIST_SCHEMA = "query_id bigint, tile bigint, top array<struct<order:binary,vec_id:bigint,score:bigint>>"
NONE = -np.inf


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Rows with an id and a vector whose components are all finite, also when scaled."""
    x = F.col(vector_col).cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) * SCALE < float("inf")))
    return (vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), x.alias("x"))
            .filter(F.col("vec_id").isNotNull() & F.col("x").isNotNull() & finite))


def _matrices(tbl: pa.Table):
    """(dimension, ids, quantised matrix) for each vector length in a group of
    (tile, id, vector) rows; rows in id order."""
    if tbl.num_rows == 0:
        return
    ids = tbl.column(1).to_numpy()
    lists = tbl.column(2).combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = pa.concat_arrays(lists.chunks)
    size = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    start = np.concatenate(([0], np.cumsum(size)[:-1]))
    for dim in np.unique(size):
        rows = np.flatnonzero(size == dim)
        rows = rows[np.argsort(ids[rows], kind="stable")]
        matrix = flat[start[rows][:, None] + np.arange(dim)]
        yield int(dim), ids[rows], np.floor(SCALE * matrix)


def _scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact integer inner products. Float products are exact while every partial sum
    is below 2**53; larger values are multiplied as Python integers."""
    bound = max(1, q.shape[1]) * (np.abs(q).max(initial=0) * np.abs(c).max(initial=0))
    if bound < 2 ** 53:
        return q @ c.T
    ints = lambda m: np.array([[int(v) for v in r] for r in m], dtype=object)
    return ints(q) @ ints(c).T


def order_key(score: int) -> bytes:
    """Bytes that sort as -score does, for integers of any size: sign, length, digits."""
    size = (abs(score).bit_length() + 7) // 8
    digits = size.to_bytes(4, "big") + abs(score).to_bytes(size, "big")
    return b"\x01" + digits if score < 0 else b"\x00" + bytes(255 - b for b in digits)


def as_long(score: int) -> int:
    return max(-2 ** 63, min(2 ** 63 - 1, score))


def _best(scores: np.ndarray, qids: np.ndarray, cids: np.ndarray, k: int):
    """Per query the k best (score, vec_id); candidates are in id order, so the first
    maximum is the tie's smaller id. The query's own id takes no part."""
    low, high = np.searchsorted(cids, qids, "left"), np.searchsorted(cids, qids, "right")
    for row in np.flatnonzero(high > low):
        scores[row, low[row]:high[row]] = NONE
    found: dict[int, list] = {}
    at = np.arange(len(qids))
    for _ in range(min(k, scores.shape[1])):
        pick = scores.argmax(axis=1)
        value = scores[at, pick]
        for row in np.flatnonzero(value != NONE):
            found.setdefault(int(qids[row]), []).append((-int(value[row]), int(cids[pick[row]])))
        scores[at, pick] = NONE
    return found


def _tile(k: int):
    def run(key, queries: pa.Table, shard: pa.Table) -> pa.Table:
        tile = key[0].as_py()
        cands = {dim: (ids, m) for dim, ids, m in _matrices(shard)}
        lists: dict[int, list] = {}
        for dim, qids, q in _matrices(queries):
            if dim in cands:
                cids, c = cands[dim]
                for query, best in _best(_scores(q, c), qids, cids, k).items():
                    lists[query] = sorted(lists.get(query, []) + best)[:k]
        return pa.table({
            "query_id": pa.array(list(lists), pa.int64()),
            "tile": pa.array([tile] * len(lists), pa.int64()),
            "top": pa.array([[{"order": order_key(-n), "vec_id": v, "score": as_long(-n)} for n, v in x]
                             for x in lists.values()],
                            pa.list_(pa.struct([("order", pa.binary()), ("vec_id", pa.int64()),
                                                ("score", pa.int64())])))})
    return run


def merge_lists(lists: DataFrame, tiles: int, k: int) -> DataFrame:
    """Merge per-tile lists FAN_IN tiles at a time until one list per query is left."""
    while True:
        tiles = -(-tiles // FAN_IN)
        lists = (lists.groupBy("query_id", F.expr(f"tile div {FAN_IN}").alias("tile"))
                 .agg(F.slice(F.array_sort(F.flatten(F.collect_list("top"))), 1, k)
                      .alias("top")))
        if tiles <= 1:
            return lists


def top_k(vectors: DataFrame, is_query, k: int = 5, id_col: str = "vec_id",
          vector_col: str = "embedding", shard_rows: int = 8192,
          block_rows: int = 2048) -> DataFrame:
    """query_id, rank, vec_id, score: the k best candidates of each query row.

    Components become floor(256 * x). Ranks go by the exact integer scores, of whatever size; the
    score given back is held to the range of a long. Ties go to the smaller vec_id. Rows without an id,
    without a vector or with a component that is null or not finite (or 256 times it) take no part; vectors are
    only compared with vectors of the same length. Rows that share a query's id are its
    own and are not its candidates; query rows that share an id are pooled into one
    list; repeated candidate ids each count. A query without candidates gives no row.
    """
    rows = usable(vectors, id_col, vector_col)
    queries = rows.filter(is_query(F.col("vec_id")))
    shards = max(1, -(-rows.count() // shard_rows))
    blocks = max(1, -(-queries.count() // block_rows))
    deal = F.monotonically_increasing_id()          # by row, so repeated ids are spread too
    left = (queries.withColumn("block", F.pmod(F.xxhash64(deal), F.lit(blocks)))
            .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))))
    right = (rows.withColumn("shard", F.pmod(F.xxhash64(deal), F.lit(shards)))
             .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))))
    tile = (F.col("block") * shards + F.col("shard")).cast("bigint")
    left = left.select(tile.alias("q_tile"), F.col("vec_id").alias("q_id"), F.col("x").alias("q_x"))
    right = right.select(tile.alias("c_tile"), F.col("vec_id").alias("c_id"), F.col("x").alias("c_x"))
    lists = (left.groupBy("q_tile").cogroup(right.groupBy("c_tile"))
             .applyInArrow(_tile(k), LIST_SCHEMA))
    merged = merge_lists(lists, shards * blocks, k)
    return (merged.select("query_id", F.posexplode("top").alias("pos", "hit"))
            .select("query_id", (F.col("pos") + 1).cast("int").alias("rank"),
                    F.col("hit.vec_id").alias("vec_id"), F.col("hit.score").alias("score")))


ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.e) = len(c.e)),
ranked AS (
  SELECT query_id, vec_id, score,
         row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
  FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""
