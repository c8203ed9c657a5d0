"""MinHash near-dedup with sequential Bayesian verification.

Every text becomes its set of word shingles and 128 MinHash values, cut into 32 bands of 4;
two sets of similarity 0.8 share a band with probability 1 - 5e-8. Texts with the same
set are one class, with the smallest doc_id as its representative. Representatives that share
a band are candidates. A candidate's signatures are compared in batches of 32 values;
after each batch the posterior probability (uniform prior) that the similarity reaches the
threshold is bounded, and the pair is given up once it falls under MISS. Survivors are
verified exactly on the full sets.

Only components are asked for, so a bucket is not expanded into all its pairs. In STAR_ROUNDS
rounds every bucket compares its members with one hub (another one each round), and what is
linked by then need not be compared again. In what is left, the members outside a bucket's
largest component are compared with all members of other components, in blocks of about BLOCK x
BLOCK members, so every pair that could still join two components is looked at and no bucket is
held whole. Candidates are not written out: a block pair verifies its own survivors, the most
alike first, and gives the links that join components.
"""

from __future__ import annotations

import hashlib
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import filled_text, staged
from .graph import components
from .shingles import mix, shingle_set

LANES, BANDS = 128, 32
BATCH = 32
MISS = 1e-6
STAR_ROUNDS = 2
BLOCK = 512
_RNG = np.random.Generator(np.random.PCG64(20240607))
_A = _RNG.integers(0, 1 << 63, LANES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RNG.integers(0, 1 << 63, LANES, dtype=np.uint64)


def minhash(shingle_hashes: np.ndarray) -> np.ndarray:
    """128 MinHash values of a set that is not empty."""
    low = np.full(LANES, 0xFFFFFFFF, dtype=np.uint64)
    for at in range(0, len(shingle_hashes), 1024):
        part = shingle_hashes[at:at + 1024, None]
        np.minimum(low, ((part * _A + _B) >> np.uint64(32)).min(axis=0), out=low)
    return low


def band_keys(signature: np.ndarray) -> np.ndarray:
    rows = signature.reshape(BANDS, -1)
    h = np.arange(1, BANDS + 1, dtype=np.uint64)
    for c in range(rows.shape[1]):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + rows[:, c])
    return h.view(np.int64)


def fewest_matches(threshold: float, miss: float = MISS) -> dict[int, int]:
    """For each number n of compared values, the fewest matches that keep a pair: with a
    uniform prior P(similarity >= t | m of n match) is P(Binomial(n + 1, t) <= m)."""
    out = {}
    for n in range(BATCH, LANES + 1, BATCH):
        total, m = 0.0, -1
        while total < miss:
            m += 1
            total += comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
        out[n] = m
    return out


def survivors(left: np.ndarray, right: np.ndarray, least: dict[int, int]) -> np.ndarray:
    """Which row pairs of two signature matrices stay after all batches."""
    alive = np.arange(len(left))
    matches = np.zeros(len(left), dtype=np.int32)
    for n in range(BATCH, LANES + 1, BATCH):
        part = slice(n - BATCH, n)
        matches = matches + (left[alive, part] == right[alive, part]).sum(axis=1)
        keep = matches >= least[n]
        alive, matches = alive[keep], matches[keep]
    return alive


def _summaries(k: int):
    def run(batches):
        for batch in batches:
            sizes, prints, bands = [], [], []
            for text in batch.column(1).to_pylist():
                own = shingle_set(text, k)
                sizes.append(len(own))
                prints.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest())
                bands.append(band_keys(minhash(own)) if len(own) else [])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(prints, pa.binary()),
                 pa.array(bands, pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "print", "bands"])
    return run


def _full_sets(k: int):
    def run(batches):
        for batch in batches:
            sets = [shingle_set(t, k) for t in batch.column(1).to_pylist()]
            signatures = [minhash(s).astype("<u4").tobytes() for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(signatures, pa.binary()),
                 pa.array([s.tobytes() for s in sets], pa.binary())], names=["rid", "sig", "set"])
    return run


def _prune(least):
    def run(batches):
        for batch in batches:
            if batch.num_rows == 0:
                continue
            left, right = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u4")
                           .reshape(-1, LANES) for c in (2, 3))
            keep = pa.array(survivors(left, right, least), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(keep), batch.column(1).take(keep)], names=["a", "b"])
    return run


def _verify(percent: int):
    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                s, t = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (x, y))
                both = len(np.intersect1d(s, t, assume_unique=True))
                keep.append(100 * both >= percent * (len(s) + len(t) - both))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])
    return run


def _by_block(handle):
    """Feed rows (bucket, band, lb, rb, side, rid, label, sig, ...), sorted by block pair, to
    handle(key, lefts, rights) one block pair at a time."""
    def run(batches):
        key, rows = None, ([], [])
        for batch in batches:
            for bucket, band, lb, rb, side, *row in zip(*[c.to_pylist() for c in batch.columns]):
                if (bucket, lb, rb) != key:
                    if rows[0] and rows[1]:
                        yield from handle(key, *rows)
                    key, rows = (bucket, lb, rb), ([], [])
                rows[side].append((band, *row))
        if rows[0] and rows[1]:
            yield from handle(key, *rows)
    return run


def _open_pairs(lefts, rights, least):
    """Index pairs of two blocks with different labels that survive the batches and share no
    earlier band, and their matches: every pair is looked at in one bucket only."""
    band = lefts[0][0]
    label = [np.array([r[2] for r in side]) for side in (lefts, rights)]
    left, right = (np.frombuffer(b"".join([r[3] for r in side]), "<u4").reshape(-1, LANES)
                   for side in (lefts, rights))
    ids = [np.array([r[1] for r in side]) for side in (lefts, rights)]
    once = dict(zip(ids[0].tolist(), range(len(lefts))))
    rows_at_once = max(1, (1 << 16) // len(rights))
    for at in range(0, len(lefts), rows_at_once):
        i, j = np.nonzero(label[0][at:at + rows_at_once, None] != label[1][None, :])
        i = i + at
        keep = survivors(left[i], right[j], least)
        i, j = i[keep], j[keep]
        same = left[i] == right[j]
        bands = same.reshape(-1, BANDS, LANES // BANDS).all(axis=2)
        new = ~bands[:, :band].any(axis=1)
        # two members outside the main component meet from both sides: take one
        both = np.array([ids[1][y] in once and ids[1][y] < ids[0][x] for x, y in zip(i, j)], dtype=bool)
        keep = new & ~both
        yield i[keep], j[keep], same[keep].sum(axis=1)


def _involved(least):
    """The rows of block pairs that have an open pair."""
    def handle(key, lefts, rights):
        rows = ([], [])
        for i, j, _ in _open_pairs(lefts, rights, least):
            rows[0].append(i)
            rows[1].append(j)
        for side, found, own in ((0, rows[0], lefts), (1, rows[1], rights)):
            at = np.unique(np.concatenate(found)) if found else []
            if len(at):
                columns = list(zip(*[own[k] for k in at]))
                n = len(at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in (
                        ([key[0]] * n, pa.int64()), (columns[0], pa.int32()),
                        ([key[1]] * n, pa.int64()), ([key[2]] * n, pa.int64()),
                        ([side] * n, pa.int32()), (columns[1], pa.int64()), (columns[2], pa.int64()))],
                    names=["bucket", "band", "lb", "rb", "side", "rid", "label"])
    return _by_block(handle)


def _block_links(least, percent: int):
    """Links that join components, verified on the full sets, most matches first. What is joined
    already, here or before, is not verified again."""
    def handle(key, lefts, rights):
        parent: dict[int, int] = {}

        def root(x):
            while x in parent:
                x = parent[x]
            return x
        sets = [[np.frombuffer(r[4], dtype=np.uint64) for r in side] for side in (lefts, rights)]
        links = []
        pairs = [np.concatenate(c) for c in zip(*_open_pairs(lefts, rights, least))] or [[]] * 3
        for at in np.argsort(-np.asarray(pairs[2]), kind="stable"):
            i, j = int(pairs[0][at]), int(pairs[1][at])
            x, y = root(lefts[i][2]), root(rights[j][2])
            if x != y:
                s, t = sets[0][i], sets[1][j]
                both = len(np.intersect1d(s, t, assume_unique=True))
                if 100 * both >= percent * (len(s) + len(t) - both):
                    parent[x] = y
                    links.append((lefts[i][1], rights[j][1]))
        if links:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*links)],
                                             names=["a", "b"])
    return _by_block(handle)


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that are links, after the batches and the exact check."""
    one = lambda name, col: sets.select(F.col("rid").alias(name), F.col(col).alias(f"{col}_{name}"))
    with_sig = pairs.join(one("a", "sig"), "a").join(one("b", "sig"), "b")
    pairs = (with_sig.select("a", "b", "sig_a", "sig_b")
             .mapInArrow(_prune(fewest_matches(percent / 100)), "a bigint, b bigint"))
    pairs = staged(pairs.sparkSession, pairs, "near_pairs")
    with_set = pairs.join(one("a", "set"), "a").join(one("b", "set"), "b")
    return (with_set.select("a", "b", "set_a", "set_b")
            .mapInArrow(_verify(percent), "a bigint, b bigint"))


def _relabel(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after joining the components that links connect."""
    spark = labels.sparkSession
    side = lambda n: labels.select(F.col("rid").alias(n), F.col("label").alias(f"l{n}"))
    joined = links.join(side("a"), "a").join(side("b"), "b").select("la", "lb")
    roots = components(joined, "la", "lb")
    return staged(spark, labels.join(roots, F.col("label") == F.col("node"), "left")
                  .select("rid", F.coalesce("root", "label").alias("label")), "near_labels")


def _unresolved(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members (bucket, band, rid, label) of buckets that hold more than one component."""
    rows = members.join(labels, "rid")
    mixed = (rows.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
             .filter("lo <> hi").select("bucket"))
    return rows.join(mixed, "bucket", "left_semi").select("bucket", "band", "rid", "label")


def _remaining_links(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) across components in unresolved buckets. Block pairs are compared by signature
    first; full sets are fetched only for the rows that have an open pair there."""
    least = fewest_matches(percent / 100)
    counts = rows.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("n"))
    per = (counts.groupBy("bucket")
           .agg(F.sum("n").alias("size"), F.max(F.struct("n", "label")).alias("top"))
           .select("bucket", F.col("top.label").alias("main"),
                   F.ceil(F.col("size") / BLOCK).alias("right_blocks"),
                   F.ceil((F.col("size") - F.col("top.n")) / BLOCK).alias("left_blocks")))
    rows = rows.join(per, "bucket")
    span = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    deal = lambda n: F.pmod(F.xxhash64("rid", F.lit(n)), F.col(n))
    lefts = (rows.filter("label <> main").withColumn("lb", deal("left_blocks"))
             .withColumn("rb", span("right_blocks")).withColumn("side", F.lit(0)))
    rights = (rows.withColumn("rb", deal("right_blocks"))
              .withColumn("lb", span("left_blocks")).withColumn("side", F.lit(1)))
    columns = ["bucket", "band", "lb", "rb", "side", "rid", "label"]

    def dealt(blocks: DataFrame, *what: str) -> DataFrame:
        return (blocks.join(sets.select("rid", *what), "rid").select(*columns, *what)
                .repartition("bucket", "lb", "rb").sortWithinPartitions("bucket", "lb", "rb"))

    blocks = lefts.select(*columns).unionByName(rights.select(*columns))
    involved = dealt(blocks, "sig").mapInArrow(
        _involved(least), "bucket bigint, band int, lb bigint, rb bigint, side int, rid bigint, "
                          "label bigint")
    involved = staged(sets.sparkSession, involved, "near_open")
    return dealt(involved, "sig", "set").mapInArrow(_block_links(least, percent), "a bigint, b bigint")


def near_dedup(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, n_shingles, component_id, kept.

    Links join sets with 100 * intersection >= percent * union. A text without words (null,
    empty, blank) has an empty set and no link. Equal sets are one class, so copies and
    repeated rows share a component; rows that repeat an id with another text are judged by
    their own text.
    A row without an id joins the class of its set, never gives its name, and is not kept.
    Whole texts are read; only the two named columns are, so others cannot clash.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                        filled_text(text_col).alias("text"))
    rows = staged(spark, texts.mapInArrow(
        _summaries(words), "doc_id bigint, n_shingles bigint, print binary, bands array<bigint>"),
        "near_rows")
    # Written out, so that joins with it are plain shuffles, which can be split at a hot class.
    classes = staged(spark, rows.filter("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("print")
                     .agg(F.min(F.struct("doc_id", "bands")).alias("low"))
                     .select("print", F.col("low.doc_id").alias("rid"), "low.bands"), "near_classes")
    banded = classes.select("rid", F.posexplode("bands").alias("band", "bucket"))
    shared = banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = staged(spark, banded.join(shared.select("bucket"), "bucket", "left_semi")
                     .select("bucket", "band", "rid"), "near_members")
    active = members.select("rid").distinct()
    sets = staged(spark, texts.join(active, F.col("doc_id") == F.col("rid"), "left_semi")
                  .select("doc_id", "text")
                  .mapInArrow(_full_sets(words), "rid bigint, sig binary, set binary"), "near_sets")
    labels = staged(spark, active.withColumn("label", F.col("rid")), "near_labels")
    for turn in range(STAR_ROUNDS):
        open_rows = _unresolved(members, labels)
        hubs = open_rows.groupBy("bucket").agg(
            F.min(F.struct(F.xxhash64("rid", F.lit(turn)), "rid", F.col("label").alias("hub_label")))
            .alias("hub")).select("bucket", F.col("hub.rid").alias("hub"), "hub.hub_label")
        pairs = (open_rows.join(hubs, "bucket").filter("label <> hub_label")
                 .select(F.least("rid", "hub").alias("a"), F.greatest("rid", "hub").alias("b"))
                 .distinct())
        labels = _relabel(labels, verified(pairs, sets, percent))
    labels = _relabel(labels, _remaining_links(_unresolved(members, labels), sets, percent))
    named = classes.select(F.col("print").alias("c_print"), F.col("rid").alias("c_rid"))
    joined = (rows.join(named, (F.col("print") == F.col("c_print")) & (F.col("n_shingles") > 0), "left")
              .join(labels, F.col("c_rid") == F.col("rid"), "left"))
    root = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.coalesce("label", "c_rid"))
    return joined.select("doc_id", "n_shingles", root.alias("component_id"),
                         F.coalesce(F.col("doc_id") == root, F.lit(False)).alias("kept"))


def drop_near_copies(docs: DataFrame, words: int = 5, percent: int = 80,
                     unnamed: bool = False) -> DataFrame:
    """The rows of `docs` whose id is kept for one of its texts; rows that repeat an id stay
    together. Rows without an id go, or, with `unnamed`, are judged like others: one row stays of
    each group that has no id (the one whose text has the smallest number)."""
    if unnamed:
        ids = F.col("doc_id").cast("bigint")
        top, without = docs.agg(F.max(ids), F.count_if(ids.isNull())).first()
        if without:
            return _drop_numbered(docs, words, percent, -1 if top is None else top)
    kept = near_dedup(docs, words, percent).filter("kept").select("doc_id").distinct()
    return docs.join(kept, "doc_id", "left_semi")


def _drop_numbered(docs: DataFrame, words: int, percent: int, top: int) -> DataFrame:
    """drop_near_copies with a number above all ids, by its text, for each row without an id."""
    number = F.lit(top + 1) + F.pmod(F.xxhash64(filled_text()), F.lit((1 << 63) - 1 - max(top, 0)))
    rows = docs.select(F.struct(*docs.columns).alias("row"), filled_text().alias("text"),
                       F.coalesce(F.col("doc_id").cast("bigint"), number).alias("doc_id"))
    kept = staged(docs.sparkSession, near_dedup(rows, words, percent).filter("kept")
                  .select("doc_id").distinct(), "near_kept")
    stay = rows.select("row", "doc_id").join(kept, "doc_id", "left_semi")
    one = stay.filter("row.doc_id IS NULL").groupBy("doc_id").agg(F.min("row").alias("row"))
    return (stay.filter("row.doc_id IS NOT NULL").select("row.*").unionByName(one.select("row.*")))


ORACLE_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                     'abcdefghijklmnopqrstuvwxyz'),
           '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN []
           WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
           ELSE [array_to_string(ws[i:i+3], ' ') FOR i IN range(1, len(ws) - 2)] END) AS g
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
      FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b
      WHERE 100 * p.c >= 80 * (x.n + y.n - p.c)),
both_ways AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
reach(node, seen) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT r.node, t.b FROM reach r JOIN both_ways t ON t.a = r.seen)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, min(r.seen) AS component_id,
       d.doc_id = min(r.seen) AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN reach r ON r.node = d.doc_id
GROUP BY d.doc_id, n.n
"""
