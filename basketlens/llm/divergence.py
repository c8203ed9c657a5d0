"""Source divergence audit: how far the term shares of a language's sources lie apart.

Terms are counted inside `mapInArrow` by Arrow kernels alone: `ascii_lower`, `split_pattern_regex`,
`dictionary_encode` and a hash `group_by` give each task a columnar shard of partial counts
(occurrences, and documents that hold the term), regrouped whenever it grows past SHARD_ROWS.
Spark merges the shards by (language, source, term), keeps the terms found in at least MIN_DOCS
documents of their language, and deals each language's terms into shards of at most SHARD_CELLS
(term, source) cells. Every shard becomes one matrix of exact shares, gives its part of the distance
between any two sources and its best terms of each source; sums and ranks over the shards finish it.

All shares are whole billionths in integer arithmetic: three rounds of long division by 1000.
A language or source that holds a third of all rows is counted by many tasks, and its terms lie in
many shards. The pairs of sources are the result itself; nothing else is squared.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import staged

MIN_DOCS, SMOOTHING, TOP_TERMS = 30, 5, 50
#: Rows of partial counts a task holds before it regroups, and before it hands them on.
SHARD_ROWS, HANDED_ON = 200_000, 400_000
#: Characters of text whose terms are held at once (a longer text is taken alone).
SLICE_CHARS = 2 << 20
#: (term, source) cells of one matrix: 4 MB of integers.
SHARD_CELLS = 500_000
#: A cut is a run of characters that are neither letters of ASCII nor beyond ASCII.
CUT = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"

_COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()),
                     ("n", pa.int64()), ("docs", pa.int64())])
COUNTS_SCHEMA = "lang string, source string, term string, n bigint, docs bigint"
_KEYS = ["lang", "source", "term"]


def count_batch(batch: pa.RecordBatch) -> pa.Table:
    """Partial counts of one batch of (lang, source, text). Each (lang, source) of the batch also gives
    a row with a null term, so that a group without any term is known."""
    table = pa.Table.from_batches([batch])
    groups = table.select(["lang", "source"]).group_by(["lang", "source"]).aggregate([])
    marks = groups.append_column("term", pa.nulls(groups.num_rows, pa.string()))
    marks = marks.append_column("n", pa.array(np.zeros(groups.num_rows, np.int64)))
    marks = marks.append_column("docs", marks.column("n")).cast(_COUNTS)
    terms = pc.split_pattern_regex(pc.ascii_lower(batch.column("text")), CUT)
    row, term = pc.list_parent_indices(terms), pc.list_flatten(terms).dictionary_encode()
    # The cut leaves an empty string where a text begins or ends with one.
    full = pc.not_equal(pc.take(pc.binary_length(term.dictionary), term.indices), 0)
    found = pa.table({"row": row.filter(full), "term": term.indices.filter(full)})
    found = found.group_by(["row", "term"]).aggregate([([], "count_all")])
    lang, source = (batch.column(c).dictionary_encode() for c in ("lang", "source"))
    found = pa.table({"lang": pc.take(lang.indices, found["row"]), "term": found["term"],
                      "source": pc.take(source.indices, found["row"]), "n": found["count_all"]})
    found = found.group_by(_KEYS).aggregate([("n", "sum"), ([], "count_all")])
    counts = pa.table({
        "lang": pc.take(lang.dictionary, found["lang"]),
        "source": pc.take(source.dictionary, found["source"]),
        "term": pc.take(term.dictionary, found["term"]), "n": found["n_sum"], "docs": found["count_all"]})
    return pa.concat_tables([marks, counts.cast(_COUNTS)])


def regroup(shards: list[pa.Table]) -> pa.Table:
    merged = pa.concat_tables(shards).group_by(_KEYS).aggregate([("n", "sum"), ("docs", "sum")])
    return merged.rename_columns([*_KEYS, "n", "docs"]).cast(_COUNTS)


def slices(batches):
    """The rows of the batches in slices of about SLICE_CHARS characters, so that the terms of a slice
    stay small whatever the batches are."""
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False))
        cuts = np.flatnonzero(np.diff(ends // SLICE_CHARS)) + 1 if len(ends) else []
        for start, stop in zip([0, *cuts], [*cuts, batch.num_rows]):
            if stop > start:
                yield batch.slice(start, stop - start)


def _partial_counts(batches):
    shards, fresh = [], 0
    for batch in slices(batches):
        shards.append(count_batch(batch))
        fresh += shards[-1].num_rows
        if fresh >= SHARD_ROWS:
            shards = [regroup(shards)]
            fresh = 0
            if shards[0].num_rows >= HANDED_ON:
                yield from shards.pop().to_batches(max_chunksize=50_000)
    if shards:
        yield from regroup(shards).to_batches(max_chunksize=50_000)


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n occurrences, docs documents with it) over all rows; a null term marks each
    group that occurs. Null lang, source or text reads as the empty string."""
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
                         for c in ("lang", "source", "text")])
    parts = rows.mapInArrow(_partial_counts, COUNTS_SCHEMA)
    return parts.groupBy(*_KEYS).agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: np.ndarray, total) -> np.ndarray:
    """1 + floor(10^9 * count / total), exact for totals up to 9 * 10^15."""
    whole, rest = np.divmod(np.asarray(count, np.int64), total)
    for _ in range(3):
        digits, rest = np.divmod(rest * 1000, total)
        whole = whole * 1000 + digits
    return whole + 1


_SHARD_RESULT = "lang string, source string, part string, item string, value bigint"


def shard_divergence(terms: pd.DataFrame, groups: pd.DataFrame) -> pd.DataFrame:
    """One shard: its share of the distance between any two sources of the language, and each
    source's TOP_TERMS best terms of the shard."""
    if groups.empty:
        return pd.DataFrame(columns=["lang", "source", "part", "item", "value"])
    groups = groups.sort_values("source")
    lang, kept = groups["lang"].iloc[0], int(groups["kept"].iloc[0])
    sources, totals = groups["source"].to_numpy(object), groups["total"].to_numpy(np.int64)
    names = terms["term"].to_numpy(object)
    counts = np.zeros((len(sources), len(names)), np.int64)
    for column, (own, n) in enumerate(zip(terms["sources"], terms["counts"])):
        counts[np.searchsorted(sources, np.asarray(own, object)), column] = n
    p = share(counts + SMOOTHING, (totals + SMOOTHING * max(kept, 1))[:, None])
    lang_n = terms["n"].to_numpy(np.int64)
    q = share(lang_n + SMOOTHING, int(groups["lang_total"].iloc[0]) + SMOOTHING * max(kept, 1))
    found = []
    for i, source in enumerate(sources):
        apart = np.abs(p - p[i]).sum(axis=1)
        found.append(pd.DataFrame({"source": source, "part": "pair", "item": np.delete(sources, i),
                                   "value": np.delete(apart, i)}))
        over = np.flatnonzero((counts[i] > 0) & (p[i] > q))
        order = sorted(over, key=lambda t: (q[t] - p[i][t], names[t]))[:TOP_TERMS]
        found.append(pd.DataFrame({"source": source, "part": "term", "item": names[order],
                                   "value": (p[i] - q)[order]}))
    out = pd.concat(found, ignore_index=True)
    return out.assign(lang=lang)[["lang", "source", "part", "item", "value"]]


def audit(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """Rows (lang, source, part, item, value, rank).

    `pair`: the distance of a source's shares to those of each other source of its language, over all
    kept terms. `term`: the TOP_TERMS terms whose share in the source lies furthest over the language's.
    Ranks count from 1 per language, source and part, larger values first, ties by item.

    Null lang, source and text read as the empty string, which is a language or source of its own.
    Every row counts as a document, repeated ones too. Groups without kept terms have pairs of value
    0 where the language keeps none. Other columns are not read. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    counts = staged(spark, term_counts(docs), "term_counts")
    terms = staged(spark, counts.filter("term IS NOT NULL").groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("n"),
        F.collect_list(F.struct("source", "n")).alias("parts"))
        .filter(F.col("docs") >= min_docs)
        .select("lang", "term", "n", "parts"), "kept_terms")
    langs = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("n").alias("lang_total"))
    own = (terms.select("lang", F.explode("parts").alias("p")).groupBy("lang", F.col("p.source").alias("source"))
           .agg(F.sum("p.n").alias("total")))
    groups = (counts.filter("term IS NULL").select("lang", "source").join(own, ["lang", "source"], "left")
              .join(langs, "lang", "left")
              .join(counts.filter("term IS NULL").groupBy("lang").agg(F.count(F.lit(1)).alias("n_sources")), "lang")
              .select("lang", "source", *[F.coalesce(c, F.lit(0)).alias(c)
                                          for c in ("total", "kept", "lang_total")],
                      F.greatest(F.lit(1), F.ceil(F.coalesce("kept", F.lit(0)) * F.col("n_sources")
                                                  / F.lit(SHARD_CELLS))).alias("shards")))
    groups = staged(spark, groups, "groups")
    shards = groups.select("lang", "shards").distinct()
    left = (terms.join(shards, "lang").withColumn("shard", F.pmod(F.xxhash64("term"), F.col("shards")))
            .select("lang", "shard", "term", "n", F.col("parts.source").alias("sources"),
                    F.col("parts.n").alias("counts")))
    right = groups.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("shards") - 1)))
    parts = (left.groupBy("lang", "shard").cogroup(right.groupBy("lang", "shard"))
             .applyInPandas(shard_divergence, _SHARD_RESULT))
    parts = staged(spark, parts, "shard_divergences")
    pairs = (parts.filter("part = 'pair'").groupBy("lang", "source", "part", "item")
             .agg(F.sum("value").alias("value")))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = (pairs.withColumn("rank", F.row_number().over(order)).unionByName(
        parts.filter("part = 'term'").withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= TOP_TERMS)))
    return ranked.select("lang", "source", "part", "item", "value", "rank")


ORACLE_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
           FROM documents),
w AS (SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
c AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT r) AS docs FROM w GROUP BY ALL),
k AS (SELECT lang, term, sum(n) AS n FROM c GROUP BY ALL HAVING sum(docs) >= {MIN_DOCS}),
g AS (SELECT DISTINCT lang, source FROM d),
lt AS (SELECT lang, count(*) AS v, sum(n) AS total FROM k GROUP BY lang),
gt AS (SELECT g.lang, g.source, coalesce(sum(c.n) FILTER (k.term IS NOT NULL), 0) AS total
       FROM g LEFT JOIN c USING (lang, source) LEFT JOIN k ON k.lang = c.lang AND k.term = c.term GROUP BY ALL),
p AS (SELECT gt.lang, gt.source, k.term, coalesce(c.n, 0) AS n,
             1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + {SMOOTHING})) // (gt.total + {SMOOTHING} * lt.v) AS p,
             1 + (1000000000::HUGEINT * (k.n + {SMOOTHING})) // (lt.total + {SMOOTHING} * lt.v) AS q
      FROM gt JOIN k USING (lang) JOIN lt USING (lang)
      LEFT JOIN c ON c.lang = gt.lang AND c.source = gt.source AND c.term = k.term),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(sum(abs(x.p - y.p)), 0) AS value
          FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN p x ON x.lang = a.lang AND x.source = a.source
          LEFT JOIN p y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term GROUP BY ALL),
found AS (SELECT lang, source, 'pair' AS part, item, value FROM pairs
          UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part
                                        ORDER BY value DESC, encode(item)) AS rank FROM found)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
FROM ranked WHERE part = 'pair' OR rank <= {TOP_TERMS}
"""
