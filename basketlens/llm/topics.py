"""Topics of texts from clusters of their words.

The model is fitted on every document (rows alike in id and text are one document, their words counted
together): the VOCABULARY most widespread words, weighted by rarity, give each document a direction;
spherical k-means finds TOPICS centres, and every word joins the centre where it is most over-represented.
A text's topic is the cluster with the largest summed word weight. The counts of the documents' words are written
once, many texts packed in a row, and read by each round; a round's sums are added as integers, so that they do
not depend on how the rows lie in tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import filled_text, staged
from .divergence import slices

VOCABULARY, TOPICS, ROUNDS = 4_096, 8, 25
UNIT = 1 << 30      # a weight of 1 in the sums of a round
JOINED = 400_000    # sets memory and speed only
#: The factor of a word for its count in a text; larger counts are not looked up.
LOGS = 1 + np.log(np.maximum(np.arange(1 << 8), 1))
PACK = 1 << 16      # sets memory and speed only
#: Rows of packed texts are large, so fewer of them are read together.
PACKED = {"parquet.block.size": str(16 << 20)}
EMPTY, NONE = "empty", "none"


@dataclass(frozen=True)
class TopicModel:
    words: tuple[str, ...]
    cluster: tuple[int, ...]
    weight: tuple[float, ...]


def _split(texts: pa.Array):
    """(row, word) of every word of the texts, A-Z lower-cased."""
    words = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    row, word = pc.list_parent_indices(words).to_numpy(), pc.list_flatten(words)
    full = pc.not_equal(pc.binary_length(word), 0)
    return row[full.to_numpy(zero_copy_only=False)], word.filter(full)


def _distinct(keys: np.ndarray):
    """The distinct keys in order, and where each begins among the sorted ones, with the number of keys at the
    end."""
    keys = np.sort(keys)
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))[:len(keys)])
    return keys[first], np.append(first, len(keys))


def _spread(batches):
    """(word, df): in how many of some texts a word is. Slices are joined up to JOINED words."""
    def joined(parts):
        return pa.concat_tables(parts).group_by("word").aggregate([("df", "sum")]).rename_columns(["word", "df"])
    parts, fresh = [], 0
    for batch in slices(batches):
        row, word = _split(batch.column("text"))
        coded = word.dictionary_encode()
        own, _ = _distinct(row * max(len(coded.dictionary), 1) + coded.indices.to_numpy())
        df = np.bincount(own % max(len(coded.dictionary), 1), minlength=len(coded.dictionary))
        parts.append(pa.table([coded.dictionary, pa.array(df)], names=["word", "df"]))
        fresh += len(df)
        if fresh >= JOINED:
            parts, fresh = [joined(parts)], 0
            if parts[0].num_rows >= JOINED:
                yield from parts.pop().to_batches(max_chunksize=50_000)
    if parts:
        yield from joined(parts).to_batches(max_chunksize=50_000)


def _counted(words: tuple[str, ...]):
    """The known words of the texts with their counts. A row has texts with about PACK words as packed numbers: d
    and the number of words of each, and their words and counts one text after another; texts without a known
    word are left out."""
    def run(batches):
        known = pa.array(words, pa.string())
        for batch in slices(batches):
            row, word = _split(batch.column("text"))
            at = pc.fill_null(pc.index_in(word, value_set=known), -1).to_numpy()
            own, first = _distinct(row[at >= 0] * len(words) + at[at >= 0])
            if not len(own):
                continue
            row = own // len(words)
            n = np.diff(first) * batch.column("copies").to_numpy()[row]
            texts, first = _distinct(row)
            d, sizes, own = batch.column("d").to_numpy()[texts], np.diff(first), (own % len(words)).astype(np.uint16)
            n = n.astype(np.uint8 if n.max() < len(LOGS) else np.int64)
            cuts = np.flatnonzero(np.diff(first[1:] // PACK)) + 1
            parts = [(d[a:b], sizes[a:b], own[first[a]:first[b]], n[first[a]:first[b]])
                     for a, b in zip([0, *cuts], [*cuts, len(d)])]
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes() for x in c], pa.binary()) for c in zip(*parts)],
                                             names=["d", "sizes", "words", "counts"])
    return run


def _weighed(batches, rarity: np.ndarray):
    """(d, ends, words, weights) of each row of _counted; a text's words end at its end, and their weights
    are a unit vector."""
    for batch in batches:
        for d, sizes, words, counts in zip(*(c.to_pylist() for c in batch.columns)):
            sizes, words = np.frombuffer(sizes, np.int64), np.frombuffer(words, np.uint16)
            weight = (LOGS[np.frombuffer(counts, np.uint8)] if len(counts) == len(words)
                      else 1 + np.log(np.frombuffer(counts, np.int64))) * rarity[words]
            row = np.repeat(np.arange(len(sizes)), sizes)
            length = np.sqrt(np.bincount(row, weight * weight, minlength=len(sizes)))
            yield np.frombuffer(d, np.int64), np.cumsum(sizes), words, weight / np.maximum(length, 1e-9)[row]


def _likeness(ends: np.ndarray, words: np.ndarray, weights: np.ndarray, across: np.ndarray) -> np.ndarray:
    """Of each text with each centre; `across` has a row for each word."""
    out, at = np.empty((len(ends), across.shape[1])), 0
    for i, end in enumerate(ends.tolist()):
        np.dot(weights[at:end], across[words[at:end]], out=out[i])
        at = end
    return out


def _least_like(counted: DataFrame, rarity: np.ndarray, centres: np.ndarray):
    """The text least like the centres that it is most like, the smallest d of several."""
    across = np.ascontiguousarray(centres.T)

    def run(batches):
        best = None
        for d, ends, words, weights in _weighed(batches, rarity):
            near = _likeness(ends, words, weights, across).max(axis=1)
            i = np.lexsort((d, near))[0]
            if best is None or (near[i], d[i]) < best[:2]:
                own = slice(ends[i - 1] if i else 0, ends[i])
                best = near[i], d[i], words[own].tobytes(), weights[own].tobytes()
        if best is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in best], names=["near", "d", "words", "weights"])
    return counted.mapInArrow(run, "near double, d bigint, words binary, weights binary").orderBy("near", "d").first()


def _direction(found, size: int) -> np.ndarray:
    out = np.zeros(size)
    out[np.frombuffer(bytes(found["words"]), np.uint16)] = np.frombuffer(bytes(found["weights"]))
    return out


def _sums(counted: DataFrame, rarity: np.ndarray, middle: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The summed directions of the texts nearest to each centre, and their numbers. Every task sends the sums
    of its centres and words; what reaches the driver is one number per centre and word."""
    k, v = middle.shape
    across = np.ascontiguousarray(middle.T)

    def run(batches):
        total, texts = np.zeros(k * v, np.int64), np.zeros(k, np.int64)
        for d, ends, words, weights in _weighed(batches, rarity):
            mine = _likeness(ends, words, weights, across).argmax(axis=1)
            at = np.repeat(mine * v, np.diff(ends, prepend=0)) + words
            total += np.bincount(at, np.rint(weights * UNIT), minlength=k * v).astype(np.int64)
            texts += np.bincount(mine, minlength=k)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate((at, np.arange(k * v, k * v + k)))),
             pa.array(np.concatenate((total[at], texts)))], names=["at", "n"])
    found = (counted.mapInArrow(run, "at bigint, n bigint").groupBy("at").agg(F.sum("n").alias("n")).toPandas())
    out = np.zeros(k * v + k)
    out[found["at"].to_numpy(np.int64)] = found["n"].to_numpy(float)
    return out[:k * v].reshape(k, v) / UNIT, out[k * v:]


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)


def _documents(docs: DataFrame) -> DataFrame:
    """(d, text, copies): the documents. Only rows that repeat an id and text are grouped; while these are few
    the others are not shuffled."""
    spark = docs.sparkSession
    rows = docs.select(F.xxhash64("doc_id", filled_text()).alias("d"), filled_text().cast("string").alias("text"))
    repeated = staged(spark, rows.groupBy("d").agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1"), "repeated")
    again = staged(spark, rows.join(repeated.select("d"), "d", "left_semi").groupBy("d").agg(
        F.min("text").alias("text"), F.count(F.lit(1)).alias("copies")), "repeated_texts")
    return rows.join(repeated.select("d"), "d", "left_anti").withColumn(
        "copies", F.lit(1).cast("bigint")).unionByName(again)


def fit(docs: DataFrame, topics: int = TOPICS) -> TopicModel:
    """The word clusters of `docs`. Every document takes part in the counts and in each round; what reaches the
    driver is bounded by TOPICS centres of VOCABULARY words."""
    spark = docs.sparkSession
    texts = _documents(docs)
    known = (texts.mapInArrow(_spread, "word string, df bigint").groupBy("word").agg(F.sum("df").alias("df"))
             .filter("df > 1").orderBy(F.desc("df"), "word").limit(VOCABULARY).toPandas())
    if known.empty:
        return TopicModel((), (), ())
    words = tuple(known["word"])
    counted = staged(spark, texts.mapInArrow(_counted(words), "d binary, sizes binary, words binary, counts binary"),
                     "word_counts", **PACKED)
    texts_of = counted.agg(F.sum(F.length("d")) / 8).first()[0]
    rarity = np.log(1 + texts_of / known["df"].to_numpy(float))
    # First centres: each the document least like those already taken, the one of the smallest d first.
    centres = [_direction(_least_like(counted, rarity, np.zeros((1, len(words)))), len(words))]
    while len(centres) < topics:
        found = _least_like(counted, rarity, np.stack(centres))
        if found["near"] > 1 - 1e-9:        # all documents are taken
            break
        centres.append(_direction(found, len(words)))
    middle = np.stack(centres)
    for _ in range(ROUNDS):
        sums, texts_of = _sums(counted, rarity, middle)
        moved = _unit(np.where(texts_of[:, None] > 0, sums, middle))
        if np.allclose(moved, middle, atol=1e-5):
            break
        middle = moved
    mean = middle.mean(axis=0)
    return TopicModel(words, tuple((middle / np.maximum(mean, 1e-9)).argmax(axis=0).tolist()),
                      tuple(np.round(rarity, 6).tolist()))


def topics_of(texts: pa.Array, model: TopicModel, known: pa.Array, cluster: np.ndarray,
              weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(topic number or -1, tokens) of every text; tokens are runs without white space."""
    row, word = _split(texts)
    tokens = np.bincount(row, minlength=len(texts))
    if not len(known):
        return np.full(len(texts), -1), tokens
    at = pc.fill_null(pc.index_in(word, value_set=known), -1).to_numpy()
    row, at = row[at >= 0], at[at >= 0]
    k = int(cluster.max()) + 1
    total = np.bincount(row * k + cluster[at], weights=weight[at], minlength=len(texts) * k).reshape(-1, k)
    return np.where(total.any(axis=1), total.argmax(axis=1), -1), tokens


def tagged(docs: DataFrame, model: TopicModel, keep: list[str]) -> DataFrame:
    """The columns `keep` of `docs`, with `topic` and `tokens` of each row's `text` (null reads as empty).
    Texts without a word of the model are 'none', texts without any word 'empty'."""
    rows = docs.select(*keep, filled_text().cast("string").alias("text"))

    def run(batches):
        known = pa.array(model.words, pa.string())
        cluster, weight = np.array(model.cluster, np.int64), np.array(model.weight)
        for batch in slices(batches):
            topic, tokens = topics_of(batch.column("text"), model, known, cluster, weight)
            names = [EMPTY if n == 0 else NONE if t < 0 else f"topic{t}" for t, n in zip(topic, tokens)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(names, pa.string()), pa.array(tokens, pa.int64())],
                names=[*keep, "topic", "tokens"])
    schema = rows.drop("text").withColumn("topic", F.lit("")).withColumn("tokens", F.lit(0).cast("bigint")).schema
    return rows.mapInArrow(run, schema)
