"""Token-id files: flat unsigned integers, 64-bit document offsets, memory-mapped reads.

Layout of one folder (all little-endian):
  ids-NNNNN.bin      the token ids of partition NNNNN, document after document;
                     uint16 if the vocabulary fits, else uint32
  offsets-NNNNN.bin  uint64, documents + 1 entries: where each document starts in the file
  docs-NNNNN.bin     int64 doc_id per document; nulls-NNNNN.bin marks null ids (uint8)
  manifest/          Parquet: part, n_docs, n_tokens
Partitions hold ascending ranges of doc_id. A partition's base, the number of ids before
it, is the prefix sum over the manifest, so no task needs to know any other's output.
Tasks write under a name of their own attempt and move the file when complete; a task that
runs again writes the same bytes.
"""

from __future__ import annotations

import os
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import blocks, filled_text, kept

MANIFEST_SCHEMA = "part bigint, n_docs bigint, n_tokens bigint"
CACHE_PIECES = 2_000_000
CACHED_CHARS = 48
CALL_PIECES = 2000
PUNCTUATION = ",.;:!?"
BLOCK_CHARS = 1 << 20
BLANK = "\u0120"          # how byte-level vocabularies write the blank
# Two or more blanks, or a blank between two other white spaces: there a text can't be
# cut at its blanks without changing how white space is grouped.
UNSAFE = re.compile(r"[^\S ] [^\S ]")


class PieceEncoder:
    """Byte-level BPE ids of whole texts through the tokenizers library.

    The pre-tokenizer never joins characters across a place where a blank follows a
    non-blank, so a text is encoded blank by blank, and the library's result for a piece
    is kept for its next occurrence. Texts with irregular white space or with a special
    token's string go to the library whole.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.dtype = id_type(self.tokenizer.get_vocab_size())
        self.cache: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {}
        self.opens = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.opens[i] = token.startswith(BLANK)

    def _library(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype=self.dtype) for e in found]

    def _learn(self, pieces: set[str]) -> dict[str, bytes]:
        """Codes of pieces as they stand after a blank. A word and the punctuation behind it are
        separate for the pre-tokenizer, so the word is encoded once for all endings."""
        endings = {}
        for piece in pieces:
            word = piece.rstrip(PUNCTUATION)
            if word and len(word) < len(piece) and word[-1].isalnum():
                endings[piece] = (word, piece[len(word):])
        words = pieces.difference(endings)
        words.update(w for w, _ in endings.values() if w not in self.cache)
        codes = self._encode_words(list(words))
        for piece, (word, tail) in endings.items():
            if tail not in self.tails:
                self.tails[tail] = self._library([tail])[0].tobytes()
            codes[piece] = (codes[word] if word in codes else self.cache[word]) + self.tails[tail]
        return codes

    def _encode_words(self, pieces: list[str]) -> dict[str, bytes]:
        """Many pieces go into one call of the library; a piece has no blank inside, so its code
        begins where a token begins with the blank."""
        codes: dict[str, bytes] = {}
        width = np.dtype(self.dtype).itemsize
        for at in range(0, len(pieces), CALL_PIECES):
            some = pieces[at:at + CALL_PIECES]
            ids = self._library([" " + " ".join(some)])[0]
            data, cuts = ids.tobytes(), (np.flatnonzero(self.opens[ids]) * width).tolist()
            cuts.append(len(data))
            codes.update((p, data[i:j]) for p, i, j in zip(some, cuts[:-1], cuts[1:], strict=True))
        return codes

    def encode(self, texts: list[str]) -> list[bytes]:
        whole = ["  " in t or UNSAFE.search(t) is not None or any(s in t for s in self.special)
                 for t in texts]
        split = [[] if w else t.split(" ") for t, w in zip(texts, whole)]
        first = [s.pop(0) if s else "" for s in split]
        new = set().union(*split).difference(self.cache)
        if len(self.cache) + len(new) > CACHE_PIECES:
            self.cache.clear()
            new = set().union(*split)
        # White space at a piece's end would run into the next piece's: one by one.
        alone = [p for p in new if not p or p[0].isspace() or p[-1].isspace()]
        codes = self._learn(new.difference(alone))
        codes.update((p, c.tobytes())
                     for p, c in zip(alone, self._library([" " + p for p in alone])))
        self.cache.update(codes)
        code_of = self.cache.__getitem__
        heads = self._library([t if w else f for t, w, f in zip(texts, whole, first)])
        done = [h.tobytes() + b"".join(map(code_of, s)) for h, s in zip(heads, split)]
        for piece in [p for p in codes if len(p) > CACHED_CHARS]:
            del self.cache[piece]               # long ones rarely come again
        return done


def id_type(vocabulary: int) -> str:
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def encoder(path: str) -> PieceEncoder:
    """One encoder for each worker process, kept from task to task."""
    return kept(("token files", path), lambda: PieceEncoder(path))


def file_system(uri: str):
    """The Arrow file system of a folder and the folder's path in it."""
    from pyarrow import fs

    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    return fs.FileSystem.from_uri(uri)


def _writer(folder: str, vocabulary_path: str, end_id: int):
    def write(batches):
        fs, base = file_system(folder)
        fs.create_dir(base, recursive=True)
        context = TaskContext.get()
        part, attempt = context.partitionId(), context.taskAttemptId()
        code = encoder(vocabulary_path)
        end = np.array([end_id], dtype=code.dtype).tobytes()
        width = len(end)
        offsets, ids, nulls = [0], [], []
        temporary = f"{base}/_attempt-{part:05d}-{attempt}"
        with fs.open_output_stream(temporary) as out:
            for batch in batches:
                for doc_id in batch.column(0).to_pylist():
                    ids.append(doc_id or 0)
                    nulls.append(doc_id is None)
                for block in blocks(batch.column(1).to_pylist(), BLOCK_CHARS):
                    for data in code.encode(block):
                        out.write(data + end)
                        offsets.append(offsets[-1] + len(data) // width + 1)
        for name, values in (("offsets", np.array(offsets, "<u8")), ("docs", np.array(ids, "<i8")),
                             ("nulls", np.array(nulls, "u1"))):
            with fs.open_output_stream(f"{temporary}-{name}") as out:
                out.write(values.tobytes())
            fs.move(f"{temporary}-{name}", f"{base}/{name}-{part:05d}.bin")
        fs.move(temporary, f"{base}/ids-{part:05d}.bin")
        yield pa.RecordBatch.from_pydict(
            {"part": [part], "n_docs": [len(ids)], "n_tokens": [offsets[-1]]})
    return write


def write_token_files(docs: DataFrame, folder: str, vocabulary_path: str, end_id: int,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and write; returns the manifest with each partition's base.

    Null texts are written as empty (the end id alone), null ids come first, rows that
    share an id follow each other in an unspecified order. An empty table gives empty
    files. Other columns are not read. Rows are dealt by ranges of (doc_id, hash of the
    text, row), so an id that repeats very often is cut over several files.
    """
    rows = (docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                        filled_text(text_col).alias("text"))
            .withColumn("h", F.xxhash64("text"))
            .withColumn("row", F.monotonically_increasing_id()))
    dealt = (rows.repartitionByRange("doc_id", "h", "row")
             .sortWithinPartitions("doc_id", "h", "row").select("doc_id", "text"))
    spark = docs.sparkSession
    dealt.mapInArrow(_writer(folder, vocabulary_path, end_id), MANIFEST_SCHEMA) \
        .write.mode("overwrite").parquet(f"{folder}/manifest")
    return read_manifest(spark, folder)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return (spark.read.schema(MANIFEST_SCHEMA).parquet(f"{folder}/manifest")
            .withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0))))


def _mapped(fs, path: str, dtype: str) -> np.ndarray:
    """A file as an array: memory-mapped where the folder is mounted, else read."""
    if fs.type_name == "local":
        if fs.get_file_info(path).size == 0:
            return np.empty(0, dtype)
        return np.memmap(path, dtype=dtype, mode="r")
    with fs.open_input_file(path) as f:
        return np.frombuffer(f.read(), dtype)


def documents_of(folder: str, part: int, dtype: str):
    """(doc_id or None, start in the file, ids) of every document of one partition."""
    fs, base = file_system(folder)
    ids, offsets, docs, nulls = (
        _mapped(fs, f"{base}/{n}-{part:05d}.bin", t)
        for n, t in (("ids", dtype), ("offsets", "<u8"), ("docs", "<i8"), ("nulls", "u1")))
    for k in range(len(docs)):
        start, stop = int(offsets[k]), int(offsets[k + 1])
        yield (None if nulls[k] else int(docs[k])), start, ids[start:stop]


def _reader(folder: str, dtype: str):
    def read(batches):
        for batch in batches:
            for part, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows = [(doc, base + start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()))
                        for doc, start, ids in documents_of(folder, part, dtype)]
                columns = list(zip(*rows)) or [[], [], [], []]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])
    return read


def read_token_files(spark: SparkSession, folder: str, vocabulary: int) -> DataFrame:
    """One row per document, from the files: doc_id, start, n_tokens, ids_crc32."""
    parts = read_manifest(spark, folder).filter("n_docs > 0").select("part", "base")
    # a fixed count: a row of the manifest is small, what it stands for is not
    dealt = parts.repartition(max(1, parts.count()), "part")
    return dealt.mapInArrow(_reader(folder, id_type(vocabulary)),
                            "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def round_trip(docs: DataFrame, vocabulary_path: str, end_id: int = 2,
               folder: str | None = None) -> DataFrame:
    """Write the token files of `docs`, then read them back."""
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "token_files")
    write_token_files(docs, folder, vocabulary_path, end_id)
    return read_token_files(spark, folder, Tokenizer.from_file(vocabulary_path).get_vocab_size())
