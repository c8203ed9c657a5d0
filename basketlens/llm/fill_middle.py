"""Fill-in-middle by secondary-sort assembly.

A document is cut into units (a word with the white space before it); two cuts drawn from its id give
prefix, middle and suffix, and its form says in which order they are put out, behind marks. Each
segment leaves its task in chunks of whole units, about CHUNK characters each, as pieces keyed by
(document, output position). `repartitionAndSortWithinPartitions` brings a document's pieces together
in output order, and one pass over the sorted partition feeds them to an incremental digest, piece by
piece. That pass also reads the output back: it finds the marks, tells the segments apart, and
keys each piece by its place in the document. A second sort restores the texts and digests them
the same way. A document without a transformation (form `plain`) is its own output and is digested
where it is read; only its row takes part in the sorts.

A piece's key names its row by id, digest of the text and map partition. Rows that agree in all three are
interchangeable: their pieces come together, one of each place is used, and the row is put out
as often as it came. So a lost executor's rows, computed again, always fit.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from array import array
from dataclasses import dataclass
from itertools import groupby

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import filled_text

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Characters of a piece (a longer unit is a piece of its own).
CHUNK = 1 << 16
#: Bytes of text for each task of the sorts.
TASK_BYTES = 32 << 20

#: Segments in output order for each form that moves text, with the mark before each.
ORDERS = {"psm": ((PREFIX, "prefix"), (SUFFIX, "suffix"), (MIDDLE, "middle")),
          "spm": ((SUFFIX, "suffix"), (PREFIX, "prefix"), (MIDDLE, "middle"))}
#: The place of each mark's segment in the document.
PLACE = {PREFIX: 0, MIDDLE: 1, SUFFIX: 2}


@dataclass(frozen=True)
class Plan:
    """How one document is transformed: its form, its units, and where prefix and middle end."""
    form: str
    n: int
    prefix_end: int | None = None
    middle_end: int | None = None


def plan(doc_id, text: str, seed: int = 42, rate: int = 50, spm: int = 80) -> Plan:
    """Cuts and form of a document from `seed:doc_id` (a null id counts as the empty string): `rate`
    per cent are transformed, of these `spm` per cent suffix first."""
    ends = array("q", (m.end() for m in UNIT.finditer(text)))
    n = len(ends)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i:i + 8], 16) for i in (0, 8, 16, 24))
    if not text or h3 % 100 >= rate or any(mark in text for mark in PLACE):
        return Plan("plain", n)
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    at = [0, *(ends[cut - 1] if cut else 0 for cut in (first, second))]
    return Plan("spm" if h4 % 100 < spm else "psm", n, at[1], at[2])


def chunks(text: str, start: int, end: int, size: int):
    """text[start:end] in pieces of whole units, of about `size` characters."""
    while start < end:
        stop = start + size
        if stop < end:
            unit = UNIT.search(text, stop, end)
            # The search may begin inside a word: what it finds then ends that word's unit.
            stop = unit.end() if unit else end
        stop = min(stop, end)
        yield text[start:stop]
        start = stop


def pieces_of(doc_id, text: str, part: int, seed: int, size: int):
    """((row name, output position), payload): the row at position -1, then marks and chunks."""
    made = plan(doc_id, text, seed)
    whole = hashlib.sha256(text.encode()).hexdigest()
    name = f"{whole}:{doc_id}:{part}"
    row = (doc_id, made.n, made.form, made.prefix_end,
           None if made.prefix_end is None else made.middle_end - made.prefix_end, whole)
    yield (name, -1), row
    if made.form == "plain":
        return
    spans = {"prefix": (0, made.prefix_end), "middle": (made.prefix_end, made.middle_end),
             "suffix": (made.middle_end, len(text))}
    position = 0
    for mark, segment in ORDERS[made.form]:
        yield (name, position), mark
        position += 1
        for piece in chunks(text, *spans[segment], size):
            yield (name, position), piece
            position += 1


def _spread(key) -> int:
    return zlib.crc32(key[0].encode())


def sort_tasks(docs: DataFrame, text_col: str = "text") -> int:
    """How many tasks share the sorts: one for every TASK_BYTES of text, however the input is split."""
    n = docs.agg(F.sum(F.octet_length(filled_text(text_col).cast("string")))).first()[0] or 0
    return max(1, -(-n // TASK_BYTES))


def sorted_pieces(docs: DataFrame, seed: int = 42, size: int = CHUNK, text_col: str = "text",
                  id_col: str = "doc_id"):
    """RDD of ((row name, output position), payload), each row's pieces in output order within one
    partition: the row itself, then marks and chunks of text. A document's
    pieces stay in one task, which streams them."""
    rows = docs.select(F.col(id_col), filled_text(text_col).cast("string")).rdd

    def emit(part, found):
        for doc_id, own in found:
            yield from pieces_of(doc_id, own, part, seed, size)
    return rows.mapPartitionsWithIndex(emit).repartitionAndSortWithinPartitions(
        sort_tasks(docs, text_col), _spread)


def documents_of(sorted_rows):
    """(row name, row, times, payloads): each row of a sorted partition with its pieces in order;
    of pieces at one position, which rows that agree have sent, one is taken."""
    for name, own in groupby(sorted_rows, key=lambda kv: kv[0][0]):
        places = groupby(own, key=lambda kv: kv[0][1])
        _, first = next(places)
        rows = [kv[1] for kv in first]
        yield name, rows[0], len(rows), (next(group)[1] for _, group in places)


def _outputs(sorted_rows):
    """Digest the outputs, and key their pieces by the place read from the marks."""
    for name, row, times, payloads in documents_of(sorted_rows):
        doc_id, n, form, prefix_chars, middle_chars, whole = row
        if form == "plain":
            for _ in range(times):
                yield (name, (-1, 0)), (*row[:5], whole, whole)
            continue
        digest, place = hashlib.sha256(), None
        for at, piece in enumerate(payloads):
            digest.update(piece.encode())
            if piece in PLACE:          # only a mark: a text that holds one stays plain
                place = PLACE[piece]
            else:
                yield (name, (place, at)), piece
        for _ in range(times):
            yield (name, (-1, 0)), (*row[:5], digest.hexdigest(), None)


def _restored(sorted_rows):
    for _, row, times, payloads in documents_of(sorted_rows):
        if row[6] is None:
            digest = hashlib.sha256()
            for piece in payloads:
                digest.update(piece.encode())
            row = (*row[:6], digest.hexdigest())
        for _ in range(times):
            yield row


DIGESTS = ("doc_id {id}, n bigint, form string, prefix_chars bigint, middle_chars bigint, "
           "output_sha256 string, restored_sha256 string")


def digests(docs: DataFrame, seed: int = 42, size: int = CHUNK) -> DataFrame:
    """One row per row of `docs`: doc_id, n units, form (plain, psm, spm), prefix_chars, middle_chars (null
    if plain), output_sha256, restored_sha256, where the restored text is put together again from the
    output's pieces alone.

    A null text counts as empty and is plain; a null id hashes as the empty string. Repeated rows
    give repeated rows. No text is held whole behind the first task, however long. Other columns are
    not read. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    ordered = sorted_pieces(docs, seed, size)
    tasks = ordered.getNumPartitions()
    back = ordered.mapPartitions(_outputs).repartitionAndSortWithinPartitions(tasks, _spread)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return spark.createDataFrame(back.mapPartitions(_restored), DIGESTS.format(id=kind),
                                 verifySchema=False)


def _texts(sorted_rows):
    for _, row, times, payloads in documents_of(sorted_rows):
        if row[2] != "plain":
            own = "".join(payloads)
            for _ in range(times):
                yield row[0], row[2], own


def transform(docs: DataFrame, seed: int = 42, size: int = CHUNK) -> DataFrame:
    """The output texts: doc_id, form, output. Here each output is one value, so it is held whole."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    moved = docs.sparkSession.createDataFrame(
        sorted_pieces(docs, seed, size).mapPartitions(_texts),
        f"doc_id {kind}, form string, output string", verifySchema=False)
    return moved.unionByName(plain_texts(docs, seed))


def plain_texts(docs: DataFrame, seed: int = 42) -> DataFrame:
    """The documents that stay as they are, by SQL functions: doc_id, form, output."""
    text = filled_text().cast("string")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h3 = F.conv(F.substring(digest, 17, 8), 16, 10).cast("bigint")
    marked = F.lit(False)
    for mark in PLACE:
        marked = marked | F.contains(text, F.lit(mark))
    return (docs.filter((text == "") | marked | (F.pmod(h3, F.lit(100)) >= 50))
            .select("doc_id", F.lit("plain").alias("form"), text.alias("output")))


def restore(outputs: DataFrame) -> DataFrame:
    """doc_id and text from (doc_id, form, output): the marks give the segments. By SQL functions."""
    out = F.col("output")
    first, second = ((PREFIX, SUFFIX), (SUFFIX, PREFIX))

    def between(left, right):
        rest = F.substring_index(out, left, -1)
        return rest if right is None else F.substring_index(rest, right, 1)
    psm = F.concat(between(first[0], first[1]), between(MIDDLE, None), between(first[1], MIDDLE))
    spm = F.concat(between(second[1], MIDDLE), between(MIDDLE, None), between(second[0], second[1]))
    return outputs.select("doc_id", F.when(F.col("form") == "psm", psm).when(F.col("form") == "spm", spm)
                          .otherwise(out).alias("text"))


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
u AS (SELECT doc_id, t, regexp_extract_all(t, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units,
             ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
             ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM d),
c AS (SELECT *, len(units) AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a,
             greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50
                  THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM u),
s AS (SELECT *, array_to_string(units[1:a], '') AS pre, array_to_string(units[a + 1:b], '') AS mid,
             array_to_string(units[b + 1:n], '') AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre)::DOUBLE END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(mid)::DOUBLE END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
              ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM s
"""
