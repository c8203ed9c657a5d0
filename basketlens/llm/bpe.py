"""BPE encoding and decoding with a pair occurrence index.

The distinct words of a block of texts are laid out as one chain of symbols. An index maps
each mergeable pair, by its rank, to all its positions in that chain. Ranks that have
positions are active; they are applied in ascending order, each to all its positions from
left to right, and every merge adds the two pairs it makes to the index. A word that gains
a pair of a lower rank than the one being applied waits until that rank has been applied,
so every word goes through the merges in the order of the tokenizers library.
Words are independent of each other, so a worker keeps the codes of words it has seen.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, filled_text, kept

CACHE_WORDS = 350_000
CACHED_CHARS = 48
BLOCK_CHARS = 1 << 20
END = "</w>"
# White space as the vocabulary file's normaliser knows it (Unicode White_Space).
SPACE = re.compile("[\t-\r \x85\xa0  -     　]+")
SEPARATORS = "\x1c\x1d\x1e\x1f"       # Python's split() takes these for white space
ASCII_TOKEN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+")
# Letters of Latin-1 and Latin Extended-A: single code points that are in NFC, with the
# same lower case and class in every Unicode version. Other pieces, and those with the
# few characters whose lower case is not one letter, go through the library's own steps.
OTHER = re.compile("[^!-~À-ÖØ-öø-įĲ-ž]|[İĲĳĿŀŉ]")
OTHER_TEXT = re.compile("[^!-~\t-\r À-ÖØ-öø-įĲ-ž]|[İĲĳĿŀŉ]")
PUNCTUATION = ",.;:!?"
LATIN_TOKEN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ž]+|[0-9]|[^\sa-z0-9ß-öø-ž]+")


def byte_letters() -> list[str]:
    """The printable letter of each byte: printable bytes stand for themselves, the others
    for the code points from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters, extra = [""] * 256, 256
    for b in range(256):
        if b in plain:
            letters[b] = chr(b)
        else:
            letters[b] = chr(extra)
            extra += 1
    return letters


class PairIndex:
    """The merge rules of a vocabulary, applied through the occurrence index."""

    def __init__(self, vocab: dict[str, int], merges: list):
        self.vocab, self.width = vocab, max(vocab.values()) + 1
        self.rules: list[tuple[int, int, int]] = []
        self.rank: dict[int, int] = {}
        for merge in merges:
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            left, right = vocab[a], vocab[b]
            self.rank.setdefault(left * self.width + right, len(self.rules))
            self.rules.append((left, right, vocab[a + b]))
        self.letter = {c: vocab[c] for c in byte_letters()}
        self.last_letter = {c: vocab[c + END] for c in byte_letters()}
        base = [*self.letter.values(), *self.last_letter.values()]
        self.small = np.zeros(self.width, dtype=np.int64)
        self.small[base] = np.arange(len(base))
        self.letter_rank = np.array([[self.rank.get(x * self.width + y, -1) for y in base]
                                     for x in base])

    def encode(self, words: list[str]) -> list[list[int]]:
        width, rank_of, rules = self.width, self.rank, self.rules
        letter, last = self.letter, self.last_letter
        symbol: list[int] = []
        starts: list[int] = []
        sizes: list[int] = []
        for word in words:
            starts.append(len(symbol))
            symbol += [letter[c] for c in word[:-1]]
            symbol.append(last[word[-1]])
            sizes.append(len(word))
        at = np.arange(len(symbol))
        after, before = at + 1, at - 1
        after[np.cumsum(sizes, dtype=np.int64) - 1] = -1
        before[starts] = -1
        word_of = np.repeat(np.arange(len(words)), sizes).tolist()
        # the first pairs are pairs of letters, whose ranks stand in a table
        small = self.small[np.array(symbol, dtype=np.int64)]
        ranks = self.letter_rank[small[:-1], small[1:]] if len(symbol) > 1 else np.empty(0, int)
        places = np.flatnonzero((after[:-1] >= 0) & (ranks >= 0))
        places = places[np.argsort(ranks[places], kind="stable")]
        cuts = np.flatnonzero(np.diff(ranks[places], prepend=-1))
        index: dict[int, list[int]] = {
            int(ranks[own[0]]): own.tolist() for own in np.split(places, cuts[1:]) if len(own)}
        after, before = after.tolist(), before.tolist()
        active = sorted(index)
        while active:
            rank = heapq.heappop(active)
            places = index.pop(rank, None)
            if places is None:
                continue
            places.sort()
            left, right, merged = rules[rank]
            waiting: list[int] = []
            lower: set[int] = set()
            for at in places:
                second = after[at]
                if symbol[at] != left or second < 0 or symbol[second] != right:
                    continue
                if lower and word_of[at] in lower:
                    waiting.append(at)
                    continue
                symbol[at], symbol[second] = merged, -1
                third = after[at] = after[second]
                ahead = before[at]
                if third >= 0:
                    before[third] = at
                for place, key in ((at, merged * width + symbol[third] if third >= 0 else -1),
                                   (ahead, symbol[ahead] * width + merged if ahead >= 0 else -1)):
                    made = rank_of.get(key)
                    if made is not None:
                        if made in index:
                            index[made].append(place)
                        else:
                            index[made] = [place]
                            heapq.heappush(active, made)
                        if made < rank:
                            lower.add(word_of[at])
            if waiting:
                index[rank] = index.get(rank, []) + waiting
                heapq.heappush(active, rank)
        codes = []
        for start, size in zip(starts, sizes):
            codes.append([c for c in symbol[start:start + size] if c >= 0])
        return codes


def _together(codes: list[tuple[int, str, str]]) -> tuple[int, str, str]:
    if not codes:
        return 0, "", ""
    counts, ids, texts = zip(*codes)
    return sum(counts), " ".join(ids), " ".join(texts)


class WordCoder:
    """Whole texts to ids and back, as the tokenizers library does with a word-end
    vocabulary (lower case, white space dropped, special strings kept)."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        self.library = Tokenizer.from_file(path)
        self.pairs = PairIndex(model["model"]["vocab"], model["model"]["merges"])
        self.names = {i: t for t, i in model["model"]["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in model["added_tokens"]}
        self.names.update({i: t for t, i in self.special.items()})
        self.split_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.letters = dict(enumerate(byte_letters()))
        self.marks = {m: (1, str(i), self.names[i]) for m, (i,) in
                      zip(PUNCTUATION, self.pairs.encode(list(PUNCTUATION)))}
        self.cache: dict[str, tuple[int, str, str]] = {}

    def tokens(self, piece: str) -> list[str]:
        """The words of a piece without white space, in byte letters."""
        if not OTHER.search(piece):
            if piece.isascii():
                return [t.translate(self.letters) for t in ASCII_TOKEN.findall(piece.lower())]
            return [t.encode().decode("latin-1").translate(self.letters)
                    for t in LATIN_TOKEN.findall(piece.lower())]
        normal = self.library.normalizer.normalize_str(piece)
        return [t for t, _ in self.library.pre_tokenizer.pre_tokenize_str(normal)]

    def decode(self, ids: list[int]) -> str:
        return " ".join([self.names[i] for i in ids])

    def learn(self, pieces: set[str], into: dict) -> None:
        """Encode pieces not seen before; `into` gets (count, ids, decoded) of each. A word and
        one punctuation mark behind it are separate tokens, so the word is learned once."""
        endings = {p: p[:-1] for p in pieces
                   if p[-1] in PUNCTUATION and p[-2:-1].isalnum() and p[-2:].isascii()}
        whole = [*pieces.difference(endings),
                 *{w for w in endings.values() if w not in into and w not in pieces}]
        split = [self.tokens(p) for p in whole]
        words = list({t for s in split for t in s})
        code = {word: (len(ids), " ".join(map(str, ids)), self.decode(ids))
                for word, ids in zip(words, self.pairs.encode(words))}
        for piece, own in zip(whole, split):
            into[piece] = code[own[0]] if len(own) == 1 else _together([code[t] for t in own])
        for piece, word in endings.items():
            into[piece] = _together([into[word], self.marks[piece[-1]]])

    def pieces(self, text: str) -> list[str]:
        if any(c in text for c in SEPARATORS):
            return [p for p in SPACE.split(text) if p]
        return text.split()

    def segments(self, text: str) -> list[str]:
        """Pieces of the text in order; special strings are pieces of their own."""
        if not any(s in text for s in self.special):
            # lower case letter by letter is what the normaliser does; a special string must
            # not come about by it
            simple = "<|" not in text and not OTHER_TEXT.search(text)
            return self.pieces(text.lower() if simple else text)
        out: list[str] = []
        for part in self.split_special.split(text):
            out += [part] if part in self.special else self.pieces(part)
        return out

    def block(self, texts: list[str]) -> list[tuple[int, str, str]]:
        """(n_tokens, ids joined by one space, decoded text) of each text."""
        split = [self.segments(t) for t in texts]
        cache = self.cache
        new = set().union(*split).difference(cache)
        if len(cache) + len(new) > CACHE_WORDS:
            cache.clear()
            new = set().union(*split)
        for special in new.intersection(self.special):
            cache[special] = (1, str(self.special[special]), special)
        self.learn(new.difference(self.special), cache)
        out = [_together(list(map(cache.__getitem__, own))) for own in split]
        for piece in [p for p in new if len(p) > CACHED_CHARS]:
            del cache[piece]                    # long ones rarely come again
            cache.pop(piece[:-1], None)
        return out


def coder(path: str) -> WordCoder:
    """One coder for each worker process, kept from task to task."""
    return kept(("bpe", path), lambda: WordCoder(path))


def _ids(coded: list[tuple[int, str, str]]) -> pa.ListArray:
    offsets = np.zeros(len(coded) + 1, dtype=np.int32)
    np.cumsum([c[0] for c in coded], out=offsets[1:])
    values = [np.fromstring(c[1], dtype=np.int32, sep=" ") for c in coded if c[0]]
    return pa.ListArray.from_arrays(
        offsets, np.concatenate(values) if values else np.empty(0, np.int32))


def _sha256(texts) -> pa.Array:
    return pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts], pa.string())


#: What can be returned beside doc_id and n_tokens: column, type, how it is made.
OUTPUTS = {
    "ids": ("array<int>", _ids),
    "decoded": ("string", lambda coded: pa.array([c[2] for c in coded], pa.string())),
    "ids_sha256": ("string", lambda coded: _sha256(c[1] for c in coded)),
    "decoded_sha256": ("string", lambda coded: _sha256(c[2] for c in coded)),
}


def _run(path: str, outputs: tuple[str, ...]):
    def run(batches):
        words = coder(path)
        for batch in batches:
            texts, at = batch.column(1).to_pylist(), 0
            for block in blocks(texts, BLOCK_CHARS):
                coded = words.block(block)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(block)),
                     pa.array([c[0] for c in coded], pa.int64()),
                     *[OUTPUTS[o][1](coded) for o in outputs]],
                    names=["doc_id", "n_tokens", *outputs])
                at += len(block)
    return run


def encode_decode(docs: DataFrame, vocabulary_path: str,
                  outputs: tuple[str, ...] = ("ids", "decoded"), id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens and the wanted `outputs` of every row: ids, decoded, and the SHA-256 of
    the decimal ids joined by one space and of the decoded text.

    A null text counts as empty: no tokens, empty list, empty text. Rows are independent:
    repeated rows give repeated results, an empty table an empty result, other columns
    are not read. A text is encoded whole; memory holds about BLOCK_CHARS characters, or
    one text if that is longer.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       filled_text(text_col).alias("text"))
    columns = ", ".join(f"{o} {OUTPUTS[o][0]}" for o in outputs)
    return rows.mapInArrow(_run(vocabulary_path, tuple(outputs)),
                           f"doc_id bigint, n_tokens bigint, {columns}")
