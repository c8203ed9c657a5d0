"""Word shingles of whole texts as sorted sets of 64-bit hashes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

from .common import kept

CACHE_WORDS = 250_000
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], dtype=np.uint64)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value



def words(text: str) -> list[bytes]:
    """A-Z lower-cased, cut at blanks and the characters 9 to 13 only."""
    return text.encode().lower().split()


def word_hashes(text: str) -> np.ndarray:
    own = words(text)
    hashes = kept("word hashes", _WordHashes)
    return np.fromiter(map(hashes.__getitem__, own), dtype=np.uint64, count=len(own))


def word_hashes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, ends): the word_hashes of all texts, one text after another."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    word = pc.list_flatten(split)
    full = pc.not_equal(pc.binary_length(word), 0)
    row = pc.list_parent_indices(split).filter(full).to_numpy()
    coded = word.filter(full).dictionary_encode()
    known = kept("word hashes", _WordHashes)
    hashes = np.fromiter(map(known.__getitem__, coded.dictionary.cast(pa.binary()).to_pylist()),
                         dtype=np.uint64, count=len(coded.dictionary))
    return hashes[coded.indices.to_numpy()], np.cumsum(np.bincount(row, minlength=len(texts)))


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def shingles(w: np.ndarray, k: int) -> np.ndarray:
    """The hash of every k consecutive words, in text order; of fewer words, of all."""
    if len(w) == 0:
        return w
    size = min(k, len(w))
    n = len(w) - size + 1
    h = np.full(n, size, dtype=np.uint64)
    for at in range(size):
        h = h * _ODD[at % len(_ODD)] + w[at:at + n]
    return mix(h)


def shingle_set(text: str, k: int) -> np.ndarray:
    return np.unique(shingles(word_hashes(text), k))
