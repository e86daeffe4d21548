"""Hashes of words and of word shingles, for whole Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash

ROWS = 1000  # rows that are worked on at once
REMEMBERED = 200_000  # words whose hash a task keeps
_ODD = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """64-bit hash of a word, remembered for the first words met."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < REMEMBERED:
            self[word] = value
        return value


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit numbers over all bits (finaliser of MurmurHash3)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def slices(batches: Iterator[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def byte_texts(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


def word_hashes(texts: list[bytes | None], known: WordHashes, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts in a row, and where each text begins (one
    entry more than texts). bytes.split and bytes.lower treat exactly the ASCII
    space characters and A-Z."""
    words = [(t.lower() if lower else t).split() if t else () for t in texts]
    starts = np.zeros(len(words) + 1, np.int64)
    np.cumsum([len(w) for w in words], out=starts[1:])
    return np.fromiter(map(known.__getitem__, chain.from_iterable(words)), np.uint64, int(starts[-1])), starts


def shingle_sets(texts: list[bytes | None], known: WordHashes, length: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the ``length``-word shingles of every text; a text
    with fewer words has one for the whole sequence, one without words none."""
    h, starts = word_hashes(texts, known, lower=True)
    spans = max(0, len(h) - length + 1)
    rolled = h[:spans].copy()
    for i in range(1, length):
        rolled = rolled * _ODD + h[i : i + spans]
    rolled = mixed(rolled)
    sets = []
    for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()):
        if b - a >= length:
            own = np.sort(rolled[a : b - length + 1])
            if len(own) > 1:
                own = own[np.concatenate(([True], own[1:] != own[:-1]))]
        elif b > a:
            whole = np.uint64(b - a)
            with np.errstate(over="ignore"):
                for v in h[a:b]:
                    whole = whole * _ODD + v
            own = mixed(np.array([~whole]))
        else:
            own = np.empty(0, np.uint64)
        sets.append(own)
    return sets
