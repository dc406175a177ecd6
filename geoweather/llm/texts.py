"""Words and their hashes, many texts at a time, for use inside tasks."""

from __future__ import annotations

import numpy as np
import pyarrow.compute as pc
import xxhash

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
# Odd factors of widely used 64-bit mixing functions (fixed values).
MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def scramble(h: np.ndarray) -> np.ndarray:
    """A mixing permutation of 64-bit numbers."""
    h = (h ^ (h >> np.uint64(30))) * MIX[1]
    h = (h ^ (h >> np.uint64(27))) * MIX[2]
    return h ^ (h >> np.uint64(31))


def folded_words(text: str) -> list[bytes]:
    """Words (split at ASCII white space) as UTF-8, A-Z lower-cased."""
    return (text.lower() if text.isascii() else text.translate(FOLD)).encode("utf-8", "surrogatepass").split()


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words, and the number of words of each text."""
    known: dict[bytes, int] = {}
    hashes, lengths = [], []
    for text in texts:
        words = folded_words(text)
        for w in set(words).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w)
        hashes.append(np.fromiter(map(known.__getitem__, words), np.uint64, len(words)))
        lengths.append(len(words))
    return (np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)), np.array(lengths, np.int64)


def text_groups(column, chars_each: int):
    """(first, end, texts) of runs of an Arrow string column with about that many bytes, or one longer text.

    Only one run at a time is held as Python strings; null is the empty text.
    """
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    start = size = 0
    for i, n in enumerate(sizes.tolist()):
        size += n
        if size >= chars_each or i + 1 == len(sizes):
            yield start, i + 1, [t or "" for t in column.slice(start, i + 1 - start).to_pylist()]
            start, size = i + 1, 0
