"""Hashes of word n-grams."""

from __future__ import annotations

import numpy as np


def word_spans(text: str | None) -> tuple[bytes, list[int], list[int]]:
    """The lower-cased (A-Z) words joined by one space, with the start and end of each."""
    words = [] if text is None else text.encode().translate(LOWER).split()
    if not words:
        return b"", [], []
    ends = np.cumsum(np.array([len(w) for w in words]) + 1) - 1
    return b" ".join(words), [0, *(ends[:-1] + 1).tolist()], ends.tolist()


#: A-Z to a-z; \x0b and \x0c are white space to bytes.split() as they are to the contract, and no other byte is.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def shingle_hashes(text: str | None, n: int, seed: int = 42) -> np.ndarray:
    """XXH64 of every n-word shingle, repeats included."""
    import xxhash

    joined, starts, ends = word_spans(text)
    if not starts:
        return np.zeros(0, dtype=np.uint64)
    h = xxhash.xxh64_intdigest
    tails = ends[n - 1:] or ends[-1:]
    return np.array([h(joined[a:b], seed) for a, b in zip(starts, tails, strict=False)], dtype=np.uint64)


def mixed(hashes: np.ndarray, copy: int) -> np.ndarray:
    """The hashes themselves, or an independent 64-bit remix of them for wider fingerprints."""
    if copy == 0:
        return hashes
    with np.errstate(over="ignore"):
        h = hashes ^ np.uint64(0x9E3779B97F4A7C15 * copy & 0xFFFFFFFFFFFFFFFF)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
        return h ^ (h >> np.uint64(31))
