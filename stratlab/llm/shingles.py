"""Weighted word shingles as numbers, for operators on near copies."""

from __future__ import annotations

import numpy as np
import xxhash

WORDS = 5
MULTIPLY = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finalizer on an array of unsigned 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words_of(text: str | None) -> list[str]:
    """Lower-cased words between white space."""
    return (text or "").lower().split()


class WordHashes:
    """64-bit hashes of words, remembered up to a bound."""

    def __init__(self, limit: int = 500_000):
        self.known: dict[str, int] = {}
        self.limit = limit

    def of(self, words: list[str]) -> np.ndarray:
        known = self.known
        if len(known) > self.limit:
            known.clear()
        for w in set(words).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w.encode("utf-8"))
        return np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))


def shingle_hashes(hashes: np.ndarray, size: int = WORDS) -> np.ndarray:
    """The hash of each run of ``size`` words; a shorter text is one run, no words give none."""
    n = len(hashes)
    size = min(size, n)
    if not n:
        return np.zeros(0, np.uint64)
    acc = np.zeros(n - size + 1, np.uint64)
    for k in range(size):
        acc = acc * MULTIPLY + hashes[k:n - size + 1 + k]
    return mix(acc + np.uint64(size))


def weighted(shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles, sorted, and how often each occurs."""
    return np.unique(shingles, return_counts=True)


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Exact probability Jaccard of two weighted sets: the sum over common elements i of
    1 / sum_j max(x_j / x_i, y_j / y_i). With equal weights it is the plain Jaccard similarity.
    Two empty sets have similarity 0.
    """
    (ka, wa), (kb, wb) = a, b
    common, ia, ib = np.intersect1d(ka, kb, assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0
    if wa.max() == 1 and wb.max() == 1:
        return len(common) / (len(ka) + len(kb) - len(common))
    x, y = wa[ia].astype(float), wb[ib].astype(float)
    only_a, only_b = float(wa.sum() - x.sum()), float(wb.sum() - y.sum())
    total = 0.0
    ratios, where, counts = np.unique(x / y, return_inverse=True, return_counts=True)
    sums = np.bincount(where, weights=x)
    # sum_j max(x_j, r y_j): elements of ratio under r count r y_j, the others x_j
    by_x, by_y = sums, np.bincount(where, weights=y)
    above_x = by_x[::-1].cumsum()[::-1]
    below_y = np.concatenate([[0.0], by_y.cumsum()[:-1]])
    total = (sums / (only_a + ratios * only_b + above_x + ratios * below_y)).sum()
    return float(total)
