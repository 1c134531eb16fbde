"""Benchmark decontamination by SimHash of item-sized windows (operator 2).

Every window of a document that is as long as some benchmark item gets a 64-bit
SimHash of its words. An index over four 16-bit blocks, each entered under all values within three
bits, finds every item whose fingerprint lies within 15 bits: of 15 differing bits, one of
four blocks has at most three. Candidates are then verified by the exact weighted similarity of
their five-word shingles.
"""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratlab.llm.common import SLICE_ROWS, worker_cache
from stratlab.llm.shingles import WORDS, WordHashes, shingle_hashes, weighted

WORD = re.compile(r"\w+")
SIMILARITY = 0.8
BLOCK_BITS = 16
BLOCK_RADIUS = 3
RADIUS = 4 * (BLOCK_RADIUS + 1) - 1
#: Items are taken in blocks of at most so many words and items, each block in a pass of its own over the documents.
#: An item has some 2,800 entries in the index, of six bytes.
ITEM_BLOCK_WORDS = 500_000
ITEM_BLOCK_ITEMS = 8_192
MATCH = "array<struct<item_id:bigint,start:bigint,n_words:bigint,similarity:double>>"


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def signs(hashes: np.ndarray) -> np.ndarray:
    """One row of 64 numbers +1 or -1 for each hash."""
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.astype(np.int32) * 2 - 1


def window_fingerprints(hashes: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """SimHash (words weighted by how often they occur) of the windows of ``size`` words."""
    total = np.concatenate([np.zeros((1, 64), np.int32), np.cumsum(signs(hashes), axis=0, dtype=np.int32)])
    bits = (total[starts + size] - total[starts]) > 0
    return np.packbits(bits, axis=1, bitorder="little").view("<u8").ravel()


def weighted_similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum of the smaller over sum of the larger weights; 0 for two empty sets."""
    _, ia, ib = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    least = np.minimum(a[1][ia], b[1][ib]).sum()
    most = a[1].sum() + b[1].sum() - least
    return float(least / most) if most else 0.0


class ItemIndex:
    """Fingerprints, shingles and the multi-index of one block of items (id, text)."""

    def __init__(self, items: list[tuple[int, str]]):
        self.hashes = WordHashes()
        self.ids, self.sizes, self.shingles, prints = [], [], [], []
        for item_id, text in items:
            h = self.hashes.of(words_of(text))
            if len(h):
                self.ids.append(item_id)
                self.sizes.append(len(h))
                self.shingles.append(weighted(shingle_hashes(h)))
                prints.append(window_fingerprints(h, np.array([0]), len(h))[0])
        self.prints = np.array(prints, dtype=np.uint64)
        self.sizes = np.array(self.sizes, dtype=np.int64)
        self.by_size = {int(s): np.flatnonzero(self.sizes == s) for s in np.unique(self.sizes)}
        every = np.unique(np.concatenate([s[0] for s in self.shingles])) if prints else np.zeros(0, np.uint64)
        self.every = every
        self.filter = np.zeros(1 << 20, dtype=bool)
        self.filter[(every & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
        flips = np.array([sum(1 << b for b in bits) for r in range(BLOCK_RADIUS + 1) for bits in combinations(range(BLOCK_BITS), r)], dtype=np.uint64)
        # an index for each length of items: a window is only compared with items as long as itself
        self.index = {size: [self.entries(members, block, flips) for block in range(4)] for size, members in self.by_size.items()}

    def entries(self, members: np.ndarray, block: int, flips: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values under which these items are found by one block of bits, sorted, and whose they are."""
        part = self.prints[members] >> np.uint64(block * BLOCK_BITS) & np.uint64(0xFFFF)
        values = (part[:, None] ^ flips[None, :]).astype(np.uint16).ravel()
        order = np.argsort(values, kind="stable").astype(np.int32)
        return values[order], members.astype(np.int32)[order // len(flips)]

    def known(self, shingles: np.ndarray) -> np.ndarray:
        """Which of these shingles belong to an item."""
        maybe = np.flatnonzero(self.filter[(shingles & np.uint64((1 << 20) - 1)).astype(np.int64)])
        at = np.searchsorted(self.every, shingles[maybe])
        sure = self.every[np.minimum(at, len(self.every) - 1)] == shingles[maybe] if len(self.every) else np.zeros(0, bool)
        return maybe[sure]

    def near(self, prints: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """All (window, item of this length) within RADIUS bits, by the four blocks."""
        found = []
        for block, (values, owner) in enumerate(self.index[size]):
            part = (prints >> np.uint64(block * BLOCK_BITS) & np.uint64(0xFFFF)).astype(np.uint16)
            lo, hi = np.searchsorted(values, part, "left"), np.searchsorted(values, part, "right")
            n = hi - lo
            window = np.repeat(np.arange(len(prints)), n)
            at = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
            item = owner[at].astype(np.int64)
            close = np.bitwise_count(prints[window] ^ self.prints[item]) <= RADIUS
            found.append(window[close] * len(self.prints) + item[close])
        pairs = np.unique(np.concatenate(found))
        return pairs // len(self.prints), pairs % len(self.prints)

    def matches(self, text: str | None) -> list[tuple[int, int, int, float]]:
        """(item_id, start, n_words, similarity) of the best window of each item found.

        A window and an item of N and M shingles can only reach the similarity s if they have s (N + M) / (1 + s) in common, so
        windows with fewer shingles that belong to any item need no fingerprint. A text shorter than an item is one window.
        """
        h = self.hashes.of(words_of(text))
        n = len(h)
        if not n or not len(self.prints):
            return []
        hits = {WORDS: self.known(shingle_hashes(h))}
        best: dict[int, tuple[float, int, int]] = {}
        for size in self.by_size:
            gram = min(WORDS, size, n)
            if gram not in hits:
                hits[gram] = self.known(shingle_hashes(h, gram))
            if not len(hits[gram]):
                continue
            width = min(size, n)
            covered = np.zeros(n - width + 2, dtype=np.int64)
            np.add.at(covered, np.maximum(0, hits[gram] - (width - gram)), 1)
            np.add.at(covered, np.minimum(hits[gram] + 1, n - width + 1), -1)
            shingles = width - min(WORDS, width) + 1 + size - min(WORDS, size) + 1
            least = math.ceil(SIMILARITY * shingles / (1 + SIMILARITY) - 1e-9)
            starts = np.flatnonzero(np.cumsum(covered[:-1]) >= least)
            if not len(starts):
                continue
            lo, hi = starts[0], starts[-1] + width
            window, item = self.near(window_fingerprints(h[lo:hi], starts - lo, width), size)
            for w, i in zip(window.tolist(), item.tolist()):
                s = int(starts[w])
                sim = weighted_similarity(weighted(shingle_hashes(h[s:s + width])), self.shingles[i])
                if sim >= SIMILARITY and (i not in best or sim > best[i][0]):
                    best[i] = (sim, s, width)
        return [(self.ids[i], s, w, sim) for i, (sim, s, w) in sorted(best.items(), key=lambda x: self.ids[x[0]])]


def item_blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """Items in blocks of bounded size; the driver holds one block (and one partition) at a time."""
    block, size = [], 0
    for row in benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text").toLocalIterator():
        n = len(words_of(row["text"]))
        if block and (size + n > ITEM_BLOCK_WORDS or len(block) >= ITEM_BLOCK_ITEMS):
            yield block
            block, size = [], 0
        block.append((row["item_id"], row["text"]))
        size += n
    if block:
        yield block


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` with a column ``leaks``: for each benchmark item found, the best window.

    ``docs`` needs ``text``; its other columns are passed on (a column named ``leaks`` is replaced). A leak is a window of as
    many words as the item (the whole text where that is shorter) whose fingerprint lies within 15 bits and whose weighted shingle similarity is
    0.8 or more; of several the most similar, then the first. Null or empty text: no leaks. Items without words are never found;
    repeated items are each reported. Null item_id: reported as null. Nothing is shuffled; the items
    go to the executors in blocks of at most 500,000 words and 8,192 items, one pass over the documents each.
    """
    spark, call = docs.sparkSession, f"decontamination:{uuid.uuid4().hex}"
    out = docs.drop("leaks").withColumn("leaks", F.array().cast(MATCH))
    for items in item_blocks(benchmark):
        out = scan_block(out, spark.sparkContext.broadcast(items), call)
    return out


def scan_block(docs: DataFrame, items, call: str) -> DataFrame:
    key = uuid.uuid4().hex
    at = docs.columns.index("text")
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("start", pa.int64()), ("n_words", pa.int64()), ("similarity", pa.float64())]))

    def run(batches):
        index = worker_cache(call, key, lambda: ItemIndex(items.value))
        for batch in batches:
            for k in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(k, SLICE_ROWS)
                new = [[*old, *({"item_id": i, "start": s, "n_words": n, "similarity": x} for i, s, n, x in index.matches(t))]
                       for t, old in zip(part.column(at).to_pylist(), part.column(part.num_columns - 1).to_pylist())]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(new, kind)], names=batch.schema.names)

    return docs.mapInArrow(run, docs.schema)
