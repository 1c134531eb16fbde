"""Periodic runs of words by block convolution (operator 12).

A run of period q and at least four periods holds a whole aligned block of a length near q,
and that block again q words later. At dyadic scales the words are cut into blocks; the sum of
squared differences between a block and every shift of the words that follow it is computed at once, by a
number-theoretic transform in exact integers. A shift of sum zero is a seed: a distance and a place, which are
extended to both sides as far as the words agree.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The modulus 2^16 + 1; 3 generates its multiplicative group of order 2^16.
PRIME = 65_537
GENERATOR = 3
#: Longest block; a transform is twice as long.
LONGEST_BLOCK = 2_048
#: Least words of a run, and least periods in it.
LEAST_WORDS, LEAST_PERIODS = 6, 4
#: Numbers held in one array of a convolution.
CHUNK = 1 << 16
#: Code points of texts searched together.
GROUP_CHARS = 4_000_000
SCHEMA = ("doc_id bigint, n_words bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
          "runs_sha256 string, collapsed_sha256 string")
ALL_SCHEMA = "doc_id bigint, words array<string>, runs array<struct<start: bigint, length: bigint, period: bigint>>"

ROOTS: dict[tuple[int, bool], np.ndarray] = {}


def roots(n: int, inverse: bool) -> np.ndarray:
    """Powers 0 .. n/2 - 1 of an n-th root of unity, or of its inverse."""
    got = ROOTS.get((n, inverse))
    if got is None:
        w = pow(GENERATOR, (PRIME - 1) // n, PRIME)
        if inverse:
            w = pow(w, -1, PRIME)
        got = np.array([pow(w, k, PRIME) for k in range(n // 2)], dtype=np.int64)
        ROOTS[n, inverse] = got
    return got


def fold(x: np.ndarray) -> np.ndarray:
    """A smaller number equal to ``x`` modulo 2^16 + 1, as 2^16 is -1 there: b + 17 bits become about b + 1."""
    low = x & 0xFFFF
    low -= x >> 16
    return low


def transform(x: np.ndarray) -> np.ndarray:
    """Transforms of the columns of ``x`` (length a power of two, in place), in bit-reversed order.

    Numbers are left unreduced: they grow by about a bit a level, far from 63 bits for any length in use.
    """
    n = x.shape[0]
    half = n // 2
    while half:
        part = x.reshape(n // (2 * half), 2, half, -1)
        low, high = part[:, 0], part[:, 1]
        difference = low - high
        low += high
        if half > 1:
            difference *= roots(2 * half, False)[:, None]
            difference = fold(difference)
        part[:, 1] = difference
        half //= 2
    return x


def inverse_transform(x: np.ndarray) -> np.ndarray:
    """The columns that ``transform`` was given, from its result (in place), times their length and unreduced."""
    n = x.shape[0]
    half = 1
    while half < n:
        part = x.reshape(n // (2 * half), 2, half, -1)
        low, high = part[:, 0], part[:, 1]
        if half > 1:
            high = fold(high * roots(2 * half, True)[:, None])
        difference = low - high
        low += high
        part[:, 1] = difference
        half *= 2
    return x


def squared_differences(blocks: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """For each column: the sum of squared differences between the block and every stretch of the
    window as long as it, in order.

    All numbers must be so small that the sums stay under the modulus; then the result is the exact integer.
    """
    size, n = blocks.shape[0], windows.shape[0]
    shifts = n - size + 1
    length = 1 << (n - 1).bit_length()
    padded = np.zeros((length, blocks.shape[1]), np.int64)
    padded[:size] = blocks[::-1]
    text = np.zeros((length, blocks.shape[1]), np.int64)
    text[:n] = windows
    spectrum = transform(padded)
    spectrum *= transform(text)
    product = inverse_transform(fold(fold(fold(spectrum))))[size - 1:size - 1 + shifts]
    product = fold(fold(product)) * pow(length, -1, PRIME)
    sums = np.zeros((n + 1, blocks.shape[1]), np.int64)
    np.cumsum(windows * windows, axis=0, out=sums[1:])
    return (sums[size:size + shifts] - sums[:shifts] + (blocks * blocks).sum(axis=0) - 2 * product) % PRIME


def scales(longest: int):
    """(stride, block length, least distance, greatest distance) of each scale, for texts of up to ``longest`` words.

    With stride S a run of period q >= (2 S - 1) / 3 and four periods contains an aligned block of S words
    together with the same block q words on, as 2 S - 1 + q <= 4 q.
    """
    stride = 2
    while True:
        least = -(-(2 * stride - 1) // 3)
        if LEAST_PERIODS * least > longest:
            return
        yield stride, min(stride, LONGEST_BLOCK), least, (4 * stride - 2) // 3
        stride *= 2


def seeds(ids: np.ndarray, stride: int, block: int, least: int, greatest: int, reach: np.ndarray):
    """Places of aligned blocks and the distances at which they occur again, exactly, in the words after them.

    ``reach``: for each word the end of the farthest run known that starts at or before it. Occurrences within such a run repeat its
    period, which is shorter than the block, and are left out.
    """
    n = len(ids)
    # Small numbers for words, so that a sum of squares stays under the modulus.
    numbers = (ids * 40_503 >> 7) % max(2, int(((PRIME - 1) / block) ** 0.5) + 1)
    places = np.arange(0, n - block - least + 1, stride)
    for low in range(least, greatest + 1, block):
        high = min(greatest, low + block - 1)
        span = block + high - low
        here = places[places + low + block <= n]
        here = here[reach[here] < here + high + block]
        rows = max(1, CHUNK // (2 * block))
        for at in range(0, len(here), rows):
            p = here[at:at + rows]
            follow = p[None, :] + np.arange(low, low + span)[:, None]
            beyond = follow >= n
            words = numbers[np.minimum(follow, n - 1)]
            words[beyond] = 0
            zero = squared_differences(numbers[p[None, :] + np.arange(block)[:, None]], words) == 0
            shift, which = np.nonzero(zero)
            start, distance = p[which], shift + low
            ok = (start + distance + block <= n) & (reach[start] < start + distance + block)
            start, distance = start[ok], distance[ok]
            same = np.ones(len(start), bool)
            for k in range(0, block, 64):  # the numbers are not one to one: hold the words together
                left = np.flatnonzero(same)
                offsets = np.arange(k, min(block, k + 64))
                same[left] = (ids[start[left, None] + offsets] == ids[(start + distance)[left, None] + offsets]).all(axis=1)
            yield from zip(distance[same].tolist(), start[same].tolist())


def agree_right(ids: np.ndarray, at: int, distance: int) -> int:
    """The first place from ``at`` on whose word differs from the one ``distance`` on (or has none)."""
    step, end = 64, len(ids) - distance
    while at < end:
        stop = min(end, at + step)
        differ = ids[at:stop] != ids[at + distance:stop + distance]
        if differ.any():
            return at + int(differ.argmax())
        at, step = stop, 2 * step
    return max(at, min(at, end))


def agree_left(ids: np.ndarray, at: int, distance: int) -> int:
    """The first place of the stretch before ``at`` whose words agree with those ``distance`` on."""
    step = 64
    while at > 0:
        start = max(0, at - step)
        differ = ids[start:at] != ids[start + distance:at + distance]
        if differ.any():
            return at - int(differ[::-1].argmax())
        at, step = start, 2 * step
    return 0


def find_runs(ids: np.ndarray, longest: int | None = None) -> list[tuple[int, int, int]]:
    """All runs of a sequence of numbers as (start, length, smallest period), by start, then period.

    ``longest`` bounds the length of a run, where it is known to be under that of the sequence.
    """
    ids = np.asarray(ids, dtype=np.int64)
    n = len(ids)
    found: dict[tuple[int, int], int] = {}
    ends = np.zeros(n, np.int64)
    for stride, block, least, greatest in scales(min(n, longest or n)):
        reach = np.maximum.accumulate(ends)
        done: dict[int, int] = {}
        for distance, place in sorted(seeds(ids, stride, block, least, greatest, reach)):
            if place < done.get(distance, -1):
                continue
            start = agree_left(ids, place, distance)
            stop = agree_right(ids, place + block, distance)
            done[distance] = stop
            length = stop + distance - start
            if length >= max(LEAST_WORDS, LEAST_PERIODS * distance):
                # the whole stretch of a multiple of the period is that of the period
                if found.setdefault((start, length), distance) == distance:
                    ends[start] = max(ends[start], start + length)
    return sorted((s, length, q) for (s, length), q in found.items())


def runs_of_texts(texts: list[list]) -> list[list[tuple[int, int, int]]]:
    """Runs of each list of words. The texts are searched as one sequence, with a number of its own between any
    two; texts too short for a scale are left out of it with all shorter ones before it."""
    numbers: dict = defaultdict(count().__next__)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    by_size: dict[int, list[int]] = defaultdict(list)
    for i, words in enumerate(texts):
        if len(words) >= LEAST_WORDS:
            by_size[len(words).bit_length()].append(i)
    for size, members in by_size.items():
        parts, starts, at = [], [], 0
        for i in members:
            parts.append(list(map(numbers.__getitem__, texts[i])) + [-1])
            starts.append(at)
            at += len(parts[-1])
        ids = np.fromiter((x for p in parts for x in p), np.int64, at)
        gaps = ids < 0
        ids[gaps] = len(numbers) + np.arange(int(gaps.sum()))
        for start, length, period in find_runs(ids, max(len(p) for p in parts) - 1):
            which = int(np.searchsorted(starts, start, side="right")) - 1
            out[members[which]].append((start - starts[which], length, period))
    return out


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space (0x20 and 0x09 to 0x0D), in UTF-8."""
    return (text or "").encode("utf-8").split()


def repeat_tail(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words with their tail made periodic, for one document in ten by the checksum of its id."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * -(-(n - a) // p))[:n - a]


def collapsed(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words that no run contains after its first period."""
    if not runs:
        return words
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period:start + length] = False
    return [w for w, k in zip(words, keep.tolist()) if k]


def longest_run(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The greatest length; ties: the smallest start, then the smallest period."""
    return min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)


def grouped(batches):
    """(doc_ids, texts) of some millions of code points."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            ids.append(i)
            texts.append(t)
            size += len(t or "")
            if size >= GROUP_CHARS or len(ids) >= 20_000:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def periodic_runs(docs: DataFrame) -> DataFrame:
    """The words of each ``text`` and all its runs: doc_id, words, runs (start, length, period) by start, then period.

    A run is a stretch of words with smallest period q, of at least six words and four periods, that no
    neighbouring word extends. Null and empty texts: no words, no runs. Null doc_id and repeated
    rows: one row each. Other columns are not read; an empty table gives no row. No shuffle; a
    task holds some 4 million code points, or one longer text, at a time.
    """

    def run(batches):
        for ids, texts in grouped(batches):
            words = [words_of(t) for t in texts]
            found = runs_of_texts(words)
            yield pa.RecordBatch.from_arrays([
                pa.array(ids, pa.int64()), pa.array([[w.decode("utf-8") for w in ws] for ws in words], pa.list_(pa.string())),
                pa.array([[{"start": s, "length": n, "period": q} for s, n, q in rs] for rs in found],
                         pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])))],
                names=["doc_id", "words", "runs"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, ALL_SCHEMA)


def run_digests(docs: DataFrame, prepare=None) -> DataFrame:
    """Per document: the number of runs, the longest, a digest of all, and one of the text with every run cut
    to its first period. ``prepare(words, doc_id)`` may change the words first. Rows and limits as of ``periodic_runs``."""

    def run(batches):
        for ids, texts in grouped(batches):
            words = [words_of(t) for t in texts]
            if prepare:
                words = [prepare(w, i) for w, i in zip(words, ids)]
            rows = []
            for i, ws, rs in zip(ids, words, runs_of_texts(words)):
                top = longest_run(rs)
                listed = "".join([f"{s},{n},{q}\n" for s, n, q in rs])
                rows.append((i, len(ws), len(rs), *(top or (None,) * 3), 1000 * top[1] // top[2] if top else None,
                             hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(b" ".join(collapsed(ws, rs))).hexdigest()))
            kinds = [pa.int64()] * 7 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                             names=[c.split()[0] for c in SCHEMA.split(", ")])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, SCHEMA)
