"""Quality rules: compression bands beside counts of symbols and repeats (operator 9).

Text that repeats itself compresses far better than prose, random or encoded
text hardly at all. The zstandard ratio (bytes before / bytes after) of the whole
text, and of its chunks of fixed size, must lie in a band that depends on the
length, as longer texts always compress a little better.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA = ("doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
          "n_repeat_words bigint, base_failed boolean, ratio double, bad_chunk_share double, kept boolean")
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
LEVEL = 3
CHUNK_BYTES = 4096
#: (bytes, lowest ratio), on straight lines over the logarithm of the bytes in between; under the first no lower limit, as
#: there the frame and the code table outweigh the gain of prose and noise alike. Code for code, independent letters and digits
#: (base64, keys, hashes) cannot shrink below log2(62) = 5.95 bits a byte, one letter case below log2(26) = 4.70: ratios up to 1.42
#: and 1.73, also when cut into words. English prose (Python's help topics, licence texts) has 1.06 at least at 150 bytes, 1.34
#: at 500, 1.56 at 1,000, 1.74 at 2,000, 1.96 at 4,096. Scripts of two or three bytes a letter were not measured.
LOWEST = ((150, 1.04), (200, 1.10), (300, 1.19), (500, 1.32), (1_000, 1.50), (2_000, 1.68), (4_096, 1.75))
#: (from so many bytes on, highest ratio).
HIGHEST = ((0, 2.6), (1_000, 2.8), (2_000, 3.0), (5_000, 3.2), (20_000, 3.5))
#: A text fails if chunks with more than this share of its bytes lie outside the band for their length.
MAX_BAD_CHUNKS = 0.25


def repeated_words(words: list[bytes], window: int = 8) -> int:
    """Words that lie in a window of ``window`` words found at least twice in the text.

    Exact: windows get ranks by doubling (pairs of ranks of half the length).
    ``window`` must be a power of two.
    """
    n = len(words) - window + 1
    if n < 2:
        return 0
    numbers: dict[bytes, int] = {}
    rank = np.array([numbers.setdefault(w, len(numbers)) for w in words], dtype=np.int64)
    if len(numbers) == len(words):
        return 0
    size, counts = 1, None
    while size < window:
        pair = rank[:-size] * (len(words) + 1) + rank[size:]
        _, rank, counts = np.unique(pair, return_inverse=True, return_counts=True)
        if len(counts) == len(pair):
            return 0
        size *= 2
    found = counts[rank] > 1
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    edges[:n] += found
    edges[window:] -= found
    return int((np.cumsum(edges[:-1]) > 0).sum())


def lowest(size: int) -> float:
    """The lowest ratio of a text of so many bytes."""
    sizes, ratios = zip(*LOWEST)
    return float(np.interp(np.log(size), np.log(sizes), ratios)) if size >= sizes[0] else 0.0


def in_band(size: int, ratio: float) -> bool:
    return lowest(size) <= ratio <= next(high for start, high in reversed(HIGHEST) if size >= start)


def measure(text: str, compressor) -> tuple:
    """The columns of SCHEMA after doc_id for one text."""
    raw = text.encode("utf-8")
    words = raw.split()
    n = len(words)
    seen: set[str] = set()
    dup_lines = 0
    for line in text.split("\n"):
        if line in seen:
            dup_lines += 1
        elif line.strip(SPACES):
            seen.add(line)
    repeated = repeated_words(words)
    base_failed = n < 20 or 100 * repeated > 30 * n
    ratio = len(raw) / len(compressor.compress(raw)) if raw else 0.0
    fits = in_band(len(raw), ratio)
    if len(raw) > CHUNK_BYTES:
        chunks = [raw[k:k + CHUNK_BYTES] for k in range(0, len(raw), CHUNK_BYTES)]
        share = sum(len(c) for c in chunks if not in_band(len(c), len(c) / len(compressor.compress(c)))) / len(raw)
    else:
        share = float(not fits)
    kept = not base_failed and fits and share <= MAX_BAD_CHUNKS
    return (n, len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)), dup_lines, repeated,
            base_failed, ratio, share, kept)


def compression_rules(docs: DataFrame) -> DataFrame:
    """Counts and the compression verdict for every document; one row per input row.

    Words are runs of characters other than ASCII white space. ``base_failed``: under 20
    words, or over 30 % of the words in repeated windows of 8 words. ``kept``: not
    base_failed, the whole text's ratio in the band for its length, and at most a
    quarter of its bytes in 4096-byte chunks (the last may be shorter) outside theirs; a text of one chunk has a
    ``bad_chunk_share`` of 0 or 1. Null text: as empty (no
    words, base_failed). Null doc_id: kept null. Repeated rows: one row each. Other columns are not
    read. No shuffle; memory is bounded by one Arrow batch.
    """
    def run(batches):
        import zstandard

        compressor = zstandard.ZstdCompressor(level=LEVEL)
        kinds = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.float64(), pa.bool_()]
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        for batch in batches:
            rows = [measure(t or "", compressor) for t in batch.column(1).to_pylist()]
            columns = zip(*rows) if rows else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))], names=names)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, SCHEMA)
