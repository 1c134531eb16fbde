"""Alignment of two tokenizers by galloping intersection (operator 13).

The tokens of a text end at byte offsets. The shorter list of ends drives: each of its ends is looked
for in the longer list from the last match on, by steps that double and then a binary search. The ends that both
have cut the two token sequences into groups; differences of their ranks are the token ranges that
overlap each other.
"""

from __future__ import annotations

import hashlib
from array import array
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratlab.llm.common import Scratch, worker_cache
from stratlab.llm.packing import UNITS, IdEncoder
from stratlab.llm.tokens import byte_alphabet
from stratlab.llm.units import UnitMemo, simple

SPACE_MARK = "▁"
OF_B = 1 << 31
DIFFERS = OF_B - 1
#: Code points of the documents of one block.
BLOCK_CHARS = 16_000_000
#: Links of a block that are sorted at once.
LINKS_AT_ONCE = 1 << 18
GROUP_SCHEMA = ("doc_id bigint, a_ids array<int>, b_ids array<int>, "
                "groups array<struct<a_from: int, a_to: int, b_from: int, b_to: int>>")
DOC_SCHEMA = ("block bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, links binary, "
              "pairs array<bigint>, uses array<bigint>")
RESULT = ("doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, "
          "groups_sha256 string")


def common_ends(a: list[int], b: list[int]) -> tuple[list[int], list[int]]:
    """Ranks in ``a`` and in ``b`` (both increasing) of the values that both hold."""
    if len(b) < len(a):
        there, here = common_ends(b, a)
        return here, there
    ranks_a, ranks_b = [], []
    if not a:
        return ranks_a, ranks_b
    n = len(b)
    b = [*b, a[-1] + 1]  # stands behind all that is looked for
    at, here = 0, b[0]
    for i, end in enumerate(a):
        if here < end:
            at += 1
            here = b[at]
            if here < end:
                step = 1
                while at + step < n and b[at + step] < end:
                    at += step
                    step *= 2
                at = bisect_left(b, end, at + 1, min(at + step, n))
                here = b[at]
        if here == end:
            ranks_a.append(i)
            ranks_b.append(at)
            at += 1
            here = b[at]
    return ranks_a, ranks_b


class Aligner:
    """Ids of texts by both tokenizers, and their bytes.

    ``path_a``: a byte-level BPE file of ``tokenizers``; ``path_b``: a ``sentencepiece`` model that puts a space
    before the text. A is given the text with that space.
    """

    def __init__(self, path_a: str, path_b: str):
        from sentencepiece import SentencePieceProcessor

        self.a = IdEncoder(path_a)
        self.a.tokenizer.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=path_b)
        to_byte = {c: i for i, c in enumerate(byte_alphabet())}
        special = set(self.a.special)
        vocab = self.a.tokenizer.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.bytes_a[i] = token.encode() if token in special else bytes([to_byte[c] for c in token])
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE_MARK, " ").encode()
                        for i, p in enumerate(pieces)]
        # A text may be cut before single spaces if no piece has a space after anything else.
        self.cut = self.a.direct and set(to_byte) <= set(vocab) and not any(SPACE_MARK in p.lstrip(SPACE_MARK) for p in pieces)
        self.sizes_a = np.array([len(x) for x in self.bytes_a])
        self.sizes_b = np.array([len(x) for x in self.bytes_b])
        self.text_a = [str(i) for i in range(len(self.bytes_a))]
        self.text_b = [str(i) for i in range(len(self.bytes_b))]
        self.memo = UnitMemo(self.encode_units, limit=UNITS)

    def encode_units(self, units: list[str]) -> list[bytes]:
        """Ids of both for units that start with one space, as unsigned 32-bit numbers; those of B have the
        highest bit. ``DIFFERS`` stands before them if B does not give back the unit."""
        out, bytes_b = [], self.bytes_b.__getitem__
        for unit, of_a, of_b in zip(units, self.a.encode_units(units), self.b.encode([u[1:] for u in units], num_threads=1)):
            both = array("I", of_a)
            if b"".join(map(bytes_b, of_b)) != unit.encode("utf-8"):
                both.append(DIFFERS)
            both.extend([i | OF_B for i in of_b])
            out.append(both.tobytes())
        return out

    def same(self, text: str, a: list[int], b: list[int]) -> bool:
        raw = text.encode("utf-8")
        return b"".join(map(self.bytes_a.__getitem__, a)) == raw == b"".join(map(self.bytes_b.__getitem__, b))

    def ids(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids by A of a space and the text, and by B of the text. None for an empty text, and where the bytes of
        the tokens are not those of a space and the text."""
        whole = [" " + t for t in texts]
        cut = [bool(t) and self.cut and simple(w) for t, w in zip(texts, whole)]
        known = iter(self.memo.values([w for w, c in zip(whole, cut) if c]))
        out, none = [], np.zeros(0, np.int64)
        for t, w, c in zip(texts, whole, cut):
            if not t:
                out.append((none, none))
            elif c:
                both = np.frombuffer(b"".join(next(known)), "<u4").astype(np.int64)
                odd = both == DIFFERS
                second = both >= OF_B
                a, b = both[~(second | odd)], both[second] - OF_B
                out.append((none, none) if odd.any() and not self.same(w, a.tolist(), b.tolist()) else (a, b))
            else:
                a, b = self.a.tokenizer.encode(w, add_special_tokens=False).ids, self.b.encode(t)
                out.append((np.array(a, np.int64), np.array(b, np.int64)) if self.same(w, a, b) else (none, none))
        return out

    def align(self, a: np.ndarray, b: np.ndarray) -> tuple[list[int], list[int]]:
        """Ranks of the last token of each group."""
        return common_ends(np.cumsum(self.sizes_a[a]).tolist(), np.cumsum(self.sizes_b[b]).tolist())

    def listed(self, a: np.ndarray, b: np.ndarray, ends_a: list[int], ends_b: list[int]) -> str:
        """The groups as text: ids of A, a bar, ids of B; groups by semicolons."""
        a, b = list(map(self.text_a.__getitem__, a.tolist())), list(map(self.text_b.__getitem__, b.tolist()))
        out, i, j = [], 0, 0
        for x, y in zip(ends_a, ends_b):
            if x == i and y == j:
                out.append(a[i] + "|" + b[j])
            else:
                out.append(",".join(a[i:x + 1]) + "|" + ",".join(b[j:y + 1]))
            i, j = x + 1, y + 1
        return ";".join(out)


def aligner(path_a: str, path_b: str) -> Aligner:
    return worker_cache(f"aligner:{path_a}:{path_b}", "aligner", lambda: Aligner(path_a, path_b))


def align_tokens(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Ids by both tokenizers and the groups of every ``text``: token ranges (end excluded) that cover the same bytes.

    Texts that are null or empty, or that the tokens of either do not give back byte by byte after a
    space, have empty lists. Null doc_id and repeated rows: one row each. Other columns are
    not read; an empty table gives no row. No shuffle; memory is that of one slice of 256 rows.
    """

    def run(batches):
        both = aligner(path_a, path_b)
        group = pa.struct([(n, pa.int32()) for n in ("a_from", "a_to", "b_from", "b_to")])
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = both.ids([t or "" for t in part.column(1).to_pylist()])
                groups = []
                for a, b in ids:
                    x, y = both.align(a, b)
                    groups.append([{"a_from": i, "a_to": p + 1, "b_from": j, "b_to": q + 1}
                                   for i, p, j, q in zip([0] + [e + 1 for e in x], x, [0] + [e + 1 for e in y], y)])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([a.tolist() for a, _ in ids], pa.list_(pa.int32())),
                     pa.array([b.tolist() for _, b in ids], pa.list_(pa.int32())), pa.array(groups, pa.list_(group))],
                    names=["doc_id", "a_ids", "b_ids", "groups"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, GROUP_SCHEMA)


class Links:
    """The links of a block, given as id pairs, kept as numbers into lists of distinct pairs."""

    def __init__(self):
        self.waiting: list[np.ndarray] = []
        self.size = 0
        self.numbered: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, keys: np.ndarray) -> None:
        self.waiting.append(keys)
        self.size += len(keys)
        if self.size >= LINKS_AT_ONCE:
            self.number()

    def number(self) -> None:
        pairs, at, uses = np.unique(np.concatenate([*self.waiting, np.zeros(0, np.int64)]), return_inverse=True, return_counts=True)
        self.numbered.append((pairs, at.astype("<u4"), uses))
        self.waiting, self.size = [], 0

    def take(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All distinct pairs (sorted), the rank of each link's pair among them, and how often each is linked; none are held afterwards."""
        self.number()
        parts, self.numbered = self.numbered, []
        pairs, rank = np.unique(np.concatenate([p for p, _, _ in parts]), return_inverse=True)
        uses = np.bincount(rank, weights=np.concatenate([n for _, _, n in parts]), minlength=len(pairs)).astype(np.int64)
        rank, start, at = rank.astype("<u4"), 0, []
        for p, own, _ in parts:
            at.append(rank[start:start + len(p)][own])
            start += len(p)
        return pairs, np.concatenate(at), uses


def aligned_blocks(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One row per document with its links as numbers into the block's list of id pairs, and one row per block
    (null n_a) with that list and how often each pair is linked in it."""

    def run(batches):
        from pyspark import TaskContext

        both = aligner(path_a, path_b)
        block = TaskContext.get().partitionId() << 32
        rows, links, held = [], Links(), 0
        names = [c.split()[0] for c in DOC_SCHEMA.split(", ")]
        kinds = [pa.int64()] * 5 + [pa.string(), pa.binary()] + [pa.list_(pa.int64())] * 2

        def flush():
            pairs, at, uses = links.take()
            start = 0
            for k in range(0, len(rows), 2048):
                part = rows[k:k + 2048]
                index = []
                for r in part:
                    index.append(at[start:start + r[3]].tobytes())
                    start += r[3]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block] * len(part), pa.int64())] + [pa.array(c, t) for c, t in zip(zip(*part), kinds[1:6])]
                    + [pa.array(index, pa.binary())] + [pa.nulls(len(part), t) for t in kinds[7:]], names=names)
            for k in range(0, len(pairs), 1 << 16):  # a pair's place is its rank in the block
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block], pa.int64())] + [pa.nulls(1, t) for t in kinds[1:7]]
                    + [pa.array([x[k:k + (1 << 16)]], pa.list_(pa.int64())) for x in (pairs, uses)], names=names)

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [t or "" for t in part.column(1).to_pylist()]
                for doc, text, (a, b) in zip(part.column(0).to_pylist(), texts, both.ids(texts)):
                    x, y = both.align(a, b)
                    digest = hashlib.sha256(both.listed(a, b, x, y).encode()).hexdigest() if len(a) else ""
                    rows.append((doc, len(a), len(b), len(x), digest))
                    if x:
                        links.add(a[x] << 32 | b[y])
                    held += len(text)
                    if held >= BLOCK_CHARS:
                        yield from flush()
                        block, rows, held = block + 1, [], 0
        if rows:
            yield from flush()

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, DOC_SCHEMA)


def align_statistics(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per document: tokens of both, groups, links (pairs of tokens that end together), and how common the linked id pairs
    are in the whole corpus: ``n_best`` links hold the commonest partner of their B id (ties included), ``count_sum``
    adds up the corpus counts of the links; ``groups_sha256`` is a digest of all groups ('' without tokens).

    Texts that are null or empty, or that the tokens of either do not give back byte by byte after a space: zeros. Null doc_id and
    repeated rows: one row each, and each counts. Other columns are not read; an empty table gives no row.

    Documents are counted in blocks of some 16 million code points (one longer text is a block of its own). A block asks
    once for each of its id pairs, so that no pair has more rows in any shuffle than there are blocks.
    """
    scratch = Scratch(docs.sparkSession, "align")
    table = scratch.write(aligned_blocks(docs, path_a, path_b), "blocks")
    asked = table.where("n_a is null").select(
        F.col("block").alias("home"), F.explode(F.arrays_zip("pairs", "uses")).alias("p")).select(
        "home", F.col("p.pairs").alias("pair"), F.col("p.uses").alias("uses"))
    totals = scratch.write(asked.groupBy("pair").agg(F.sum("uses").alias("n")), "totals")
    b_id = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)).alias("b")
    most = totals.groupBy(b_id).agg(F.max("n").alias("most"))
    ranked = totals.withColumn("b", b_id).join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
    answers = asked.select("home", "pair").join(ranked, "pair")

    def look_up(left, right):
        order = np.argsort(right.column("pair").to_numpy())
        n = right.column("n").to_numpy()[order]
        best = right.column("best").to_numpy(zero_copy_only=False).astype(np.int64)[order]
        total, common = [], []
        for raw in left.column("links").to_pylist():
            at = np.frombuffer(raw, "<u4")
            total.append(int(n[at].sum()))
            common.append(int(best[at].sum()))
        groups = left.column("n_groups")
        return pa.table([left.column("doc_id"), left.column("n_a"), left.column("n_b"), groups, groups, pa.array(common, pa.int64()),
                         pa.array(total, pa.int64()), left.column("groups_sha256")],
                        names=[c.split()[0] for c in RESULT.split(", ")])

    documents = table.where("n_a is not null").drop("pairs", "uses")
    return documents.groupBy("block").cogroup(answers.groupBy("home")).applyInArrow(look_up, RESULT)
