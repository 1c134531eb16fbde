"""Token counts of every prefix of a text by prefix dynamic programming (operator 6).

For a byte-level BPE tokenizer the last token of each prefix is enough to know
its whole encoding: the encoding of a prefix ending in token ``t`` is the
encoding of what stands before ``t``, then ``t``. A suffix of the prefix that is
a token is its last token exactly if that token may follow the last token of
the rest, so one pass from left to right gives the exact count at every prefix.
The counts are stored once; how many tokens a cut text has, or where to cut for
a budget, is then read off without encoding again.
"""

from __future__ import annotations

import json
import math
from array import array
from operator import sub

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratlab.llm.common import worker_cache
from stratlab.llm.units import UnitMemo, units

# The contractions of the pre-tokenizer that have more than one letter.
SPACES = regex.compile(r"\p{White_Space}{2,}")
CONTRACTIONS = ("'re", "'ve", "'ll")
#: Texts whose counts (eight bytes a code point) are held at once.
SLICE_ROWS = 256
SCHEMA = "doc_id bigint, n_bytes bigint, n_chars bigint, n_tokens bigint, prefix_index binary, fits array<bigint>"


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class PrefixCounter:
    """Exact token counts of all prefixes for one ``tokenizers`` BPE file."""

    def __init__(self, path: str):
        from public_tokenizers import PATTERN

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.pattern = regex.compile(PATTERN)
        self.specials = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.vocab: dict[str, int] = spec["model"]["vocab"]
        self.alphabet = byte_alphabet()
        self.ascii_map = dict(enumerate(self.alphabet[:128]))
        self.suffixes = ahocorasick.Automaton()
        for text, token in self.vocab.items():
            if text not in self.special:
                self.suffixes.add_word(text, (len(text), token))
        self.suffixes.make_automaton()
        self.parts: dict[int, tuple[int, int, int]] = {}
        self.merge: dict[tuple[int, int], int] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            left, right = self.vocab[a], self.vocab[b]
            self.merge.setdefault((left, right), rank)
            self.parts.setdefault(self.vocab[a + b], (left, right, rank))
        self.right_edges: dict[int, tuple] = {}
        self.left_edges: dict[int, tuple] = {}
        self.follows: dict[int, bool] = {}
        self.whole: dict[int, bool] = {}
        self.words: dict[str, list[int]] = {}

    def edge(self, token: int, side: int) -> tuple:
        """Tokens at one edge of ``token`` while it is built, each with the rank at
        which it is merged into the next (infinite for the token itself)."""
        out, until = [], math.inf
        while True:
            out.append((token, until))
            if token not in self.parts:
                return tuple(out)
            until = self.parts[token][2]
            token = self.parts[token][side]

    def may_follow(self, a: int, b: int) -> bool:
        """Whether the text of tokens ``a``, ``b`` encodes to just these two: no pair that
        meets at their border is merged before one of both goes into a larger token.
        At equal rank (a run of one token) the left merge happens first."""
        got = self.follows.get(a << 32 | b)
        if got is None:
            if a not in self.right_edges:
                self.right_edges[a] = self.edge(a, 1)
            if b not in self.left_edges:
                self.left_edges[b] = self.edge(b, 0)
            got = True
            merge, left = self.merge, self.left_edges[b]
            for x, until_x in self.right_edges[a]:
                for y, until_y in left:
                    rank = merge.get((x, y))
                    if rank is not None and rank < until_x and rank <= until_y:
                        got = False
                        break
                if not got:
                    break
            if len(self.follows) > 2_000_000:
                self.follows.clear()
            self.follows[a << 32 | b] = got
        return got

    def is_whole(self, token: int) -> bool:
        """Whether the token's own text encodes to it."""
        got = self.whole.get(token)
        if got is None:
            got = True
            if token in self.parts:
                left, right, rank = self.parts[token]
                got = self.is_whole(left) and self.is_whole(right) and self.first_merge(left, right) == rank
            self.whole[token] = got
        return got

    def first_merge(self, a: int, b: int) -> float:
        """The rank of the first merge across the border of two built tokens (infinite: none)."""
        found = math.inf
        for y, until_y in self.edge(b, 0):
            for x, until_x in self.edge(a, 1):
                rank = self.merge.get((x, y))
                if rank is not None and rank < until_x and rank <= until_y:
                    found = min(found, rank)
        return found

    def word_counts(self, word: str) -> list[int]:
        """Token counts of the prefixes (by code point) of one pre-token."""
        got = self.words.get(word)
        if got is None:
            got = self.contraction_counts(word) if word in CONTRACTIONS else self.run_counts(word)
            if len(self.words) > 300_000:
                self.words.clear()
            if len(word) <= 64:
                self.words[word] = got
        return got

    def contraction_counts(self, word: str) -> list[int]:
        """A contraction cut short is two pre-tokens: the apostrophe, then letters."""
        return [1, 1 + self.run_counts(word[1])[-1], self.run_counts(word)[-1]]

    def run_counts(self, word: str) -> list[int]:
        """The dynamic program: the last token and the count of each prefix, by bytes."""
        if word.isascii():
            s, ends = word.translate(self.ascii_map), None
        else:
            raw = word.encode("utf-8")
            s = "".join([self.alphabet[b] for b in raw])
            ends = [k for k in range(1, len(raw) + 1) if k == len(raw) or raw[k] & 0xC0 != 0x80]
        follows = self.follows
        last, count = [-1] * (len(s) + 1), [0] * (len(s) + 1)
        done = -1
        for end, (length, t) in self.suffixes.iter(s):
            if end == done:
                continue
            start = end + 1 - length
            if start:
                before = last[start]
                ok = follows.get(before << 32 | t)
                if ok is None:
                    ok = self.may_follow(before, t)
            else:
                ok = self.is_whole(t)
            if ok:
                last[end + 1] = t
                count[end + 1] = count[start] + 1
                done = end
        return count[1:] if ends is None else [count[e] for e in ends]

    def unit_deltas(self, unit: str) -> list[int]:
        """Changes of the count at each code point of a unit (white space, then non-space).
        A cut inside white space leaves one run, whatever follows it in the unit."""
        first, *rest = self.pattern.findall(unit)
        counts = self.word_counts(first)
        if rest:
            counts = counts[:]
            for w in rest:
                total = counts[-1]
                counts += [total + c for c in self.word_counts(w)]
        for m in SPACES.finditer(unit):
            before = counts[m.start() - 1] if m.start() else 0
            counts = counts[:m.start()] + [before + c for c in self.word_counts(m[0])] + counts[m.end():]
        return list(map(sub, counts, [0, *counts]))

    def encode_units(self, units: list[str]) -> list[bytes]:
        return [pack_deltas(self.unit_deltas(u)) for u in units]

    def special_deltas(self, segment: str, special: str) -> list[int]:
        """Changes of the count while a special string that follows ``segment`` grows: until
        it is whole it is ordinary text joined to the segment."""
        total = sum(self.text_deltas(segment))
        counts = [sum(self.text_deltas(segment + special[:k])) for k in range(1, len(special))] + [total + 1]
        return [c - p for c, p in zip(counts, [total, *counts])]

    def text_deltas(self, text: str) -> list[int]:
        return [x for u in units(text) for x in self.unit_deltas(u)]


def pack_deltas(deltas: list[int]) -> bytes:
    """One signed byte a code point; a larger change (none is known) raises OverflowError."""
    return array("b", deltas).tobytes()


def prefix_counts(prefix_index: bytes) -> np.ndarray:
    """Token counts of the prefixes of 0, 1, 2, ... code points from a stored index."""
    return np.concatenate([[0], np.cumsum(np.frombuffer(prefix_index, dtype=np.int8), dtype=np.int64)])


def tokens_in_prefix(prefix_index: bytes, n_chars: int) -> int:
    """Tokens of the text cut after ``n_chars`` code points."""
    counts = prefix_counts(prefix_index)
    return int(counts[min(n_chars, len(counts) - 1)])


def chars_within(prefix_index: bytes, budget: int) -> int:
    """The longest prefix, in code points, of at most ``budget`` tokens."""
    return int(np.flatnonzero(prefix_counts(prefix_index) <= budget)[-1])


def index_texts(counter: PrefixCounter, memo: UnitMemo, texts: list[str]) -> list[bytes]:
    """The stored index of each text."""
    plain = [t for t in texts if not (counter.specials and counter.specials.search(t))]
    values = iter(memo.values(plain))
    out = []
    for t in texts:
        if not (counter.specials and counter.specials.search(t)):
            out.append(b"".join(next(values)))
            continue
        pieces, at = [], 0
        for m in counter.specials.finditer(t):
            segment = t[at:m.start()]
            pieces += memo.values([segment])[0] + [pack_deltas(counter.special_deltas(segment, m[0]))]
            at = m.end()
        out.append(b"".join(pieces + memo.values([t[at:]])[0]))
    return out


def count_prefix_tokens(docs: DataFrame, tokenizer: str, budgets: tuple[int, ...] = (512,)) -> DataFrame:
    """Exact token counts at every prefix of ``text``; one row per input row.

    ``tokenizer`` is the path of a byte-level BPE file of the ``tokenizers``
    library, the same on all machines. Special strings inside texts count as the
    library's default has it (one token each); no special token is added.

    Returns doc_id, n_bytes (UTF-8), n_chars, n_tokens, ``prefix_index`` (one signed
    byte a code point: the change of the count; read it with ``tokens_in_prefix``
    and ``chars_within``) and ``fits`` (for each budget, the code points of the longest
    prefix within it). Null text: as empty (0 tokens, empty index). Null doc_id: kept
    null. Repeated rows: one row each. Other columns, also of clashing names, are
    not read. No shuffle; memory is bounded by one Arrow batch of texts and the counts of ``SLICE_ROWS`` of them.
    """

    def run(batches):
        counter = worker_cache("prefix:" + tokenizer, "counter", lambda: PrefixCounter(tokenizer))
        memo = worker_cache("prefix:" + tokenizer, "memo", lambda: UnitMemo(counter.encode_units))
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                texts = [t or "" for t in part.column(1).to_pylist()]
                index = index_texts(counter, memo, texts)
                counts = [prefix_counts(i) for i in index]
                yield pa.RecordBatch.from_arrays([
                    part.column(0),
                    pa.array([len(t.encode("utf-8")) for t in texts], pa.int64()),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([int(c[-1]) for c in counts], pa.int64()),
                    pa.array(index, pa.binary()),
                    pa.array([[int(np.flatnonzero(c <= b)[-1]) for b in budgets] for c in counts], pa.list_(pa.int64())),
                ], names=["doc_id", "n_bytes", "n_chars", "n_tokens", "prefix_index", "fits"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, SCHEMA)
