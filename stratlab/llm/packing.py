"""Vector bin packing of tokenized examples (operator 7).

An example has three sizes: tokens, one segment, and loss-bearing tokens. A
sequence has a limit on each. The dot-product heuristic fills one sequence at a
time: of the examples that still fit it takes the one whose sizes, weighted by
mean demand, point most the way of the room that is left. Where examples may be
cut, the head of a remaining example fills the last gap.
"""

from __future__ import annotations


from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratlab.llm.common import worker_cache
from stratlab.llm.tokens import byte_alphabet
from stratlab.llm.units import UnitMemo

END_ID = 1
BLOCK_TOKENS = 4_000_000
BLOCK_EXAMPLES = 4_096
#: Units whose ids a worker remembers.
UNITS = 400_000
SCHEMA = ("doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, loss_tokens bigint, "
          "sequence_id bigint, offset bigint")


def loss_in(start: int, length: int, tokens: int, loss: int) -> int:
    """Loss-bearing tokens of a piece; they are the last ``loss`` tokens of the example."""
    return max(0, start + length - max(start, tokens - loss))


def head(start: int, tokens: int, loss: int, room: int, loss_room: int) -> int:
    """The longest piece from ``start`` within the room for tokens and for loss tokens."""
    return min(tokens - start, room, max(0, tokens - loss - start) + loss_room)


def pack_block(tokens, loss, limits: tuple[int, int, int], cut: bool) -> list[list[tuple[int, int, int]]]:
    """Sequences as lists of (example, start, length) in order.

    ``limits``: tokens, segments, loss-bearing tokens of a sequence. With ``cut``
    an example may be split anywhere, and a sequence that stays short is split
    into lengths that are powers of two. Without it an example beyond a limit
    raises ValueError. Ties go to the earlier example.
    """
    max_tokens, max_segments, max_loss = limits
    if min(limits) < 1:
        raise ValueError(f"limits must be positive: {limits}")
    sequences: list[list[tuple[int, int, int]]] = []
    starts = np.zeros(len(tokens), dtype=np.int64)
    for i, (n, own) in enumerate(zip(tokens, loss)):
        if not cut:
            if n > max_tokens or own > max_loss:
                raise ValueError(f"an example of {n} tokens, {own} with loss, is beyond the limits {limits}")
            continue
        while n - starts[i] >= max_tokens or loss_in(int(starts[i]), int(n - starts[i]), n, own) >= max_loss:
            length = head(int(starts[i]), n, own, max_tokens, max_loss)
            sequences.append([(i, int(starts[i]), length)])
            starts[i] += length
            if starts[i] == n:
                break
    left = np.array([n - s for n, s in zip(tokens, starts)], dtype=np.int64)
    own = np.array([loss_in(int(s), int(r), n, w) for s, r, n, w in zip(starts, left, tokens, loss)], dtype=np.int64)
    alive = left > 0
    demand = np.stack([left / max_tokens, np.full(len(left), 1 / max_segments), own / max_loss], axis=1)
    weights = demand[alive].mean(axis=0) if alive.any() else np.ones(3)
    while alive.any():
        open_, room = [], np.array([max_tokens, max_segments, max_loss], dtype=np.int64)
        while room[1] > 0 and room[0] > 0:
            fits = alive & (left <= room[0]) & (own <= room[2])
            if not fits.any():
                break
            score = np.where(fits, demand @ (weights * room / np.array(limits)), -1.0)
            i = int(score.argmax())
            open_.append((i, int(starts[i]), int(left[i])))
            room -= [left[i], 1, own[i]]
            alive[i] = False
        if cut and room[1] > 0 and room[0] > 0 and alive.any():
            i = int(np.where(alive, left, -1).argmax())
            s, n, w = int(starts[i]), int(tokens[i]), int(loss[i])
            length = head(s, n, w, int(room[0]), int(room[2]))
            if length:
                open_.append((i, s, length))
                starts[i] += length
                left[i] -= length
                own[i] = loss_in(int(starts[i]), int(left[i]), n, w)
                demand[i] = left[i] / max_tokens, 1 / max_segments, own[i] / max_loss
        total = sum(x[2] for x in open_)
        sequences += by_powers(open_, total) if cut and total < max_tokens else [open_]
    return sequences


def by_powers(pieces: list[tuple[int, int, int]], total: int) -> list[list[tuple[int, int, int]]]:
    """The pieces of a short sequence dealt to sequences whose lengths are the powers of two in ``total``."""
    out, queue = [], list(reversed(pieces))
    for bit in range(total.bit_length() - 1, -1, -1):
        room = total & (1 << bit)
        own = []
        while room:
            i, s, n = queue.pop()
            if n > room:
                queue.append((i, s + room, n - room))
                n = room
            own.append((i, s, n))
            room -= n
        if own:
            out.append(own)
    return out


class IdEncoder:
    """Token ids of texts by a ``tokenizers`` file, as little-endian unsigned 32-bit bytes.

    For byte-level BPE files, texts are encoded by token ranks or, where the ids of the file do not follow its merges,
    units not met before are cut into pre-tokens and given to the file's BPE model directly; other files encode every text whole.
    """

    def __init__(self, path: str):
        import json

        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.path = path
        self.tokenizer = Tokenizer.from_file(path)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        before = spec["pre_tokenizer"] or {}
        self.direct = (spec["normalizer"] is None and before.get("type") == "ByteLevel" and before.get("use_regex", True)
                       and not before.get("add_prefix_space"))
        if self.direct:
            import regex
            from public_tokenizers import PATTERN

            self.split = regex.compile(PATTERN).findall
            self.alphabet = byte_alphabet()
            self.ascii = dict(enumerate(self.alphabet[:128]))
            self.model = self.tokenizer.model
            self.ranked = self.by_ranks(spec)
            self.memo = UnitMemo(self.encode_units, limit=UNITS)

    def by_ranks(self, spec: dict):
        """An encoder of texts by token ranks, where the ids of the file grow in the order of its merges: then
        the pair merged first is the one whose token has the smallest id."""
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        made = [vocab["".join(m) if isinstance(m, list) else m.replace(" ", "")] for m in merges]
        to_byte = {c: i for i, c in enumerate(self.alphabet)}
        if len(self.alphabet) != sum(c in vocab for c in self.alphabet) or any(x >= y for x, y in zip(made, made[1:])) \
                or max(vocab[c] for c in self.alphabet) >= min(made, default=len(vocab)):
            return None
        import tiktoken
        from public_tokenizers import PATTERN

        ranks = {bytes([to_byte[c] for c in t]): i for t, i in vocab.items() if t not in self.special}
        return tiktoken.Encoding(self.path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=self.special)

    def encode_ranked(self, text: str) -> bytes:
        """Ids of a text without special strings; tiktoken gives up on a million and more white-space characters in a row."""
        try:
            return self.ranked.encode_to_numpy(text, disallowed_special=()).tobytes()
        except ValueError:
            return self.encode([text])[0]

    def encode_units(self, units: list[str]) -> list[bytes]:
        if self.ranked:
            return [array("I", ids).tobytes() for ids in map(self.ranked.encode_ordinary, units)]
        return [b"".join([self.encode_word(w) for w in self.split(u)]) for u in units]

    def encode_word(self, word: str) -> bytes:
        mapped = word.translate(self.ascii) if word.isascii() else "".join([self.alphabet[b] for b in word.encode("utf-8")])
        return array("I", [t.id for t in self.model.tokenize(mapped)]).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def ids(self, texts: list[str]) -> list[bytes]:
        if not self.direct:
            return self.encode(texts)
        plain = [not any(s in t for s in self.special) for t in texts]
        if self.ranked:
            return [self.encode_ranked(t) if p else self.encode([t])[0] for t, p in zip(texts, plain)]
        known = iter(self.memo.values([t for t, p in zip(texts, plain) if p]))
        return [b"".join(next(known)) if p else self.encode([t])[0] for t, p in zip(texts, plain)]


def pack_documents(docs: DataFrame, tokenizer: str, max_tokens: int = 2048, max_segments: int = 128,
                   max_loss_tokens: int | None = None, prompt_chars: str | None = None,
                   cut: bool = True) -> DataFrame:
    """Tokenize ``text`` and pack it into sequences; one row per piece.

    ``tokenizer``: path of a ``tokenizers`` file, the same on all machines. Each
    document is its ids, then id 1. ``max_loss_tokens`` (default ``max_tokens``) limits the
    loss-bearing tokens of a sequence. ``prompt_chars`` names an optional column: so
    many code points at the start of the text bear no loss (their tokens are
    counted by encoding them alone); without it every token bears loss.

    Examples are packed in blocks within the task that reads them (at most 4096
    examples or about 4 million tokens), so nothing is shuffled, memory is bounded,
    and a block leaves at most one short sequence before it is split into powers
    of two. ``sequence_id`` holds the task and a running number. The input must be a
    table whose partitions come out the same when a task runs again (files, not the
    result of a shuffle). Returns doc_id, start, length, ids (little-endian unsigned
    32-bit), doc_tokens, loss_tokens, sequence_id, offset. Null text: as empty (the end
    id alone). Null doc_id and repeated rows: each row is packed for itself. Other columns are not read. An
    empty table gives no row.
    """
    limits = (max_tokens, max_segments, max_loss_tokens or max_tokens)
    columns = [F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text")]
    if prompt_chars:
        columns.append(F.col(prompt_chars).cast("bigint").alias("prompt"))

    def run(batches):
        from pyspark import TaskContext

        encoder = worker_cache("id_encoder:" + tokenizer, "encoder", lambda: IdEncoder(tokenizer))
        base = TaskContext.get().partitionId() << 40
        end = np.array([END_ID], dtype="<u4").tobytes()
        done, docs_, ids_, loss_ = 0, [], [], []

        def flush():
            nonlocal done
            rows = []
            sizes = [len(b) // 4 for b in ids_]
            for pieces in pack_block(sizes, loss_, limits, cut):
                offset = 0
                for i, s, n in pieces:
                    rows.append((docs_[i], s, n, ids_[i][4 * s:4 * (s + n)], sizes[i],
                                 loss_in(s, n, sizes[i], loss_[i]), base + done, offset))
                    offset += n
                done += 1
            docs_.clear(), ids_.clear(), loss_.clear()
            kinds = [pa.int64()] * 3 + [pa.binary()] + [pa.int64()] * 4
            names = ["doc_id", "start", "length", "ids", "doc_tokens", "loss_tokens", "sequence_id", "offset"]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 8, kinds)], names=names)

        held = 0
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                texts = [t or "" for t in part.column(1).to_pylist()]
                prompts = None
                if prompt_chars:
                    prompts = [len(p) // 4 for p in encoder.ids(
                        [t[:max(0, k or 0)] for t, k in zip(texts, part.column(2).to_pylist())])]
                for k, (d, b) in enumerate(zip(part.column(0).to_pylist(), encoder.ids(texts))):
                    docs_.append(d)
                    ids_.append(b + end)
                    n = len(b) // 4 + 1
                    loss_.append(n if prompts is None else max(1, n - prompts[k]))
                    held += n
                    if held >= BLOCK_TOKENS or len(docs_) >= BLOCK_EXAMPLES:
                        held = 0
                        yield flush()
        if docs_:
            yield flush()

    return docs.select(*columns).mapInArrow(run, SCHEMA)
