import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stratlab.llm import packing, tokens, units
from stratlab.llm.queries import tokenizer_path

LIBRARY = Tokenizer.from_file(tokenizer_path())
COUNTER = tokens.PrefixCounter(tokenizer_path())
MEMO = units.UnitMemo(COUNTER.encode_units)
ENCODER = packing.IdEncoder(tokenizer_path())
PIECES = st.lists(st.sampled_from(["a", "the", "'ll", "'", "'s", " ", "  ", "\n", "\t", "\xa0", "é", "日", "🙂", "12", "!?", "--", "<|endoftext|>", "E"]), max_size=14)


def library(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(PIECES)
def test_every_prefix_has_the_count_of_the_library(parts):
    text = "".join(parts)
    got = tokens.prefix_counts(tokens.index_texts(COUNTER, MEMO, [text])[0])
    assert got.tolist() == [len(library(text[:k])) for k in range(len(text) + 1)]


@settings(max_examples=150, deadline=None)
@given(PIECES)
def test_ids_are_those_of_the_library(parts):
    text = "".join(parts)
    assert np.frombuffer(ENCODER.ids([text])[0], "<u4").tolist() == library(text)
    assert "".join(units.units(text)) == text


def test_budget_and_truncation_are_read_from_the_index():
    text = "one two three, four five!"
    index = tokens.index_texts(COUNTER, MEMO, [text])[0]
    for budget in range(9):
        k = tokens.chars_within(index, budget)
        assert tokens.tokens_in_prefix(index, k) <= budget
        assert all(len(library(text[:j])) > budget for j in range(k + 1, len(text) + 1))


def test_memo_stays_right_when_it_is_emptied():
    memo = units.UnitMemo(COUNTER.encode_units, limit=3)
    for text in ["a b c d", "x" * 200 + " y", "a b", "e f g h i"]:
        assert sum(np.frombuffer(b"".join(memo.values([text])[0]), np.int8)) == len(library(text))


def test_count_awkward_rows(awkward, nothing):
    rows = tokens.count_prefix_tokens(awkward, tokenizer_path()).collect()
    texts = [r.text or "" for r in awkward.collect()]
    assert sorted(r.n_tokens for r in rows) == sorted(len(library(t)) for t in texts)
    assert sorted(r.n_bytes for r in rows) == sorted(len(t.encode()) for t in texts)
    assert tokens.count_prefix_tokens(nothing, tokenizer_path()).count() == 0


def test_blocks_respect_all_limits_and_use_each_token_once():
    rng = random.Random(5)
    for cut in (True, False):
        sizes = [rng.choice([1, 3, 17, 60, 100]) + (rng.randint(0, 400) if cut else 0) for _ in range(300)]
        loss = [rng.randint(1, n) for n in sizes]
        limits = (128, 5, 100)
        seen = {}
        for sequence in packing.pack_block(sizes, loss, limits, cut):
            assert sum(n for *_, n in sequence) <= 128 and len(sequence) <= 5
            assert sum(packing.loss_in(s, n, sizes[i], loss[i]) for i, s, n in sequence) <= 100
            for i, s, n in sequence:
                seen.setdefault(i, []).append((s, n))
        for i, n in enumerate(sizes):
            at = 0
            for s, length in sorted(seen[i]):
                assert s == at and length > 0
                at += length
            assert at == n


def test_cut_documents_leave_no_padding():
    sizes = [random.Random(1).randint(1, 3000) for _ in range(200)]
    for sequence in packing.pack_block(sizes, sizes, (2048, 128, 2048), True):
        total = sum(n for *_, n in sequence)
        assert total & (total - 1) == 0


def test_dot_product_takes_what_fits_the_room():
    # tokens are scarce after the first example: the small one goes beside it, not the large one
    assert packing.pack_block([90, 50, 10], [1, 1, 1], (100, 4, 100), False)[0] == [(0, 0, 90), (2, 0, 10)]


def test_an_example_beyond_the_limits_is_refused_uncut():
    with pytest.raises(ValueError):
        packing.pack_block([200], [1], (100, 4, 100), False)


def test_pack_awkward_rows(awkward, nothing):
    out = packing.pack_documents(awkward, tokenizer_path(), 256, prompt_chars="n_chars").collect()
    want = sorted(len(library(r.text or "")) + 1 for r in awkward.collect())
    assert sum(r.length for r in out) == sum(want)
    by_sequence = {}
    for r in out:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        assert len(r.ids) == 4 * r.length
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 256
    whole = [r for r in out if r.doc_id == 7]
    assert np.frombuffer(b"".join(r.ids for r in sorted(whole, key=lambda r: r.start)), "<u4").tolist() == library("a") + [1]
    assert packing.pack_documents(nothing, tokenizer_path()).count() == 0


def test_query_crc_is_that_of_the_ids(spark):
    df = spark.createDataFrame([(1, bytes([1, 0, 0, 0]))], "a int, ids binary")
    import zlib
    assert df.select(F.crc32("ids")).first()[0] == zlib.crc32(bytes([1, 0, 0, 0]))


def test_encoders_remember_a_bounded_number_of_units():
    encoder = packing.IdEncoder(tokenizer_path())
    for k in range(0, 500_000, 50_000):
        encoder.ids([" ".join(f"u{i}" for i in range(k, k + 50_000))])
    assert len(encoder.memo.known) + len(encoder.memo.spaced) <= 460_000


def test_ranked_files_encode_texts_whole_and_remember_nothing():
    encoder = packing.IdEncoder(tokenizer_path())
    texts = ["the plan, the plan's end", "", "x" * 400 + " é 日\u3000 🙂", "a\n" + "\n" * 1_200_000 + "b", "say <|endoftext|> here"]
    assert [np.frombuffer(b, "<u4").tolist() for b in encoder.ids(texts)] == [library(t) for t in texts]
    assert encoder.ranked and not encoder.memo.known and not encoder.memo.spaced
