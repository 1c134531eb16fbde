import hashlib
import random
import tracemalloc
from collections import Counter

import numpy as np
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from stratlab.llm import align as A
from stratlab.llm.queries import op13_token_alignment, tokenizer_path

PATHS = tokenizer_path(), tokenizer_path("piece_bpe_32k.model")
FIRST = Tokenizer.from_file(PATHS[0])
FIRST.encode_special_tokens = True
SECOND = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
BOTH = A.Aligner(*PATHS)
PIECES = st.lists(st.sampled_from(["a", "the", "'ll", " ", "  ", "\n", "\t", "\xa0", "é", "日本", "🙂", "12", "!?", "<|endoftext|>", "</s>", "<s>",
                                   "▁", "{\r", ";\r\n", "　", "ﬁ", "é", "\x00", "<0x41>"]), max_size=12)


def tokens(text):
    """Ids and bytes by the libraries, for each tokenizer; nothing where the bytes differ."""
    if not text:
        return ([], []), ([], [])
    a, b = FIRST.encode(" " + text, add_special_tokens=False).ids, SECOND.encode(text)
    bytes_a, bytes_b = [BOTH.bytes_a[i] for i in a], []
    for i in b:
        piece = SECOND.id_to_piece(i)
        bytes_b.append(bytes([int(piece[3:5], 16)]) if SECOND.is_byte(i) else piece.replace("▁", " ").encode())
    if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
        return ([], []), ([], [])
    return (a, bytes_a), (b, bytes_b)


def expected(docs):
    """All columns of the query by sets and counters."""
    texts, count, best = [], Counter(), Counter()
    for doc_id, text in docs:
        (a, bytes_a), (b, bytes_b) = tokens(text)
        at = {int(e): j for j, e in enumerate(np.cumsum([len(x) for x in bytes_b]))} if b else {}
        common = [(i, at[int(e)]) for i, e in enumerate(np.cumsum([len(x) for x in bytes_a])) if int(e) in at] if a else []
        texts.append((doc_id, a, b, common))
        count.update((a[i], b[j]) for i, j in common)
    for (_, y), n in count.items():
        best[y] = max(best[y], n)
    out = []
    for doc_id, a, b, common in texts:
        groups, i, j = [], 0, 0
        for x, y in common:
            groups.append(",".join(map(str, a[i:x + 1])) + "|" + ",".join(map(str, b[j:y + 1])))
            i, j = x + 1, y + 1
        pairs = [(a[x], b[y]) for x, y in common]
        out.append((doc_id, len(a), len(b), len(common), len(common), sum(count[p] == best[p[1]] for p in pairs),
                    sum(count[p] for p in pairs), hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""))
    return sorted(out, key=str)


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(0, 200)), st.sets(st.integers(0, 200)))
def test_common_ends(a, b):
    a, b = sorted(a), sorted(b)
    x, y = A.common_ends(a, b)
    assert [a[i] for i in x] == [b[j] for j in y] == sorted(set(a) & set(b))


def test_galloping_over_long_gaps():
    b = list(range(0, 100_000, 3))
    a = sorted(random.Random(1).sample(range(100_000), 60))
    x, y = A.common_ends(a, b)
    assert [a[i] for i in x] == [b[j] for j in y] == [e for e in a if e % 3 == 0]


@settings(max_examples=300, deadline=None)
@given(PIECES)
def test_ids_are_those_of_the_libraries(parts):
    text = "".join(parts)
    (a, b), = BOTH.ids([text])
    (want_a, _), (want_b, _) = tokens(text)
    assert (a.tolist(), b.tolist()) == (want_a, want_b)


def test_texts_that_do_not_come_back_have_no_tokens():
    assert [len(a) for a, _ in BOTH.ids(["", "▁x", "plain ▁ text", "fine"])][:3] == [0, 0, 0]


def test_registered_query_against_brute_force(spark):
    got = op13_token_alignment(spark, "/root/testdata/sf0.001").collect()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    assert sorted(map(tuple, got), key=str) == expected(docs)


def test_awkward_rows_in_many_blocks(awkward, nothing, monkeypatch):
    monkeypatch.setattr(A, "BLOCK_CHARS", 50)
    got = A.align_statistics(awkward, *PATHS).collect()
    assert sorted(map(tuple, got), key=str) == expected((r.doc_id, r.text) for r in awkward.collect())
    assert A.align_statistics(nothing, *PATHS).collect() == []


def test_groups_cover_both_sides(awkward):
    for r in A.align_tokens(awkward, *PATHS).collect():
        i = j = 0
        for g in r.groups:
            assert (g.a_from, g.b_from) == (i, j)
            i, j = g.a_to, g.b_to
            assert b"".join(BOTH.bytes_a[k] for k in r.a_ids[g.a_from:i]) == b"".join(BOTH.bytes_b[k] for k in r.b_ids[g.b_from:j])
        assert (i, j) == (len(r.a_ids), len(r.b_ids))


def test_links_of_a_block_are_numbered_in_little_memory(monkeypatch):
    rng = np.random.default_rng(5)
    keys = rng.integers(0, 5_000, 3_000_000) << 32
    tracemalloc.start()
    links = A.Links()
    for at in range(0, len(keys), 500):
        links.add(keys[at:at + 500])
    pairs, at, uses = links.take()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (pairs[at] == keys).all() and uses.sum() == len(keys)
    assert all((x == y).all() for x, y in zip((pairs, uses), np.unique(keys, return_counts=True)))
    assert peak < 15 * len(keys)  # sorting all keys at once takes more than 32 bytes a link
    none = links.take()
    assert [len(x) for x in none] == [0, 0, 0]
