import base64
import hashlib
import random
import re
import string
from pydoc_data.topics import topics

import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st

from stratlab.llm import chat, rules

WORDS = st.lists(st.sampled_from("a b c".split()), max_size=60)


@settings(max_examples=200, deadline=None)
@given(WORDS)
def test_repeated_words_like_brute_force(words):
    windows = [tuple(words[k:k + 8]) for k in range(len(words) - 7)]
    marked = {p for k, w in enumerate(windows) if windows.count(w) > 1 for p in range(k, k + 8)}
    assert rules.repeated_words([w.encode() for w in words]) == len(marked)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab#|\n\t \x0b\xa0é", max_size=80))
def test_counts_like_brute_force(text):
    got = rules.measure(text, zstandard.ZstdCompressor(level=rules.LEVEL))
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    assert got[:4] == (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)))


def test_repetitive_and_random_texts_fall_out_and_prose_stays(spark):
    import random
    rng = random.Random(2)
    syllables = "th er on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de rt ve".split()
    prose = " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(900))
    noise = "".join(rng.choice("".join(map(chr, range(33, 0x2000)))) for _ in range(6000))
    noise = " ".join(noise[k:k + 9] for k in range(0, len(noise), 9))
    line = " ".join(rng.choice(syllables) for _ in range(7)) + f" {1}"
    loop = " ".join(f"{line} {k}" for k in range(400))
    df = spark.createDataFrame([(1, prose), (2, noise), (3, loop)], "doc_id long, text string")
    got = {r.doc_id: r for r in rules.compression_rules(df).collect()}
    assert got[1].kept and not got[3].kept
    assert got[2].ratio < got[1].ratio


def letters(rng, alphabet, size, width):
    return " ".join("".join(rng.choice(alphabet) for _ in range(rng.randint(width - 2, width + 2))) for _ in range(size // (width + 1)))


def test_encoded_and_random_texts_are_not_kept():
    rng, compressor = random.Random(5), zstandard.ZstdCompressor(level=rules.LEVEL)
    for size in (400, 1_000, 3_000, 6_000, 20_000, 80_000):
        coded = base64.b64encode(rng.randbytes(size)).decode()
        noise = [" ".join(coded[k:k + 12] for k in range(0, len(coded), 12)),
                 letters(rng, string.ascii_letters + string.digits, size, 8), letters(rng, string.ascii_letters, size, 8)]
        if size >= 1_000:
            noise += [letters(rng, string.ascii_lowercase + string.digits, size, 8)]
        if size >= 3_000:
            noise += [letters(rng, string.ascii_lowercase, size, 8)]
        for text in noise:
            assert not rules.measure(text, compressor)[5] and not rules.measure(text, compressor)[-1], (size, text[:40])


def test_english_prose_of_every_length_is_above_the_lower_limit():
    compressor, words = zstandard.ZstdCompressor(level=rules.LEVEL), " ".join(topics[k] for k in sorted(topics)).split()
    for size in (30, 60, 150, 300, 800, 3_000):
        for text in (" ".join(words[k:k + size]) for k in range(0, 30_000, 3_000)):
            assert rules.measure(text, compressor)[6] >= rules.lowest(len(text.encode())), (size, text[:40])


def test_the_last_part_chunk_counts():
    compressor, rng = zstandard.ZstdCompressor(level=rules.LEVEL), random.Random(6)
    words = " ".join(topics[k] for k in sorted(topics)).split()
    text = " ".join(w for w in words[:2_000] if w.isascii())[:rules.CHUNK_BYTES]
    tail = letters(rng, string.ascii_letters + string.digits, 3_500, 8)
    got = rules.measure(text + tail, compressor)
    assert got[-2] == len(tail) / len(text + tail) and not got[-1]
    assert rules.measure(text + text[:3_000], compressor)[-2] == 0


def test_rules_awkward_rows(awkward, nothing):
    rows = rules.compression_rules(awkward).collect()
    assert len(rows) == 11
    assert all(r.base_failed and not r.kept and r.n_words == 0 for r in rows if r.doc_id in (3, 4, 6))
    assert rules.compression_rules(nothing).count() == 0


TEXT = st.lists(st.sampled_from([*chat.CONTROL, "<", "[", "\\", "|", "x", "\n", "im_end|>", "/INST]", "<\\|im_end|>"]), max_size=10).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(TEXT | st.just("assistant"), TEXT), min_size=1, max_size=4))
def test_formatting_round_trip(turns):
    formatted, spans = chat.format_turns(turns)
    assert chat.read_turns(formatted) == turns
    loss = [chat.unescape(formatted[s["start"]:s["start"] + s["length"]]) for s in spans]
    assert loss == [t for r, t in turns if r == "assistant"]
    for _, text in turns:
        assert not any(c in chat.escape(text) for c in chat.CONTROL)


MESSAGES = "conv_id long, message_id long, parent_id long, score double, role string, text string"


def test_best_branches_in_order(spark):
    rows = [(1, 1, None, 1.0, "user", "q"), (1, 2, 1, 0.5, "assistant", "a"), (1, 3, 1, 0.9, "assistant", "b"),
            (1, 4, 2, 3.0, "user", "c"), (1, 5, 3, 0.1, "user", "d"), (1, 6, 99, 0.0, "user", "orphan"),
            (None, 1, None, None, None, None)]
    out = chat.format_conversations(spark.createDataFrame(rows, MESSAGES), branches=2).collect()
    paths = {(r.conv_id, r.branch, r.score): [t for _, t in chat.read_turns(r.formatted)] for r in out}
    assert paths == {(1, 1, 4.5): ["q", "a", "c"], (1, 2, 2.0): ["q", "b", "d"], (1, 1, 0.0): ["orphan"], (None, 1, 0.0): [""]}


def test_long_chains_and_repeated_rows(spark):
    rows = [(7, k, "user" if k % 2 == 0 else "assistant", f"t{k}") for k in range(70)] + [(8, 0, "user", "x")] * 2
    out = chat.digest_formatted(chat.format_conversations(chat.as_chain(
        spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")))).collect()
    got = {r.conv_id: r for r in out}
    said = "".join(f"{r}\n{t}\n" for _, _, r, t in rows[:70])
    assert got[7].n_turns == 70 and got[7].turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
    loss = "".join(t for _, _, r, t in rows[:70] if r == "assistant")
    assert (got[7].loss_sha256, got[7].loss_chars) == (hashlib.sha256(loss.encode()).hexdigest(), len(loss))
    assert got[8].n_turns == 2
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.format_conversations(chat.as_chain(empty)).count() == 0
