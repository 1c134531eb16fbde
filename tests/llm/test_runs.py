import hashlib
import random
import re
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from stratlab.llm import runs as R
from stratlab.llm.queries import op12_periodic_runs


def brute(x):
    """Every stretch that agrees with itself q words on, by the definition; the smallest q of equal stretches."""
    out = {}
    for q in range(1, len(x) // 4 + 1):
        i = 0
        while i + q < len(x):
            j = i
            while j + q < len(x) and x[j] == x[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q) and j > i:
                out.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in out.items())


def planted(rng, size):
    x = [rng.randrange(rng.choice([1, 2, 3, 40])) for _ in range(rng.randrange(size))]
    while x and rng.random() < 0.7:
        a, p = rng.randrange(len(x)), 1 + rng.randrange(max(1, len(x) // 4))
        for i in range(a, min(len(x), a + p * rng.randrange(3, 9) + rng.randrange(p))):
            x[i] = x[a + (i - a) % p]
    return x


def test_transform_gives_exact_sums():
    rng = np.random.default_rng(0)
    for block, window in ((1, 2), (2, 3), (8, 13), (64, 90), (2048, 4000)):
        top = int(((R.PRIME - 1) / block) ** 0.5)
        a, b = rng.integers(0, top + 1, (block, 3)), rng.integers(0, top + 1, (window, 3))
        want = [[int(((a[:, c] - b[s:s + block, c]) ** 2).sum()) for c in range(3)] for s in range(window - block + 1)]
        assert R.squared_differences(a, b).tolist() == want


def test_scales_cover_every_period_once():
    covered = [q for _, _, least, greatest in R.scales(10_000) for q in range(least, greatest + 1)]
    assert covered[:2500] == list(range(1, 2501))
    for stride, _, least, _ in R.scales(10_000):
        assert 2 * stride - 1 + least <= max(R.LEAST_WORDS, R.LEAST_PERIODS * least)


def test_runs_like_brute_force():
    rng = random.Random(5)
    for _ in range(250):
        texts = [planted(rng, 300) for _ in range(rng.randrange(1, 5))]
        assert R.runs_of_texts(texts) == [brute(t) for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from("ab"), max_size=60))
def test_runs_of_two_words_like_brute_force(x):
    assert R.runs_of_texts([x]) == [brute(x)]


def test_blocks_cut_at_the_longest(monkeypatch):
    monkeypatch.setattr(R, "LONGEST_BLOCK", 8)
    monkeypatch.setattr(R, "CHUNK", 64)
    rng = random.Random(6)
    for _ in range(60):
        x = planted(rng, 400)
        assert R.runs_of_texts([x]) == [brute(x)]


def test_long_periods():
    rng = random.Random(7)
    part = [rng.randrange(500) for _ in range(9_000)]
    assert R.runs_of_texts([[-5] + 4 * part + part[:17] + [-6]]) == [[(1, 36_017, 9_000)]]
    assert R.runs_of_texts([["a"] * 200_000]) == [[(0, 200_000, 1)]]


def expected(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[a + (i - a) % p] if i >= a else w for i, w in enumerate(words)]
    found = brute(words)
    dropped = {i for s, n, q in found for i in range(s + q, s + n)}
    top = sorted(found, key=lambda r: (-r[1], r[0], r[2]))[:1]
    s, n, q = top[0] if top else (None,) * 3
    return (doc_id, len(found), s, n, q, 1000 * n // q if top else None,
            hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in found).encode()).hexdigest(),
            hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in dropped).encode()).hexdigest())


def ordered(rows):
    return sorted(rows, key=str)


def test_registered_query_against_brute_force(spark):
    got = op12_periodic_runs(spark, "/root/testdata/sf0.001").collect()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    assert ordered(map(tuple, got)) == ordered(expected(r.doc_id, r.text) for r in docs)
    assert sum(r.n_runs > 0 for r in got) >= 5


def test_awkward_rows(awkward, nothing):
    got = R.run_digests(awkward, R.repeat_tail).drop("n_words").collect()
    assert ordered(map(tuple, got)) == ordered(expected(r.doc_id, r.text) for r in awkward.collect())
    assert R.run_digests(nothing, R.repeat_tail).collect() == [] == R.periodic_runs(nothing).collect()


def test_words_and_runs_as_rows(spark):
    docs = spark.createDataFrame([(1, "x " + "a b\t" * 4 + "a y"), (2, None), (3, " \x0b\n")], "doc_id int, text string")
    got = {r.doc_id: r for r in R.periodic_runs(docs).collect()}
    assert [tuple(x) for x in got[1].runs] == [(1, 9, 2)] and got[1].words[:3] == ["x", "a", "b"]
    assert got[2].words == got[3].words == got[2].runs == []
