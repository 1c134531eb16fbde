import random
from itertools import combinations

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stratlab.llm.common import Scratch
from stratlab.llm.components import components
from stratlab.llm import decontam, neardup
from stratlab.llm.shingles import WordHashes, probability_jaccard, shingle_hashes, weighted, words_of

HASHES = WordHashes()


def bag(text):
    return weighted(shingle_hashes(HASHES.of(words_of(text))))


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(0, 8), st.integers(1, 5)), st.dictionaries(st.integers(0, 8), st.integers(1, 5)))
def test_probability_jaccard_like_its_definition(x, y):
    want = sum(1 / sum(max(x.get(j, 0) / x[i], y.get(j, 0) / y[i]) for j in x.keys() | y.keys()) for i in x.keys() & y.keys())
    arrays = [(np.array(sorted(d), np.uint64), np.array([d[k] for k in sorted(d)], int)) for d in (x, y)]
    assert abs(probability_jaccard(*arrays) - want) < 1e-9


def test_registers_agree_with_probability_jaccard():
    r = np.random.default_rng(4)
    keys = r.integers(1, 2**62, 300, dtype=np.uint64)
    a = (np.sort(keys[:220]), r.integers(1, 6, 220))
    b = (np.sort(keys[60:]), r.integers(1, 6, 240))
    m = 4096
    sig = neardup.registers([a, b, (keys[:0], np.zeros(0, int))], m)
    assert abs((sig[0] == sig[1]).mean() - probability_jaccard(a, b)) < 4 * np.sqrt(0.25 / m)
    assert not sig[2].any()


def vocabulary(n, seed):
    rng = random.Random(seed)
    return [f"w{rng.randint(0, 5000)}" for _ in range(n)]


def classes_by_force(texts):
    bags = [bag(t) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, j in combinations(range(len(texts)), 2):
        if (texts[i] or "") == (texts[j] or "") or probability_jaccard(bags[i], bags[j]) >= 0.8:
            root[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(texts))]


def test_classes_like_brute_force(spark):
    """Copies, a base with many variants that are near to it but not to each other, and a chain."""
    rng, texts = random.Random(8), []
    for s in range(12):
        texts += [" ".join(vocabulary(90, s))] * (1 + s % 3)
    base = vocabulary(200, 99)
    for _ in range(25):
        v = base[:]
        for k in rng.sample(range(200), 3):
            v[k] = "changed" + str(rng.random())
        texts.append(" ".join(v))
    chain = vocabulary(150, 55)
    for k in range(20):
        texts.append(" ".join(chain[6 * k:]) + " " + " ".join(vocabulary(6 * k, 1000 + k)))
    texts += ["", None, "two words", "two words", "two  WORDS"]
    order = list(range(len(texts)))
    rng.shuffle(order)
    texts = [texts[i] for i in order]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in neardup.near_duplicates(df).collect()}
    want = classes_by_force(texts)
    assert [got[i].class_id for i in range(len(texts))] == want
    for i in range(len(texts)):
        assert got[i].class_size == want.count(want[i])
        assert (got[i].text_rank == 1) == (want[i] == i)


def test_many_texts_not_quite_near(spark, monkeypatch):
    """Texts of one base around similarity 0.57, some copies of them near: the prefixes lose no link and make few pairs."""
    rng, base, texts = random.Random(12), vocabulary(100, 7), []
    for _ in range(140):
        v = base[:]
        for k in rng.sample(range(100), 3):
            v[k] = "own" + str(rng.random())
        texts.append(" ".join(v))
    for t in texts[:25]:
        v = t.split()
        v[rng.randrange(100)] = "one" + str(rng.random())
        texts.append(" ".join(v))
    rng.shuffle(texts)
    pairs = []
    verify = neardup.verify
    monkeypatch.setattr(neardup, "verify", lambda p, *rest: pairs.append(p.count()) or verify(p, *rest))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.class_id for r in neardup.near_duplicates(df).collect()}
    assert [got[i] for i in range(len(texts))] == classes_by_force(texts)
    assert len(pairs) > 1 and sum(pairs[1:]) < 4_000   # of 13,530; most that the sketches let pass share no rare shingle


def test_near_duplicates_awkward_rows(awkward, nothing):
    rows = neardup.near_duplicates(awkward).collect()
    assert len(rows) == 11
    by_id = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert by_id[1].class_id == by_id[2].class_id == 1 and by_id[1].class_size == 4
    assert by_id[3].class_id == by_id[4].class_id == 3 and by_id[6].class_id == 6
    assert neardup.near_duplicates(nothing).count() == 0


def leaks(spark, texts, items):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    return {(r.doc_id, x.item_id): x for r in decontam.find_leaks(docs, bench).collect() for x in r.leaks}


def test_leaks_like_brute_force(spark):
    rng = random.Random(3)
    items = [(k, " ".join(vocabulary(rng.choice([3, 8, 20, 40, 55]), 300 + k))) for k in range(30)]
    texts = []
    for k in range(60):
        words = vocabulary(rng.choice([2, 30, 200]), 700 + k)
        item = items[k % 30][1].split()
        if k % 3 == 0:
            words[1:1] = item
        elif k % 3 == 1:
            item[0] = "edited"
            words = item + words
        texts.append(" ".join(words))
    texts += [None, "", items[4][1].upper().replace(" ", ",\n")]
    got = leaks(spark, texts, [*items, (100, None), (101, "")])
    index = decontam.ItemIndex(items)
    force = set()
    for d, text in enumerate(texts):
        h = HASHES.of(decontam.words_of(text))
        for k, size in enumerate(index.sizes.tolist()):
            width = min(size, len(h))
            for s in range(len(h) - width + 1 if width else 0):
                window = weighted(shingle_hashes(h[s:s + width]))
                print_ = decontam.window_fingerprints(h[s:s + width], np.array([0]), width)[0]
                if decontam.weighted_similarity(window, index.shingles[k]) >= 0.8 and int(print_ ^ index.prints[k]).bit_count() <= decontam.RADIUS:
                    force.add((d, index.ids[k]))
    assert set(got) == force and len(force) >= 30 and (62, 4) in force


def test_the_index_finds_every_fingerprint_within_the_radius():
    r = np.random.default_rng(1)
    index = decontam.ItemIndex([(k, f"alpha{k} beta{k} gamma{k} delta{k} eps{k} zeta{k}") for k in range(50)])
    prints = []
    for p in index.prints:
        for bits in (0, 5, 11, 12):
            x = int(p)
            for b in r.choice(64, bits, replace=False):
                x ^= 1 << int(b)
            prints.append(x)
    prints = np.array(prints, dtype=np.uint64)
    got = set(zip(*[a.tolist() for a in index.near(prints, 6)]))
    want = {(i, j) for i, p in enumerate(prints) for j, q in enumerate(index.prints) if int(p ^ q).bit_count() <= decontam.RADIUS}
    assert got == want


def test_items_with_a_replaced_end_are_found_by_similarity_alone():
    """Against the 0.8 check without any fingerprint."""
    rng, found, leaks_ = random.Random(21), 0, 0
    for k in range(600):
        words = vocabulary(rng.randint(15, 59), 5_000 + k)
        index = decontam.ItemIndex([(k, " ".join(words))])
        best = None
        for m in range(1, len(words)):
            edited = words[:-m] + [f"other{k}x{i}" for i in range(m)]
            sim = decontam.weighted_similarity(weighted(shingle_hashes(HASHES.of(edited))), index.shingles[0])
            if sim < 0.8:
                break
            best = edited
        if best:
            leaks_ += 1
            found += bool(index.matches(" ".join(best)))
    assert leaks_ > 400 and found >= 0.99 * leaks_, (found, leaks_)


def test_items_come_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(decontam, "ITEM_BLOCK_WORDS", 30)
    items = [(k, " ".join(vocabulary(20, k))) for k in range(5)]
    assert set(leaks(spark, [t for _, t in items], items)) == {(k, k) for k in range(5)}


def test_leaks_awkward_rows(spark, awkward, nothing):
    bench = spark.createDataFrame([(1, "term1 term2 term3 term4 term5 term6"), (2, None)], "item_id long, text string")
    rows = decontam.find_leaks(awkward, bench).collect()
    assert len(rows) == 11 and {r.doc_id for r in rows if r.leaks} == {1, 2, None}
    assert decontam.find_leaks(nothing, bench).count() == 0
    assert all(r.leaks == [] for r in decontam.find_leaks(awkward, bench.limit(0)).collect())


def test_odd_bits_reject_no_pair_that_is_near(spark):
    """Texts at all similarities, with shingles that occur once or often: a near pair passes, most just below do not."""
    rng, texts = random.Random(3), []
    for k in range(8):
        base = vocabulary(rng.randrange(30, 200), k) if k % 2 else (vocabulary(12, k) * 9)[:100]
        for _ in range(9):
            v = base[:len(base) - rng.randrange(12)]
            for _ in range(rng.randrange(5)):
                v[rng.randrange(len(v))] = "own" + str(rng.random())
            texts.append(" ".join(v))
    bags = [bag(t) for t in texts]
    df = neardup.odd_sketches(spark.createDataFrame(list(enumerate(texts)), "rid long, text string"))
    passed = {(r.x, r.y) for r in df.alias("a").join(df.alias("b"), F.col("a.rid") < F.col("b.rid"))
              .where(neardup.few_differences("a", "b", 0.8)).select(F.col("a.rid").alias("x"), F.col("b.rid").alias("y")).collect()}
    similar = {(i, j): probability_jaccard(bags[i], bags[j]) for i, j in combinations(range(len(texts)), 2)}
    near = {p for p, s in similar.items() if s >= 0.8}
    assert len(near) > 30 and near <= passed
    plain = [p for p, s in similar.items() if s < 0.7 and all(bags[k][1].max() == 1 for k in p)]
    assert len(plain) > 100 and sum(p in passed for p in plain) < len(plain) / 50


def test_later_rounds_make_few_pairs_of_texts_below_the_limit(spark, monkeypatch):
    """A hundred texts around similarity 0.7 to each other, none near: the join of later rounds makes next to no pairs."""
    rng, base, texts = random.Random(21), vocabulary(120, 4), []
    for k in range(100):
        v = base[:]
        for at in (7, 60, 100)[:2 + k % 2]:
            v[at + rng.randrange(9)] = f"own{k}"
        texts.append(" ".join(v))
    pairs, verify = [], neardup.verify
    monkeypatch.setattr(neardup, "verify", lambda p, *rest: pairs.append(p.count()) or verify(p, *rest))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.class_id for r in neardup.near_duplicates(df).collect()}
    want = classes_by_force(texts)
    assert [got[i] for i in range(len(texts))] == want
    print(pairs, len(set(want)))
    assert len(pairs) > 1 and sum(pairs[1:]) < 400


def test_a_pair_makes_one_row_and_few_rounds_do(spark, monkeypatch):
    """Six hundred texts around similarity 0.85: however many bands two texts share, they are one row of the join (its rows grow with
    the bands else), and the buckets are through after three rounds."""
    rng, base, texts = random.Random(8), vocabulary(120, 4), []
    for k in range(600):
        v = base[:]
        v[rng.randrange(len(v))] = f"own{k}"
        if k % 3 == 0:
            v = v[:60] + [f"odd{k}{i}" for i in range(2)] + v[62:]
        texts.append(" ".join(v))
    rounds, verify = [], neardup.verify

    def watched(pairs, *rest):
        plan = pairs._jdf.queryExecution().optimizedPlan().toString()
        rounds.append(("Aggregate" in plan, pairs.count(), pairs.select("x", "y").distinct().count()))
        return verify(pairs, *rest)

    monkeypatch.setattr(neardup, "verify", watched)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.class_id for r in neardup.near_duplicates(df).collect()}
    assert [got[i] for i in range(len(texts))] == classes_by_force(texts)
    assert sum(n for _, n, _ in rounds) > 500 and len(rounds) <= 3
    assert all(not combined and n == pairs for combined, n, pairs in rounds)


def test_small_tables_of_components_are_few_files(spark):
    """A table of edges over many partitions is not written as one file a partition."""
    scratch = Scratch(spark, "components")
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 400, 2)], "a long, b long")
    found = scratch.write_narrow(edges.repartition(200, "a"), "edges")
    assert len(found.inputFiles()) <= 2 * spark.sparkContext.defaultParallelism
    got = {r.node: r.comp for r in components(found, scratch).collect()}
    assert got == {i: i - i % 2 for i in range(400)}
