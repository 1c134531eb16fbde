import random

import numpy as np
import pytest

from stratlab.llm import permutation_index as P
from stratlab.llm.queries import op11_nearest_neighbours

SCHEMA = "vec_id bigint, embedding array<float>, label int, v string, ids string, block string, pivots string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "v", "i", "b", "p") for i, v in rows], SCHEMA)


def brute(rows, k=20, step=20):
    """Exact answers: {query: [(vec_id, score)]}."""
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float32).astype(float)
    out = {}
    for i, q in zip(ids, x):
        if i % step == 0:
            score = np.einsum("ij,j->i", x, q)
            order = [j for j in np.lexsort((ids, -score)) if ids[j] != i][:k]
            out[int(i)] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def answers(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        got = out.setdefault(r.query_id, [])
        assert r["rank"] == len(got) + 1
        got.append((r.vec_id, r.score))
    return out


def recall(got, want):
    assert got.keys() == want.keys() and all(len(got[q]) == len(want[q]) for q in want)
    return np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / max(1, len(want[q])) for q in want])


def test_footrule_is_that_of_the_definition():
    rng = np.random.default_rng(0)
    m, depth = 12, 5
    orders = np.stack([rng.permutation(m)[:depth] for _ in range(40)]).astype(np.uint16)
    place = P.positions(orders, m)
    for a in orders[:10]:
        want = []
        for b in orders:
            of_a, of_b = a.tolist(), b.tolist()
            rank = lambda o, p: o.index(p) if p in o else depth
            want.append(sum(abs(rank(of_a, p) - rank(of_b, p)) for p in range(m)))
        assert P.footrule(a, place).tolist() == want


def test_orders_follow_inner_products_for_any_norms():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(30, 4)) * rng.uniform(0.1, 5, size=(30, 1))
    pivots = P.Pivots(x[:9], float(np.linalg.norm(x, axis=1).max()))
    for q in x:
        assert pivots.orders(q[None], 9, query=True)[0].tolist() == np.argsort(-(x[:9] @ q), kind="stable").tolist()
    lifted = pivots.lift(x)
    assert np.allclose(np.linalg.norm(lifted, axis=1), 1)
    near = ((lifted[:, None] - lifted[None, :9]) ** 2).sum(2)
    assert (pivots.orders(x, 3) == np.argsort(near, axis=1, kind="stable")[:, :3]).all()


def test_a_list_beyond_a_block_is_dealt_and_others_share():
    sizes = np.array([10, 3 * P.BLOCK + 1, 20, P.BLOCK, 5])
    first, parts = P.place_lists(sizes, np.array([0, 1, 0, 2, 2]))
    assert parts.tolist() == [1, 4, 1, 1, 1]
    blocks = [set(range(f, f + p)) for f, p in zip(first, parts)]
    assert blocks[0] == blocks[2] and not blocks[1] & (blocks[0] | blocks[3] | blocks[4])


def test_registered_query_against_brute_force(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    want = brute([(r.vec_id, r.embedding) for r in df.collect()])
    got = answers(op11_nearest_neighbours(spark, "/root/testdata/sf0.01"))
    assert recall(got, want) >= 0.9
    exact = {q: dict(brute_rows) for q, brute_rows in want.items()}
    for q, rows in got.items():
        assert rows == sorted(rows, key=lambda r: (-r[1], r[0]))
        assert all(abs(exact[q][i] - s) < 1e-12 for i, s in rows if i in exact[q])


def test_clusters_of_other_norms_copies_and_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(P, "BLOCK", 64)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(8, 12)) * 3
    rows = [(i, (centres[i % 8] + rng.normal(size=12) * (0.2 + (i % 3))).tolist()) for i in range(900)]
    rows += [(1000 + i, rows[0][1]) for i in range(300)]  # a crowd of equal vectors
    rows += [(2000 + i, (np.array(rows[0][1]) + rng.normal(size=12) * 1e-3).tolist()) for i in range(300)]
    got, want = answers(P.search_neighbours(frame(spark, rows))), brute(rows)
    assert recall(got, want) >= 0.9
    # of the equal vectors the smallest ids come first, the query's own left out
    crowd = [i for i, _ in got[1020]]
    same = [i for i in crowd if i == 0 or 1000 <= i < 1300]
    assert same == sorted(same) and 1020 not in crowd


def test_awkward_vectors(spark):
    rng = random.Random(3)
    good = [(i, [rng.gauss(0, 1) for _ in range(3)]) for i in range(0, 30)]
    odd = [(40, None), (60, [0.0, 0.0, 0.0]), (80, [1.0, None, 0.0]), (100, [float("nan"), 0.0, 1.0]),
           (120, [float("inf"), 0.0, 1.0]), (140, []), (160, [1.0, 2.0]), (None, [1.0, 1.0, 1.0]), (None, None)]
    got = answers(P.search_neighbours(frame(spark, good + odd + good[:5])))
    want = brute(good)
    assert got.keys() == {0, 20}
    for q in got:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]


def test_fewer_candidates_than_asked(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [1.0, 0.0]), (20, [-1.0, 0.0])]
    got = answers(P.search_neighbours(frame(spark, rows)))
    assert got == {0: [(2, 1.0), (1, 0.5), (20, -1.0)], 20: [(1, -0.5), (0, -1.0), (2, -1.0)]}
    assert answers(P.search_neighbours(frame(spark, rows[:1]))) == {}


@pytest.mark.parametrize("rows", [[], [(1, None)], [(20, [0.0])]])
def test_nothing_to_search(spark, rows):
    assert P.search_neighbours(frame(spark, rows)).collect() == []
