"""Property tests (hypothesis) for the exact algorithms."""
import math

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from stratlab.operators import linkage1d as L
from stratlab.operators import quantile as Q
from stratlab.operators import sampling as S
from tests.test_linkage1d import naive_merges

values = st.lists(st.integers(min_value=-50, max_value=50).map(lambda v: v / 4.0), min_size=1, max_size=300)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(xs=values, exact_rows=st.integers(1, 40), buckets=st.integers(2, 9), data=st.data())
def test_order_statistics_equal_sorting(spark, xs, exact_rows, buckets, data):
    ranks = data.draw(st.lists(st.integers(0, len(xs) - 1), min_size=1, max_size=5))
    df = spark.createDataFrame([(v,) for v in xs], "x double")
    got = Q.order_statistics(df, {"x": ranks}, exact_rows=exact_rows, buckets=buckets)
    s = sorted(xs)
    assert all(got[("x", r)] == s[r] for r in ranks)


@settings(max_examples=200, deadline=None)
@given(sizes=st.lists(st.integers(0, 5000), min_size=1, max_size=12), f=st.floats(0.01, 0.99))
def test_allocation_properties(sizes, f):
    counts = [(i, n) for i, n in enumerate(sizes)]
    q = S.allocate(counts, f)
    total = sum(sizes)
    assert sum(q.values()) == math.floor(f * total)
    for s, n in counts:
        assert 0 <= q[s] <= n or total == 0
        if total:
            assert abs(q[s] - n * math.floor(f * total) / total) < 1 + 1e-9


@settings(max_examples=60, deadline=None)
@given(xs=st.lists(st.integers(0, 10_000), min_size=2, max_size=14, unique=True),
       linkage=st.sampled_from(["single", "complete", "average", "ward"]),
       seed=st.integers(0, 2**31))
def test_one_bucket_equals_naive_on_tie_free_data(xs, linkage, seed):
    # irrational-ish spacing keeps distances tie-free
    x = [v + math.sqrt(v + 2) for v in sorted(xs)]
    rng = np.random.default_rng(seed)
    left, merges = L.merge_bucket([(v, v, 1.0, v, str(rng.integers(10))) for v in x], None, None, linkage)
    assert len(left) == 1
    assert sorted((round(b, 9), round(h, 9)) for b, h in merges) == naive_merges(x, linkage)


@settings(max_examples=60, deadline=None)
@given(xs=st.lists(st.integers(0, 300), min_size=4, max_size=40, unique=True),
       linkage=st.sampled_from(["complete", "average", "ward"]), cut=st.integers(1, 39))
def test_buckets_only_merge_what_the_whole_would(xs, linkage, cut):
    iv = [(float(v), float(v), 1.0, float(v), str(v * 7919 % 97)) for v in sorted(xs)]
    cut = min(cut, len(iv) - 1)
    _, whole = L.merge_bucket(iv, None, None, linkage)
    a, b = iv[:cut], iv[cut:]
    left_a, ma = L.merge_bucket(a, None, b[0], linkage)
    left_b, mb = L.merge_bucket(b, a[-1], None, linkage)
    _, rest = L.merge_bucket(left_a + left_b, None, None, linkage)
    assert sorted(ma + mb + rest) == sorted(whole)


@settings(max_examples=300, deadline=None)
@given(p=st.integers(0, 10**9), j=st.integers(0, 9))
def test_inner_fold_formula(p, j):
    k = 10
    b, c = p % k, (p // k) % k
    if b == j:
        assert S.inner_fold_of_cell(b, c, j, k) is None
    else:
        before = sum(1 for q in range(p) if q % k == j) if p < 2000 else (p + k - 1 - j) // k
        assert S.inner_fold_of_cell(b, c, j, k) == (p - before) % k
