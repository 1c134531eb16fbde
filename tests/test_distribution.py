"""Chart data against NumPy definitions."""
import math

import numpy as np
import pytest

from stratlab.operators import distribution as V
from stratlab.operators import ordered as O


def _frame(spark, xs, name="x"):
    return spark.createDataFrame([(float(v),) for v in xs], f"{name} double")


@pytest.mark.parametrize("seed", [0, 1])
def test_auto_histogram_matches_numpy(spark, seed):
    rng = np.random.default_rng(seed)
    xs = np.round(rng.gamma(2, 10, 3000), 2)
    h = V.histogram(_frame(spark, xs), ["x"]).orderBy("bin").toPandas()
    counts, edges = np.histogram(xs, bins="auto")
    assert len(h) == len(counts)
    assert h["n"].tolist() == counts.tolist()
    assert np.allclose(h["bin_lo"], edges[:-1])


def test_fixed_histogram_by_label(spark):
    rng = np.random.default_rng(3)
    xs = rng.normal(0, 1, 500)
    labels = (xs > 0.5).astype(int)
    df = spark.createDataFrame([(float(v), int(l)) for v, l in zip(xs, labels)], "x double, g int")
    h = V.histogram(df, ["x"], bins=30, by="g").toPandas()
    edges = np.histogram_bin_edges(xs, 30)
    for g in (0, 1):
        want, _ = np.histogram(xs[labels == g], edges)
        got = h[h.g == g].sort_values("bin")["n"].tolist()
        assert got == want.tolist()


def test_kde_matches_direct_sum(spark):
    rng = np.random.default_rng(4)
    xs = np.round(rng.lognormal(1, 0.5, 400), 1)      # duplicates: weighted path
    k = V.kde_curve(_frame(spark, xs), "x").orderBy("i").toPandas()
    n, sd = len(xs), xs.std(ddof=1)
    bw = sd * n ** -0.2
    grid = np.linspace(xs.min(), xs.max(), 200)
    dens = np.exp(-0.5 * ((grid[:, None] - xs[None, :]) / bw) ** 2).sum(1) / (n * bw * math.sqrt(2 * math.pi))
    assert np.allclose(k["x"], grid) and np.allclose(k["density"], dens, rtol=1e-9)


def test_box_summary_matches_definition(spark):
    rng = np.random.default_rng(6)
    xs = np.concatenate([rng.normal(10, 2, 300), [40.0, -20.0]])
    b = V.box_summary(_frame(spark, xs), ["x"]).collect()[0]
    q1, med, q3 = np.percentile(xs, [25, 50, 75])
    iqr = q3 - q1
    lo, hi = xs[xs >= q1 - 1.5 * iqr].min(), xs[xs <= q3 + 1.5 * iqr].max()
    assert (b.q1, b.median, b.q3) == pytest.approx((q1, med, q3))
    assert (b.whisker_lo, b.whisker_hi) == (lo, hi)
    assert b.fliers == int(((xs < lo) | (xs > hi)).sum())


def test_ecdf_and_running_sum(spark):
    rng = np.random.default_rng(8)
    xs = np.round(rng.exponential(5, 2000), 1)
    e = V.ecdf(_frame(spark, xs), "x").orderBy("value").toPandas()
    vals, cnt = np.unique(xs, return_counts=True)
    assert e["value"].tolist() == vals.tolist()
    assert e["cum_n"].tolist() == np.cumsum(cnt).tolist()
    assert e["ecdf"].iloc[-1] == 1.0


def test_neighbours_across_buckets(spark):
    xs = np.unique(np.random.default_rng(9).uniform(0, 100, 500))
    df = _frame(spark, xs, "v")
    got = O.with_neighbours(df, "v", buckets=16).orderBy("v").toPandas()
    assert got["prev_value"].tolist()[1:] == xs[:-1].tolist()
    assert got["next_value"].tolist()[:-1] == xs[1:].tolist()


def test_two_level_scans_over_buckets(spark, monkeypatch):
    monkeypatch.setattr(O, "SUPER", 4)
    rng = np.random.default_rng(10)
    xs = rng.permutation(600).astype(float)
    df = spark.createDataFrame([(float(x), int(x) % 7, int(x) % 3) for x in xs], "x double, w long, u long")
    got = O.running_sum(df, "x", ["w", "u"], ["cw", "cu"], buckets=23).orderBy("x").toPandas()
    assert got["cw"].tolist() == np.cumsum(np.arange(600) % 7).tolist() and got["cu"].tolist() == np.cumsum(np.arange(600) % 3).tolist()
    near = O.with_neighbours(df.select("x"), "x", buckets=23).orderBy("x").toPandas()
    assert near["prev_value"].tolist()[1:] == list(range(599)) and near["next_value"].tolist()[:-1] == list(range(1, 600))
    assert O.running_sum(df.limit(0), "x", "w").count() == 0


def test_correlation_constant_column_is_null(spark):
    df = spark.createDataFrame([(float(i), 1.0, float(2 * i)) for i in range(10)], "a double, k double, b double")
    rows = {(r.column_a, r.column_b): r.r for r in V.correlation_long(df, ["a", "k", "b"]).collect()}
    assert rows[("k", "a")] is None and rows[("b", "a")] == pytest.approx(1.0)
    assert set(rows) == {("k", "a"), ("b", "a"), ("b", "k")}


def test_kde_reach_skips_only_zero_terms(spark):
    rng = np.random.default_rng(14)
    xs = np.concatenate([rng.normal(0, 1, 400), [1.0e6, 2.0e6]])
    k = V.kde_curve(_frame(spark, xs), "x").orderBy("i").toPandas()
    n, sd = len(xs), xs.std(ddof=1)
    bw = sd * n ** -0.2
    assert 40 * bw < xs.max() - xs.min()          # the reach really skips grid points
    grid = np.linspace(xs.min(), xs.max(), 200)
    dens = np.exp(-0.5 * ((grid[:, None] - xs[None, :]) / bw) ** 2).sum(1) / (n * bw * math.sqrt(2 * math.pi))
    assert np.allclose(k["density"], dens, rtol=1e-12, atol=0)
