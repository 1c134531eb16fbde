"""1-D linkage rounds and silhouette against brute force."""
import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratlab.operators import linkage1d as L


def naive_merges(x, linkage):
    """Plain agglomeration over point sets: returns sorted (boundary, height)."""
    clusters = [[v] for v in sorted(x)]

    def dist(a, b):
        if linkage == "single":
            return min(abs(p - q) for p in a for q in b)
        if linkage == "complete":
            return max(abs(p - q) for p in a for q in b)
        if linkage == "average":
            return sum(abs(p - q) for p in a for q in b) / (len(a) * len(b))
        na, nb = len(a), len(b)
        return np.sqrt(2.0 * na * nb / (na + nb)) * abs(np.mean(a) - np.mean(b))

    out = []
    while len(clusters) > 1:
        best = None
        for i, j in itertools.combinations(range(len(clusters)), 2):
            d = dist(clusters[i], clusters[j])
            if best is None or d < best[0]:
                best = (d, i, j)
        d, i, j = best
        a, b = clusters[i], clusters[j]
        left = a if max(a) < min(b) else b
        out.append((max(left), d))
        clusters[i] = a + b
        del clusters[j]
    return sorted((round(b, 9), round(h, 9)) for b, h in out)


def naive_silhouette(x, labels):
    x = np.asarray(x, float)
    labels = np.asarray(labels)
    s = np.zeros(len(x))
    for i in range(len(x)):
        own = labels == labels[i]
        if own.sum() <= 1:
            continue
        a = np.abs(x[own] - x[i]).sum() / (own.sum() - 1)
        b = min(np.abs(x[labels == c] - x[i]).mean() for c in set(labels) if c != labels[i])
        s[i] = (b - a) / max(a, b)
    return s.mean()


@pytest.mark.parametrize("linkage", ["complete", "average", "ward"])
def test_one_bucket_matches_brute_force(linkage):
    rng = np.random.default_rng(7)
    for _ in range(4):
        x = np.round(rng.lognormal(1.0, 0.7, 30), 6)
        x = np.unique(x)
        _, merges = L.merge_bucket([(v, v, 1.0, v, str(rng.integers(9))) for v in x.tolist()], None, None, linkage)
        got = sorted((round(b, 9), round(h, 9)) for b, h in merges)
        assert got == naive_merges(list(x), linkage)


def _events_like(spark, n=60, seed=3):
    rng = np.random.default_rng(seed)
    x = np.unique(np.round(rng.gamma(2.0, 3.0, n), 4))
    return spark.createDataFrame([(float(v),) for v in x], "v double"), x


@pytest.mark.parametrize("linkage", ["complete", "average", "ward"])
def test_any_number_of_buckets_gives_the_same(spark, linkage):
    df, x = _events_like(spark)
    d = L.distinct_weighted(df, "v")
    local = L.linkage_boundaries(d, linkage).toPandas()
    dist = L.linkage_boundaries(d, linkage, least_per_bucket=8, per_bucket=16).toPandas()
    key = lambda p: sorted((round(b, 9), round(h, 9)) for b, h in zip(p.boundary, p.height))
    assert key(dist) == key(local) == naive_merges(list(x), linkage)


def test_single_linkage_is_gaps(spark):
    df, x = _events_like(spark, 40)
    d = L.distinct_weighted(df, "v")
    got = L.linkage_boundaries(d, "single").toPandas()
    key = sorted((round(b, 9), round(h, 9)) for b, h in zip(got.boundary, got.height))
    assert key == naive_merges(list(x), "single")


def test_silhouette_matches_brute_force_with_duplicates(spark):
    rng = np.random.default_rng(11)
    x = np.round(rng.normal(10, 4, 80), 1)          # ties: weighted distinct values
    df = spark.createDataFrame([(float(v),) for v in x], "v double")
    d = L.distinct_weighted(df, "v")
    settings = {}
    for k in (2, 3, 5):
        top = L.top_boundaries(L.linkage_boundaries(d, "ward"), 10)
        settings[("ward", k)] = L.cuts_for(top, k)
    got = {r["k"]: r["silhouette"] for r in L.silhouette_scores(d, settings).collect()}
    for (_, k), cuts in settings.items():
        labels = [1 + sum(c < v for c in cuts) for v in x]
        assert got[k] == pytest.approx(naive_silhouette(x, labels), abs=1e-9)


def test_labels_are_intervals_and_cut_rule(spark):
    df, x = _events_like(spark, 50)
    d = L.distinct_weighted(df, "v")
    top = L.top_boundaries(L.linkage_boundaries(d, "average"))
    for k in L.CLUSTER_COUNTS:
        cuts = L.cuts_for(top, k)
        assert len(cuts) <= k - 1
        lab = df.select("v", L.label_expr("v", cuts).alias("c")).orderBy("v").toPandas()
        assert lab["c"].is_monotonic_increasing
        assert lab["c"].nunique() == len(cuts) + 1


def test_best_setting_first_wins(spark):
    scores = spark.createDataFrame(
        [("ward", 3, 0.7, 3), ("single", 4, 0.7, 4), ("single", 2, 0.7, 2), ("average", 2, 0.5, 2)],
        "linkage string, k int, silhouette double, clusters int")
    b = L.best_setting(scores).collect()[0]
    assert (b["linkage"], b["k"]) == ("single", 2)


def test_growing_gaps_need_few_rounds(spark, monkeypatch):
    """2000 squares: each merge waits for the one left of it; rounds follow the buckets, not the values."""
    rounds = []
    one = L._round
    monkeypatch.setattr(L, "_round", lambda iv, width, shift: rounds.append(width["complete"]) or one(iv, width, shift))
    d = L.distinct_weighted(spark.createDataFrame([(float(i * i),) for i in range(2000)], "x double"), "x")
    out = L.linkage_boundaries(d, "complete")
    assert out.count() == 1999
    buckets = spark.sparkContext.defaultParallelism
    assert rounds[0] == L.SLOTS and len(rounds) <= 6 * buckets


def test_study_of_no_values(spark):
    scores, best, _ = L.cluster_study(spark.createDataFrame([], "x double"), "x")
    assert scores.count() == 0 and best[2] == []


@pytest.mark.parametrize("linkages", [["single", "complete", "average", "ward"], ["ward", "average"]])
def test_linkages_together_are_those_alone(spark, linkages):
    df, x = _events_like(spark, 90, 5)
    d = L.distinct_weighted(df, "v")
    got = L.all_boundaries(d, linkages, least_per_bucket=6, per_bucket=12).toPandas()
    for linkage in linkages:
        mine = got[got.linkage == linkage]
        assert sorted((round(b, 9), round(h, 9)) for b, h in zip(mine.boundary, mine.height)) == naive_merges(list(x), linkage)
    top = L.top_boundaries_by_linkage(L.all_boundaries(d, linkages), 4)
    assert top == {l: L.top_boundaries(L.linkage_boundaries(d, l), 4) for l in linkages}
