"""The nested tree search against MLlib fits and against a plain recursive tree."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratlab.operators import features as FE
from stratlab.operators import models as M
from stratlab.operators import results as R
from stratlab.operators import sampling as S
from stratlab.operators import trees as T
from stratlab.plans import model_study as MS
from stratlab.plans import queries as Q


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(3)
    n = 1200
    x1, x2, g = rng.integers(0, 12, n), rng.integers(0, 9, n), rng.integers(0, 2, n)
    y = np.where(x1 > 6, 40.0, 5.0) + np.where((x2 > 3) & (g == 1), 17.0, 0.0) + 3 * (x1 % 3) + rng.normal(0, 2, n)
    rows = [(str(i), int(i % 2), float(a), float(b), float(c), float(d)) for i, (a, b, c, d) in enumerate(zip(x1, x2, g, y))]
    df = spark.createDataFrame(rows, "row_key string, stratum int, x1 double, x2 double, g double, y double")
    return S.stratified_folds(df, ["row_key"], "stratum", k=4, inner="inner", position="p").checkpoint()


FEATURES = ["x1", "x2", "g"]


def recursive(x, y, leaf, depth):
    """Predictions of a greedy tree as a function."""
    best = (1e-9 * max(1.0, (y ** 2).sum()), None, None)
    if depth:
        for f in range(x.shape[1]):
            for cut in np.unique(x[:, f])[:-1]:
                left = x[:, f] <= cut
                if min(left.sum(), (~left).sum()) >= leaf:
                    gain = (y[left].sum() ** 2 / left.sum() + y[~left].sum() ** 2 / (~left).sum() - y.sum() ** 2 / len(y))
                    if gain > best[0] * (1 + 1e-9):
                        best = (gain, f, cut)
    if best[1] is None:
        return lambda q: np.full(len(q), y.mean())
    _, f, cut = best
    left = x[:, f] <= cut
    a, b = recursive(x[left], y[left], leaf, depth - 1), recursive(x[~left], y[~left], leaf, depth - 1)
    return lambda q: np.where(q[:, f] <= cut, a(q), b(q))


def test_one_growth_answers_for_every_depth(table):
    rows = table.select(*FEATURES, "y").toPandas()
    x, y = rows[FEATURES].to_numpy(), rows["y"].to_numpy()
    train = np.arange(len(y)) % 3 > 0
    sums = np.stack([train, train * y, ~train, ~train * y, ~train * y * y], axis=1).astype(float)
    for leaf in (1, 5, 40):
        got = {d: sse for d, sse, *_ in T.grow(x.astype(np.int64), sums, leaf, 0, [0, 1, 3, 7, 30], 1e-6)}
        for d, sse in got.items():
            want = recursive(x[train], y[train], leaf, d)(x[~train])
            assert sse == pytest.approx(((y[~train] - want) ** 2).sum(), rel=1e-9)


def test_search_equals_separate_mllib_fits(spark, table):
    # leaves large enough that no two splits of a node are equally good: MLlib breaks such ties by rounding
    grid = {"maxDepth": [2, 3, 5], "minInstancesPerNode": [10, 25]}
    want, per_fold, cands = M.nested_cv(table, FEATURES, "y", "fold", "inner", kind="tree", grid=grid, parallelism=2)
    got, scores, folds, own_cands, nodes = T.nested_tree_search(table, FEATURES, "y", "p", grid["maxDepth"], grid["minInstancesPerNode"], k=4)
    assert [{n: str(v) for n, v in c.items()} for c in own_cands] == cands
    mean = {(r.outer_fold, r.candidate_idx): r.mean_r2 for r in scores.collect()}
    for p, own in zip(per_fold, folds):
        assert own["fold"] == p["fold"] and own["best_params"] == p["best_params"]
        assert [mean[p["fold"], i] for i in range(6)] == pytest.approx(p["avg_metrics"], abs=1e-9)
        assert own["importances"] == pytest.approx(p["importances"], abs=1e-9)
    a = {r.row_key: r.prediction for r in want.select("row_key", "prediction").collect()}
    b = {r.row_key: r.prediction for r in got.select("row_key", "prediction").collect()}
    assert a.keys() == b.keys() and all(a[k] == pytest.approx(b[k], abs=1e-9) for k in a)
    # every node but the root of a refitted tree has a sibling, and they share the parent's rows
    sizes = {(r.outer, r.node): r.n for r in nodes.collect()}
    for (o, p), n in sizes.items():
        assert p == 1 or sizes[o, p // 2] == sizes[o, p] + sizes[o, p ^ 1]


def test_nodes_split_over_the_cluster_or_in_a_task_are_the_same(table):
    bins = T.with_bins(table, T.bin_cuts(table, FEATURES))
    fits = T.fit_vectors(bins, "y", "p", 4, 3).checkpoint()
    key = lambda r: (r.outer, r.inner, r.leaf, r.depth)
    depths, leaves = [0, 1, 3, 6], [1, 30]
    one = {key(r): r for r in T.search_levels(fits, leaves, depths, 3).collect()}
    for bound in (40, 0):
        other = {key(r): r for r in T.search_levels(fits, leaves, depths, 3, bound=bound).collect()}
        assert one.keys() == other.keys() and len(one) == 4 * 5 * 8
        for k, r in one.items():
            assert r.r2 == pytest.approx(other[k].r2, abs=1e-9)
            assert list(r.gains) == pytest.approx(list(other[k].gains), rel=1e-7, abs=1e-3)


def test_cuts_and_bins(spark):
    ulp = np.nextafter(1.0, 2.0)
    df = spark.createDataFrame([(1.0, 5.0, float(i)) for i in range(600)] + [(float(ulp), 5.0, 3.5)], "a double, b double, c double")
    cuts = T.bin_cuts(df, ["a", "b", "c"], max_bins=16)
    assert cuts["a"] == [1.0] and cuts["b"] == [] and len(cuts["c"]) <= 15
    rows = T.with_bins(df, cuts).collect()
    assert {r.bin0 for r in rows if r.a == 1.0} == {0} and {r.bin0 for r in rows if r.a > 1.0} == {1}
    assert all(r.bin2 == sum(x < r.c for x in cuts["c"]) for r in rows)


def test_constant_target_and_one_fold_row(spark):
    df = spark.createDataFrame([(str(i), 1, float(i % 3), 7.0) for i in range(12)], "row_key string, stratum int, x double, y double")
    f = S.stratified_folds(df, ["row_key"], "stratum", k=3, position="p")
    rows, scores, folds, _, _ = T.nested_tree_search(f, ["x"], "y", "p", [30, 2], [1], k=3)
    assert {r.prediction for r in rows.collect()} == {7.0}
    assert {r.mean_r2 for r in scores.collect()} == {None}
    assert [p["best_idx"] for p in folds] == [0, 0, 0] and all(p["importances"] == [0.0] for p in folds)


def test_best_parameters_by_name(spark):
    scores = spark.createDataFrame([("d", "tree", 0, 0, 0.1), ("d", "tree", 0, 1, 0.3), ("d", "tree", 1, 0, 0.2), ("d", "tree", 1, 1, 0.1)],
                                   "dataset string, model string, outer_fold int, candidate_idx int, mean_r2 double")
    names = spark.createDataFrame([("tree", 0, "maxDepth", "3"), ("tree", 1, "maxDepth", "5"), ("tree", 1, "minInstancesPerNode", "2")],
                                  "model string, candidate_idx int, name string, value string")
    assert {(r.name, r.value) for r in R.best_params(scores, names).collect()} == {("maxDepth", "5"), ("minInstancesPerNode", "2")}


def test_registered_tree_search_runs_the_full_grid_on_both_datasets(spark):
    rows = Q.REGISTRY["tree_nested_cv"](spark, "/root/testdata/sf0.001").collect()
    for ds in MS.DATASETS:
        mine = [r for r in rows if r.dataset == ds]
        assert {(r.fold, r.name) for r in mine if r.kind == "param"} == {(f, n) for f in range(10) for n in ("maxDepth", "minInstancesPerNode")}
        assert {r.name for r in mine if r.kind == "best_candidate"} == {"maxDepth", "minInstancesPerNode"}
        best = {r.name: int(r.value) for r in mine if r.kind == "best_candidate"}
        assert best["maxDepth"] in M.TREE_GRID["maxDepth"] and best["minInstancesPerNode"] in M.TREE_GRID["minInstancesPerNode"]


def test_registered_forest_search_takes_its_grid(spark, monkeypatch):
    seen = []

    def search(df, features, label, fold, inner, kind, grid=None, max_bins=256, **options):
        seen.append((kind, grid))
        return spark.createDataFrame([(0, 1.0, 1.0), (0, 2.0, 2.5)], "fold int, target double, prediction double"), [
            {"fold": 0, "importances": [1.0] * len(features), "best_params": {"maxDepth": "5"}, "avg_metrics": [0.5, 0.7], "fit_seconds": 1.0}], [
            {"numTrees": "10"}, {"numTrees": "20"}]
    monkeypatch.setattr(MS.M, "nested_cv", search)
    rows = Q.REGISTRY["forest_nested_cv"](spark, "/root/testdata/sf0.001").collect()
    assert seen == [("forest", Q.SMALL_FOREST_GRID)] * 2
    assert {(r.dataset, r.value) for r in rows if r.kind == "best_candidate"} == {(ds, "20") for ds in MS.DATASETS}


def test_small_domains_and_fits_of_several_tasks(spark):
    df = spark.range(0, 3000, 1, 6).select((F.col("id") % 7).cast("double").alias("a"), F.when(F.col("id") % 2 == 0, F.col("id")).alias("b"),
                                           F.lit(None).cast("double").alias("c"))
    assert T.small_domains(df, ["a", "b", "c"], 8) == {"a": [float(i) for i in range(7)], "c": []}
    train, held = T.fit_cells(4)
    assert not (train * held).any() and (train + held).sum() == 4 * (16 + 4 * 12)
    answers = df.select("a").limit(3)
    assert "broadcast" in T.brief(answers)._jdf.queryExecution().toString().lower()
