"""The forest search from one aggregate against MLlib forests."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratlab.operators import forests as FO
from stratlab.operators import models as M
from stratlab.operators import sampling as S
from stratlab.operators import trees as TR
from stratlab.plans import queries as Q

FEATURES = ["x1", "x2", "g"]


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(3)
    n = 1500
    x1, x2, g = rng.integers(0, 12, n), rng.integers(0, 9, n), rng.integers(0, 2, n)
    y = np.where(x1 > 6, 40.0, 5.0) + np.where((x2 > 3) & (g == 1), 17.0, 0.0) + 3 * (x1 % 3) + rng.normal(0, 2, n)
    rows = [(str(i), int(i % 2), float(a), float(b), float(c), float(d)) for i, (a, b, c, d) in enumerate(zip(x1, x2, g, y))]
    df = spark.createDataFrame(rows, "row_key string, stratum int, x1 double, x2 double, g double, y double")
    return S.stratified_folds(df, ["row_key"], "stratum", k=3, inner="inner").checkpoint()


def test_forest_search_agrees_with_mllib_and_runs_no_fit_of_it(table, monkeypatch):
    grid = {"numTrees": [12], "maxDepth": [2, 5], "featureSubsetStrategy": ["all"]}
    want, per_fold, cands = M.nested_cv(table, FEATURES, "y", "fold", "inner", kind="forest", grid=grid, max_bins=32)

    def refuse(*a, **kw):
        raise AssertionError("an MLlib fit")
    monkeypatch.setattr(M, "CrossValidator", refuse)
    got, own, names = M.nested_cv(table, FEATURES, "y", "fold", "inner", kind="forest", grid=grid, max_bins=32, models=False)
    assert names == cands and [p["fold"] for p in own] == [p["fold"] for p in per_fold]
    for a, b in zip(own, per_fold):
        assert a["best_params"] == b["best_params"] and "model" not in a
        assert a["avg_metrics"] == pytest.approx(b["avg_metrics"], abs=0.02)
        assert a["importances"] == pytest.approx(b["importances"], abs=0.05)
    keys = [r.row_key for r in got.select("row_key").collect()]
    assert len(keys) == len(set(keys)) == 1500
    r2 = {r.fold: r.r2 for r in M.regression_metrics(want, "y", "prediction", ["fold"]).collect()}
    for r in M.regression_metrics(got, "y", "prediction", ["fold"]).collect():
        assert r.r2 == pytest.approx(r2[r.fold], abs=0.02)


def test_sums_of_fits_and_bags(spark, table):
    binned = TR.with_bins(table, TR.bin_cuts(table, FEATURES))
    cells = FO.bagged_cells(binned, "y", "fold", "inner", 12, 3, 7)   # two passes over the rows
    total = cells.agg(F.sum("n"), F.sum("s"), F.sum(F.col("bags")[22]), F.max(F.size("bags"))).first()
    assert total[0] == 1500 and total[1] == pytest.approx(table.agg(F.sum("y")).first()[0])
    assert 1350 < total[2] < 1650 and total[3] == 24
    fits = FO.bagged_fits(cells, [0, 1, 2], 3).groupBy("outer", "inner").agg(F.sum("hn").alias("hn"), F.sum("hs").alias("hs"), F.sum(F.col("bags")[0]).alias("n0"))
    rows = table.select("fold", "inner", "y").collect()
    bag = cells.groupBy("fold", "inner").agg(F.sum(F.col("bags")[0]).alias("n0")).collect()
    for r in fits.collect():
        held = [x.y for x in rows if (x.fold == r.outer if r.inner < 0 else x.fold != r.outer and x.inner[r.outer] == r.inner)]
        train = [x.n0 for x in bag if x.fold != r.outer and (r.inner < 0 or x.inner[r.outer] != r.inner)]
        assert r.hn == len(held) and r.hs == pytest.approx(sum(held)) and r.n0 == sum(train)


def test_smaller_forests_are_the_beginning_of_larger_ones():
    rng = np.random.default_rng(5)
    bins = rng.integers(0, 6, (80, 4))
    n = rng.poisson(1, (80, 5)).astype(float)
    bags = np.stack([n, n * rng.normal(0, 1, (80, 5))], axis=2).reshape(80, 10)
    whole = {(t, d): v for t, d, v, _ in FO.forest(bins, bags, [2, 6], [3, 5], 2, 9)}
    for t, d in whole:
        alone = next(iter(FO.forest(bins, bags, [d], [t], 2, 9)))
        assert alone[2] == pytest.approx(whole[t, d], abs=1e-12)
    assert FO.node_subset(9, 0, 4, 2)(np.arange(1, 50)).sum(axis=1).tolist() == [2] * 49


def test_trees_grown_side_by_side_are_those_grown_alone():
    rng = np.random.default_rng(11)
    for widths in ((7, 30, 2, 2, 2, 2), (2, 2, 2), (1, 5)):
        bins = np.unique(np.stack([rng.integers(0, w, 300) for w in widths], axis=1), axis=0)
        n = rng.poisson(0.8, (len(bins), 9)).astype(float)
        s = n * rng.normal(100, 30, n.shape)
        for size in (2, len(widths)):
            starts = FO.tree_starts(4, 3, 9)
            got = {d: (v.copy(), g.copy()) for d, v, g in FO.grow_together(bins, n.T, s.T, [0, 2, 30], starts, size)}
            for t in range(9):
                tn, ts, zero = n[:, t], s[:, t], np.zeros(len(bins))
                floor = (np.divide(ts * ts, tn, out=zero.copy(), where=tn > 0).sum() + 1e-300) * TR.LEAST_GAIN
                levels = [(None, np.full(len(bins), ts.sum() / tn.sum()))]
                for d, *_, gains in TR.grow(bins, np.stack([tn, ts, zero, zero, zero], axis=1), 1, 0, [0, 2, 30], floor, levels,
                                            FO.node_subset(4, 3 + t, len(widths), size)):
                    assert got[d][0][t] == pytest.approx(levels[-1][1], abs=1e-9)
                    assert got[d][1][t] == pytest.approx(gains, rel=1e-6, abs=1e-6)


def test_passes_over_the_trees_add_up(table, monkeypatch):
    assert FO.passes([4, 12], 10) == [((4, 12), [[0, 4, 12]])]
    monkeypatch.setattr(FO, "PASS_NUMBERS", 6 * 216)   # 3 trees of the table's 216 vectors
    assert FO.passes([4, 12], 216) == [((4,), [[0, 3]]), ((4, 12), [[3, 4, 6]]), ((12,), [[6, 9], [9, 12]])]
    cands = [{"numTrees": n, "maxDepth": d, "featureSubsetStrategy": f} for n in ("4", "12") for d in ("2", "30") for f in ("all", "2")]
    table = table.checkpoint()
    _, parts, = FO.nested_forest_search(table, FEATURES, "y", "fold", "inner", cands, 32, 7)
    monkeypatch.setattr(FO, "PASS_NUMBERS", 1_000_000)
    rows, whole = FO.nested_forest_search(table, FEATURES, "y", "fold", "inner", cands, 32, 7)
    assert len({a["best_idx"] for a in whole}) >= 1 and rows.count() == 1500
    for a, b in zip(parts, whole):
        assert a["avg_metrics"] == pytest.approx(b["avg_metrics"], abs=1e-9) and len(b["avg_metrics"]) == 8
        assert a["importances"] == pytest.approx(b["importances"], abs=1e-9) and sum(b["importances"]) == pytest.approx(1)
        assert b["avg_metrics"][7] > b["avg_metrics"][1]   # 12 trees with as many levels as they need against 4 of depth 2


def test_registered_forest_search_has_the_whole_grid_of_the_study(spark, monkeypatch):
    seen = []

    def search(df, features, target, fold, inner, cands, max_bins, seed):
        seen.append((cands, max_bins))
        return df.withColumn("prediction", F.col(target)), [{"fold": f, "importances": [0.2] * 5, "best_params": cands[0], "avg_metrics": [0.0] * len(cands),
                                                             "fit_seconds": 0.0} for f in range(10)]
    monkeypatch.setattr(M, "nested_forest_search", search)
    Q.REGISTRY["forest_nested_cv"](spark, "/root/testdata/sf0.001")
    for cands, max_bins in seen:
        assert {(c["numTrees"], c["maxDepth"], c["featureSubsetStrategy"]) for c in cands} == {
            (n, d, f) for n in ("50", "100", "200", "400") for d in ("30", "5", "10", "20") for f in ("all", "2")}
        assert len(cands) == 32 and max_bins == 256
    assert len(seen) == 2


def test_feature_subsets_as_mllib_reads_them():
    assert [FO.subset_count(s, 5) for s in ("all", "sqrt", "log2", "onethird", "auto", "2", "9", "0.5")] == [5, 3, 3, 2, 2, 2, 5, 3]


def test_registered_forest_search_on_small_tables(spark):
    rows = Q.REGISTRY["forest_nested_cv"](spark, "/root/testdata/sf0.001").collect()
    for ds in ("with_outliers", "without_outliers"):
        mine = [r for r in rows if r.dataset == ds]
        assert {(r.fold, r.name) for r in mine if r.kind == "param"} == {(f, n) for f in range(10) for n in ("numTrees", "maxDepth", "featureSubsetStrategy")}
        assert {(r.fold, r.name) for r in mine if r.kind == "metric" and r.value is not None} == {(f, n) for f in range(10) for n in ("r2", "rmse", "mae")}
