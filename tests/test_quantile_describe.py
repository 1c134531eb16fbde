"""Exact quantiles and describe on hand-made frames (N1-N14 in SURVEY 1.4)."""
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratlab.functions import columns as K
from stratlab.operators import describe as D
from stratlab.operators import quantile as Q


def nearest(xs, q):
    s = sorted(xs)
    return s[int(math.floor((len(s) - 1) * q + 0.5))]


@pytest.mark.parametrize("n", [1, 2, 3, 7, 207, 2043])
def test_nearest_rank_halves(spark, n):
    xs = [float(i) for i in range(n)]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = Q.quantiles(df, ["x"], [0.25, 0.5, 0.75], "nearest")
    for q in (0.25, 0.5, 0.75):
        assert got[("x", q)] == nearest(xs, q)
    lin = Q.quantiles(df, ["x"], [0.25, 0.5, 0.75], "linear")
    for q in (0.25, 0.5, 0.75):
        assert lin[("x", q)] == pytest.approx(float(np.percentile(xs, q * 100)))


def test_refinement_path_matches_sort(spark):
    """Force the distributed bracket search (tiny exact_rows) with heavy duplicates."""
    rng = np.random.default_rng(5)
    xs = np.concatenate([rng.lognormal(2, 1.5, 3000), np.full(1500, 7.25), rng.normal(0, 1, 500)])
    df = spark.createDataFrame([(float(v),) for v in xs], "x double").repartition(7)
    want = {r: float(np.sort(xs)[r]) for r in [0, 1, 17, 1499, 1500, 2500, 4998, 4999]}
    got = Q.order_statistics(df, {"x": list(want)}, exact_rows=50, buckets=16)
    assert {r: got[("x", r)] for r in want} == want


def test_describe_nulls_nan_all_null(spark):
    rows = [(1, 1.0, None, None), (2, float("nan"), 2.0, None), (3, 3.0, 3.0, None), (4, 100.0, 4.0, None)]
    df = spark.createDataFrame(rows, "id bigint, a double, b double, c double")
    long = {(r["statistic"], r["column"]): r["value"] for r in D.describe(df, ["a", "b", "c"]).collect()}
    assert long[("count", "a")] == 3          # NaN is missing (N12)
    assert long[("max", "a")] == 100.0
    assert long[("count", "c")] == 0          # all-null column (N4)
    assert long[("mean", "c")] is None and long[("q1", "c")] is None
    assert long[("outliers", "c")] == 0 and long[("outliers_pct", "c")] is None
    assert long[("median", "b")] == 3.0


def test_bad_rows_and_complete_rows(spark):
    rows = [(1, 1.0, "x"), (2, None, "y"), (3, float("nan"), "z"), (4, 2.0, None)]
    df = spark.createDataFrame(rows, "id bigint, a double, c string")
    assert sorted(r.id for r in K.keep_bad_rows(df).collect()) == [2, 3, 4]
    assert [r.id for r in K.keep_complete_rows(df).collect()] == [1]
    assert sorted(r.id for r in K.keep_complete_rows(df, nulls_only=True).collect()) == [1, 3]


def test_zero_denominator_and_log_domain(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, -2.0), (None, 1.0), (0.0, 0.0)], "num double, den double")
    got = [r[0] for r in df.select(K.ratio("num", "den")).collect()]
    assert got == [None, -0.5, None, None]
    lg = spark.createDataFrame([(-1.0,), (0.0,), (1.0,), (None,)], "x double")
    assert [r[0] for r in lg.select(K.natural_log("x")).collect()] == [None, None, 0.0, None]


def test_outlier_filter_drops_rows_with_null_test(spark):
    df = spark.createDataFrame([(float(i),) for i in range(20)] + [(1000.0,), (None,)], "x double")
    kept = D.drop_outlier_rows(df, ["x"])
    vals = [r.x for r in kept.collect()]
    assert 1000.0 not in vals and None not in vals and len(vals) == 20


def test_results_do_not_depend_on_partitioning(spark):
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([(float(v),) for v in rng.exponential(3, 999)], "x double")
    a = D.describe(df.repartition(1), ["x"]).collect()
    b = D.describe(df.repartition(17), ["x"]).collect()
    key = lambda rows: {(r.statistic): round(r.value, 9) for r in rows}
    assert key(a) == key(b)


def test_display_number(spark):
    df = spark.createDataFrame([(None,), (float("nan"),), (1234.0,), (1234.5678,), (12.34567,), (0.123456,)], "v double")
    got = [r[0] for r in df.select(K.display_number("v")).collect()]
    assert got == ["--", "--", "1\\,234", "1\\,234.57", "12.346", "0.1235"]


def test_describe_approx_close_to_exact(spark):
    rng = np.random.default_rng(17)
    df = spark.createDataFrame([(float(v),) for v in rng.gamma(2, 5, 5000)], "x double")
    exact = {r.statistic: r.value for r in D.describe(df, ["x"]).collect()}
    approx = {r.statistic: r.value for r in D.describe(df, ["x"], approx=True).collect()}
    for s in ("q1", "median", "q3"):
        assert approx[s] == pytest.approx(exact[s], rel=0.01)
    assert approx["count"] == exact["count"] and approx["mean"] == pytest.approx(exact["mean"])
