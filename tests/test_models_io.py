"""OLS by fold moments vs NumPy, metrics, sinks/sources round trips."""
import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratlab.operators import features as FE
from stratlab.operators import models as M
from stratlab.operators import results as R
from stratlab.sources import io as IO


@pytest.fixture
def known_line(spark):
    rng = np.random.default_rng(2)
    n = 400
    x1, x2 = rng.normal(0, 1, n), rng.uniform(0, 5, n)
    y = 3 + 2 * x1 - x2 + rng.normal(0, 0.01, n)
    rows = [(i, float(a), float(b), float(c), i % 5) for i, (a, b, c) in enumerate(zip(x1, x2, y))]
    return spark.createDataFrame(rows, "id bigint, x1 double, x2 double, y double, fold int"), x1, x2, y


def test_fold_ols_matches_lstsq(spark, known_line):
    df, x1, x2, y = known_line
    fit = M.linear_cv(df.withColumn("zero", F.lit(0.0)), ["x1", "x2", "zero"], "y", "fold", standardize=["x1", "x2"])
    folds = np.arange(len(y)) % 5
    for k in range(5):
        tr = folds != k
        X = np.column_stack([np.ones(tr.sum()), x1[tr], x2[tr]])
        beta = np.linalg.lstsq(X, y[tr], rcond=None)[0]
        assert fit.intercepts[k] == pytest.approx(beta[0], abs=1e-8)
        assert fit.coefs[k][:2] == pytest.approx(beta[1:], abs=1e-8)
        assert fit.coefs[k][2] == 0.0                      # constant column -> 0
        assert fit.std_coefs[k][0] == pytest.approx(beta[1] * x1[tr].std(), abs=1e-8)


def test_metrics_definition(spark):
    df = spark.createDataFrame([(1, 1.0, 1.5), (1, 2.0, 1.5), (1, 3.0, 3.5)], "g int, y double, p double")
    m = M.regression_metrics(df, "y", "p", ["g"]).collect()[0]
    e = np.array([-0.5, 0.5, -0.5])
    yy = np.array([1.0, 2.0, 3.0])
    assert m.r2 == pytest.approx(1 - (e ** 2).sum() / ((yy - yy.mean()) ** 2).sum())
    assert m.rmse == pytest.approx(np.sqrt((e ** 2).mean())) and m.mae == pytest.approx(0.5)


def test_one_hot_and_standardizer(spark):
    df = spark.createDataFrame([("A", 1.0), ("B", 3.0), ("C", 5.0)], "c string, x double")
    oh = FE.one_hot(df, "c", ["A", "B", "C"], drop_level="A")
    assert oh.columns == ["x", "c_B", "c_C"]
    z = FE.apply_standardizer(df, FE.fit_standardizer(df, ["x"]))
    assert [round(r.x, 9) for r in z.collect()] == [round(v, 9) for v in (np.array([1, 3, 5]) - 3) / np.std([1, 3, 5])]


def test_tree_nested_cv_small(spark, known_line):
    df, *_ = known_line
    from stratlab.operators import sampling as S
    f = S.stratified_folds(df.withColumn("s", F.lit(1)), ["id"], "s", k=3, inner="inner")
    preds, per_fold, cands = M.nested_cv(f, ["x1", "x2"], "y", "fold", "inner", kind="tree",
                                         grid={"maxDepth": [2, 4], "minInstancesPerNode": [1]},
                                         outer_parallelism=3, parallelism=2)
    assert preds.count() == 400 and len(per_fold) == 3 and len(cands) == 2
    met = M.regression_metrics(preds, "y", "prediction", ["fold"]).collect()
    assert all(r.r2 > 0.5 for r in met)     # beats the mean predictor
    with tempfile.TemporaryDirectory() as d:
        meta = IO.save_models({p["fold"]: p["model"] for p in per_fold}, d, "ds", "tree", ["x1", "x2"], spark)
        from pyspark.ml.regression import DecisionTreeRegressionModel
        first = meta.orderBy("fold").collect()[0]
        again = DecisionTreeRegressionModel.load(first.path)
        v = FE.assemble(df.limit(20), ["x1", "x2"])
        a = [r.prediction for r in again.transform(v).collect()]
        b = [r.prediction for r in per_fold[0]["model"].transform(v).collect()]
        assert a == b


def test_stats_round_trip_and_routing(spark):
    long = spark.createDataFrame([("mean", "a", 1.5), ("count", "a", 3.0)], "statistic string, column string, value double")
    with tempfile.TemporaryDirectory() as d:
        p = os.path.join(d, "stats")
        IO.write_stats(long, p, "raw")
        IO.write_stats(long.withColumn("value", F.col("value") * 2), p, "derived")
        back = IO.read_stats(spark, p)
        IO.check_one_row_per_key(back, ["prefix", "statistic", "column"])
        got = {(r.prefix, r.statistic): r.value for r in back.collect()}
        assert got[("raw", "mean")] == 1.5 and got[("derived", "count")] == 6.0
        csv = os.path.join(d, "csv")
        IO.write_table_csv(long, csv, single_file=True)
        again = IO.read_table(spark, csv, "statistic string, column string, value double")
        assert sorted(again.collect()) == sorted(long.collect())
    names = spark.createDataFrame([("x/null_or_nan_stats_mean.json",), ("derived_stats_q1.json",),
                                   ("stats_min.json",), ("other.json",)], "f string")
    assert [r[0] for r in names.select(IO.stats_group(F.col("f"))).collect()] == ["null_or_nan", "derived", "raw", None]


def test_category_guard_fails_on_unknown(spark):
    from stratlab.functions.categories import enforce_domain, level_frequency
    df = spark.createDataFrame([("A",), ("Z",)], "c string")
    with pytest.raises(Exception):
        enforce_domain(df, "c", ["A", "B"]).collect()
    freq = level_frequency(spark.createDataFrame([("A",), ("A",)], "c string"), "c", ["A", "B"]).collect()
    assert [(r.c, r.n) for r in freq] == [("A", 2), ("B", 0)]


def test_results_nan_guard_and_document(spark):
    fm = spark.createDataFrame([("d", "m", 0, "r2", 0.5), ("d", "m", 1, "r2", 0.7)],
                               "dataset string, model string, fold int, metric string, value double")
    doc = IO.results_document(fm).collect()[0]
    assert doc.models["m"]["r2"]["mean"] == pytest.approx(0.6)
    bad = fm.withColumn("value", F.lit(float("nan")))
    with pytest.raises(ValueError):
        IO.check_no_nan(bad, bad.columns)
    rk = R.model_ranking(fm.withColumn("share_of_target_mean", F.lit(None).cast("double")), ["m"]).collect()
    assert rk[0].position == 1 and rk[0].is_best


def test_r2_from_moments_equals_direct(spark):
    rng = np.random.default_rng(12)
    x = rng.normal(5, 2, 300)
    y = 1.5 + 0.7 * x + rng.normal(0, 1, 300)
    n, mu = len(x), np.array([x.mean(), y.mean()])
    m = np.cov(np.vstack([x, y]), bias=True) * n
    b0, b1 = 1.2, 0.8
    e = y - (b0 + b1 * x)
    direct = 1 - (e ** 2).sum() / ((y - y.mean()) ** 2).sum()
    assert M.r2_from_moments(n, mu, m, b0, b1) == pytest.approx(direct, abs=1e-12)


def test_results_round_trip(spark):
    fm = spark.createDataFrame([("d", "m", 0, "r2", 0.5, None), ("d", "m", 0, "rmse", 2.0, 0.1)],
                               "dataset string, model string, fold int, metric string, value double, "
                               "share_of_target_mean double")
    with tempfile.TemporaryDirectory() as d:
        IO.write_results({"fold_metrics": fm}, d)
        back = IO.read_results(spark, d, "fold_metrics", fm.schema)
        assert sorted(back.collect()) == sorted(fm.collect())
