"""Cases that earlier versions got wrong: each failed before its fix."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from stratlab.functions import columns as K
from stratlab.operators import distribution as DI
from stratlab.operators import linkage1d as L
from stratlab.operators import models as M
from stratlab.operators import sampling as S
from stratlab.plans import model_study as MS


def test_whiskers_never_lie_inside_the_box(spark):
    r = DI.box_summary(spark.createDataFrame([(0.0,), (0.0,), (0.0,), (100.0,)], "x double"), ["x"]).first()
    assert (r.q3, r.whisker_hi, r.fliers) == (25.0, 25.0, 1)


def test_histogram_counts_rows_of_a_null_label(spark):
    df = spark.createDataFrame([(1.0, "a"), (2.0, None), (3.0, None)], "x double, g string")
    rows = DI.histogram(df, ["x"], bins=2, by="g").where("g is null").collect()
    assert len(rows) == 2 and sum(r.n for r in rows) == 2


def test_display_number_rounds_ties_to_even(spark):
    df = spark.createDataFrame([(1.0005,), (2.0625,)], "v double")
    assert [r[0] for r in df.select(K.display_number("v")).collect()] == ["1.000", "2.062"]


def test_ols_keeps_features_of_small_scale():
    rng = np.random.default_rng(3)
    x = np.stack([rng.normal(0, 1e7, 500), rng.normal(0, 0.01, 500)])
    rows = np.vstack([x, 2 * x[0] + 100 * x[1]])
    mu = rows.mean(axis=1)
    d = rows - mu[:, None]
    _, beta = M.ols_from_moments(500, mu, d @ d.T)
    assert beta == pytest.approx([2.0, 100.0], rel=1e-6)


def test_ecdf_of_no_values_is_empty(spark):
    assert DI.ecdf(spark.createDataFrame([(None,), (None,)], "x double"), "x").count() == 0


@pytest.mark.parametrize("count", [1, 3])
def test_every_dataset_is_in_the_results(spark, count):
    rows = [(str(i), float(i % 7), float(i % 5), "A" if i % 2 else "N", i % 2) for i in range(200)]
    df = spark.createDataFrame(rows, "row_key string, target double, x double, category string, stratum int")
    spec = MS.ModelSpec(numeric=("x",), levels=("A", "N"), outlier_cols=("target",), single_models=(("one", "x"),))
    sets = {f"d{k}": df for k in range(count)}
    fm, im, tm = MS.single_feature_linear_of(sets, spec)
    assert {r[0] for r in fm.select("dataset").distinct().collect()} == set(sets)
    assert fm.count() == count * 30 and im.count() == count * 10 and tm.count() == count


def test_many_strata_stay_a_table(spark):
    df = spark.range(60_000).select(F.col("id").cast("string").alias("k"), (F.col("id") % 30_000).alias("s"))
    got = S.stratified_sample(df, ["k"], "s", 0.5).groupBy("in_sample").count().collect()
    assert {r["in_sample"]: r["count"] for r in got} == {True: 30_000, False: 30_000}


def test_equal_scores_fall_to_the_first_setting(spark):
    df = spark.createDataFrame([("single", 3, 0.5), ("single", 2, 0.5 - 1e-13), ("ward", 2, 0.5 + 1e-13)],
                               "linkage string, k int, silhouette double")
    assert L.best_setting(df).first().k == 2


def test_forest_subsets_follow_the_feature_count():
    assert M.subset_sizes(["all", "sqrt", "log2"], 5) == ["all", "2"]
    assert M.subset_sizes(["all", "sqrt", "log2"], 17) == ["all", "4"]
    assert M.subset_sizes(["all", "sqrt", "log2"], 100) == ["all", "10", "6"]
