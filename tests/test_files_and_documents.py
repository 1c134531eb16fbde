"""Statistics files, string columns, model bundles, the nested document, split by category, scaling by fold."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratlab.operators import describe as D
from stratlab.operators import distribution as V
from stratlab.operators import features as FE
from stratlab.operators import models as M
from stratlab.sources import io as IO

LONG = "statistic string, column string, value double"


def test_statistics_files_unite_their_columns_in_first_seen_order(spark, tmp_path):
    path = f"{tmp_path}/stats"
    IO.write_stat_files(spark.createDataFrame([("mean", "z", 1.5), ("mean", "a", 2.0), ("count", "z", 3.0), ("count", "a", None)], LONG), path)
    IO.write_stat_files(spark.createDataFrame([("mean", "b", 9.0)], LONG), path, "derived_")
    IO.write_stat_files(spark.createDataFrame([("mean", "y", 7.0)], LONG), path, "null_or_nan_")
    back = IO.read_stat_files(spark, path)
    assert back.columns == ["group", "file", "statistic", "z", "a", "y", "b"]   # the count file comes first and has no a
    rows = {(r["group"], r.statistic): r for r in back.collect()}
    assert set(rows) == {("raw", "mean"), ("raw", "count"), ("derived", "mean"), ("null_or_nan", "mean")}
    assert rows["raw", "mean"].z == 1.5 and rows["raw", "count"].a is None and rows["derived", "mean"].b == 9.0
    # a rewrite replaces only its own files
    IO.write_stat_files(spark.createDataFrame([("mean", "b", 10.0)], LONG), path, "derived_")
    rows = {(r["group"], r.statistic): r for r in IO.read_stat_files(spark, path).collect()}
    assert len(rows) == 4 and rows["derived", "mean"].b == 10.0


def test_a_statistics_file_of_two_rows_is_an_error(spark, tmp_path):
    folder = tmp_path / "file=stats_mean.json"
    folder.mkdir()
    (folder / "part-0.json").write_text('{"a": 1.0}\n{"a": 2.0}\n')
    with pytest.raises(TypeError):
        IO.read_stat_files(spark, str(tmp_path))


def test_strings_have_counts_and_extremes(spark):
    df = spark.createDataFrame([("b", 1.0, None), ("a", 2.0, None), (None, float("nan"), None)], "s string, x double, e string")
    rows = {(r.column, r.statistic): (r.value, r.text) for r in D.describe_with_strings(df).collect()}
    assert rows["s", "count"] == (2.0, None) and rows["s", "min"] == (None, "a") and rows["s", "max"] == (None, "b")
    assert rows["s", "mean"] == (None, None) and rows["x", "mean"] == (1.5, None)
    assert rows["e", "count"] == (0.0, None) and rows["e", "max"] == (None, None)
    only = D.describe_with_strings(df.select("s"))
    assert only.count() == len(D.STATISTICS)


def test_a_saved_linear_model_predicts_as_before(spark, tmp_path):
    rng = np.random.default_rng(1)
    rows = [(i % 3, float(a), float(b), float(2 * a - b + e)) for i, (a, b, e) in enumerate(rng.normal(size=(90, 3)))]
    df = spark.createDataFrame(rows, "fold int, a double, b double, y double")
    fit = M.linear_cv(df, ["a", "b"], "y", "fold", standardize=["a"])
    IO.save_linear(fit, str(tmp_path), "with", "linear", spark)
    IO.save_linear(fit, str(tmp_path), "without", "linear", spark)
    back = IO.load_linear(spark, str(tmp_path), "with", "linear")
    assert back.features == fit.features and set(os.listdir(tmp_path)) == {"with_linear", "without_linear"}
    both = df.select(fit.prediction("fold").alias("p"), back.prediction("fold").alias("q")).collect()
    assert len(both) == 90 and all(r.p == r.q for r in both)
    assert all((back.std_coefs[k] == fit.std_coefs[k]).all() for k in fit.std_coefs)


def test_document_holds_the_sections_given(spark, tmp_path):
    fm = spark.createDataFrame([("d", "m", 0, "r2", 0.5), ("d", "m", 1, "r2", 0.7), ("e", "m", 0, "r2", 0.1)],
                               "dataset string, model string, fold int, metric string, value double")
    best = spark.createDataFrame([("d", "m", 0, 0.6, "depth", "3")],
                                 "dataset string, model string, candidate_idx int, overall_mean_r2 double, name string, value string")
    counts = spark.createDataFrame([(10, 1)], "total long, bad long")
    doc = IO.study_document({"fold_metrics": fm, "best_params": best, "quality_counts": counts})
    assert doc.columns == ["dataset", "models", "parameters", "counts"]
    IO.write_document(doc, f"{tmp_path}/doc")
    back = {r.dataset: r for r in IO.read_document(spark, f"{tmp_path}/doc", doc.schema).collect()}
    assert back["d"].models["m"]["r2"]["mean"] == pytest.approx(0.6) and [x["value"] for x in back["d"].models["m"]["r2"]["folds"]] == [0.5, 0.7]
    assert back["d"].parameters == {"m": {"depth": "3"}} and back["e"].parameters is None
    assert [r.asDict() for r in back["e"].counts] == [{"total": 10, "bad": 1}]


def test_levels_without_rows_are_left_out(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), ("b", 3), (None, 4), ("odd", 5)], "c string, x int")
    got = V.split_by_level(df, "c", ["a", "none", "b"])
    assert list(got) == ["a", "b"] and [r.x for r in got["b"].orderBy("x").collect()] == [1, 3]


def test_scaled_by_the_other_folds(spark):
    rng = np.random.default_rng(2)
    x, fold = rng.normal(50, 3, 200), np.arange(200) % 4
    df = spark.createDataFrame([(int(f), float(v), 7.0) for f, v in zip(fold, x)], "fold int, x double, k double")
    got = FE.standardize_by_fold(df.withColumn("was", F.col("x")), ["x", "k"], "fold").collect()
    for r in got:
        other = x[fold != r.fold]
        assert r.x == pytest.approx((r.was - other.mean()) / other.std(), abs=1e-9) and r.k == 0.0
