"""End-to-end study on the smoke tables, and the driver contract."""
import os
import sys
import tempfile

from pyspark.sql import functions as F

import __spark_entry__ as E
from stratlab.plans.queries import REGISTRY
from stratlab.plans import inputs as I
from stratlab.plans import study

SMOKE = "/root/testdata/sf0.001"


def test_entry_and_registry(spark):
    df = E.entry(spark)
    assert df.columns == ["statistic", "column", "value"] and df.count() == 48
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(REGISTRY) <= set(E.queries())


def test_entry_without_the_training_data_operators(monkeypatch):
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    assert set(E.queries()) == set(REGISTRY) and set(E.oracle_sql()) <= set(REGISTRY)


def test_study_end_to_end(spark):
    ev = I.events(spark, SMOKE)
    with tempfile.TemporaryDirectory() as d:
        strat, scores, best = study.stratify(ev, "value", out_path=d, linkages=["single", "ward"], ks=[2, 3, 4])
        assert best[0] in ("single", "ward") and best[1] in (2, 3, 4)
        assert strat.count() == ev.count()
        assert strat.select(F.max("cluster")).collect()[0][0] <= best[1]
        out = study.describe(ev, strat, ["event_id"], "cluster", 0.1, log_cols=["value"],
                             ratios={"value_per_user": ("value", "user_id")}, exclude=["cluster"], out_path=d)
        assert out["stats"].filter("statistic = 'count' and column = 'value'").collect()[0].value == \
            float(int(0.1 * ev.count()))
        rep = study.report(os.path.join(d, "stats"), spark, ["count", "mean"])
        assert "row order" in rep.columns and rep.count() == 36


def test_model_entry_small(spark):
    with tempfile.TemporaryDirectory() as d:
        out = study.model(spark, SMOKE, out_path=d, kinds=("linear", "tree"),
                          tree_grid={"maxDepth": [3], "minInstancesPerNode": [1]},
                          cv_options={"outer_parallelism": 5, "parallelism": 2, "max_bins": 16})
        fm = out["fold_metrics"]
        assert fm.filter("metric = 'r2'").count() == 2 * 2 * 10      # datasets x models x folds
        rk = out["ranking"].collect()
        assert sorted(r.position for r in rk if r.dataset == "with_outliers") == [1, 2]
        assert out["sensitivity"].count() == 2 * 3
        assert out["best_candidate"].count() == 2
        doc = spark.read.json(os.path.join(d, "document")).count()
        assert doc == 2


def test_model_table_with_own_spec(spark):
    """The model study on a table with other column names (a housing-like layout)."""
    from stratlab.plans import model_study as MS
    import numpy as np
    rng = np.random.default_rng(21)
    n = 600
    inc = rng.lognormal(1.2, 0.4, n)
    val = 40000 * inc + rng.normal(0, 20000, n)
    bpr = rng.uniform(0.1, 0.3, n)
    prox = rng.choice(["ISLAND", "COASTAL", "INLAND"], n, p=[0.02, 0.58, 0.4])
    cl = (inc > 3.5).astype(int) + 1
    rows = [(int(i), float(a), float(b), float(c), str(d), int(e)) for i, (a, b, c, d, e) in
            enumerate(zip(inc, val, bpr, prox, cl))]
    df = spark.createDataFrame(rows, "id bigint, median_income double, median_house_value double, "
                                     "bedrooms_per_room double, ocean_proximity string, cluster int")
    spec = MS.ModelSpec(key=("id",), target="median_income", numeric=("median_house_value", "bedrooms_per_room"),
                        category="ocean_proximity", levels=("ISLAND", "COASTAL", "INLAND"), stratum="cluster",
                        outlier_cols=("median_income", "median_house_value", "bedrooms_per_room"),
                        single_models=(("ols_value", "median_house_value"), ("ols_bpr", "bedrooms_per_room")))
    out = study.model_table(df, spec, kinds=("linear",))
    r2 = {r.dataset: r.mean_r2 for r in out["ranking"].collect()}
    assert r2["with_outliers"] > 0.5                      # income is well explained by house value
    fm, im, tm = MS.single_feature_linear_of(MS.datasets_of(df, spec), spec)
    assert fm.filter("metric = 'r2'").count() == 2 * 2 * 10
    cs, fp, sm = MS.linear_feature_search_of(MS.datasets_of(df, spec), spec)
    assert {r.value for r in fp.collect()} == {"median_house_value"}


def test_readme_workflow_on_csv(spark):
    from stratlab.functions import categories as C
    from stratlab.plans.model_study import ModelSpec
    from stratlab.sources import io as IO
    levels = ["ISLAND", "NEAR OCEAN", "NEAR BAY", "<1H OCEAN", "INLAND"]
    li = spark.read.parquet(f"{SMOKE}/lineitem.parquet")
    housing = li.select(
        (F.col("l_extendedprice") / 1000).alias("median_income"),
        (F.col("l_extendedprice") * 3 + F.col("l_quantity") * 1000).alias("median_house_value"),
        (F.col("l_quantity") * 40).alias("total_rooms"),
        F.when(F.col("l_discount") > 0, F.col("l_quantity") * 8).alias("total_bedrooms"),
        (F.col("l_quantity") * 10 + 5).alias("households"),
        F.element_at(F.array(*[F.lit(v) for v in levels]), (F.col("l_linenumber") % 5 + 1).cast("int"))
        .alias("ocean_proximity"))
    schema = ("median_income double, median_house_value double, total_rooms double, total_bedrooms double, "
              "households double, ocean_proximity string")
    with tempfile.TemporaryDirectory() as d:
        IO.write_table_csv(housing, os.path.join(d, "housing"))
        raw = IO.read_table(spark, os.path.join(d, "housing"), schema, category=("ocean_proximity", levels))
        raw = raw.withColumn("row_id", F.xxhash64(*raw.columns))
        strat, scores, best = study.stratify(raw, "median_income", out_path=os.path.join(d, "a"),
                                             linkages=["single", "average"], ks=[2, 3])
        out = study.describe(raw, strat, ["row_id"], "cluster", 0.10, log_cols=["households", "median_income"],
                             ratios={"rooms_per_household": ("total_rooms", "households")},
                             out_path=os.path.join(d, "b"))
        assert out["null_or_nan_stats"].filter("statistic = 'count' and column = 'total_bedrooms'") \
            .collect()[0].value == 0.0        # bad rows: bedrooms all NULL there (N3/N4)
        table = strat.select(
            "row_id", "median_income", "median_house_value", "cluster",
            F.try_divide("total_bedrooms", "total_rooms").alias("bedrooms_per_room"),
            C.merge_levels("ocean_proximity", ["NEAR OCEAN", "NEAR BAY", "<1H OCEAN"], "COASTAL")
            .alias("ocean_proximity")).na.drop()
        spec = ModelSpec(key=("row_id",), target="median_income",
                         numeric=("median_house_value", "bedrooms_per_room"),
                         category="ocean_proximity", levels=("ISLAND", "COASTAL", "INLAND"), stratum="cluster",
                         outlier_cols=("median_income", "median_house_value", "bedrooms_per_room"))
        res = study.model_table(table, spec, out_path=os.path.join(d, "c"), kinds=("linear",))
        assert res["ranking"].count() == 2
        rep = study.report(os.path.join(d, "b", "stats"), spark, ["count", "mean"])
        assert rep.count() > 0
