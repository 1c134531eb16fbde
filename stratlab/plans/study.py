"""End-to-end study, the three entry points of the reference as Spark jobs.

A ``stratify``: complete rows -> 1-D clustering of one column over four
   linkages and k = 2..10 -> best labelling -> stratified table (Parquet/CSV).
B ``describe``: bad rows statistics; exact stratified sample; statistics,
   distributions and correlations of raw, log and ratio columns; report table.
C ``model``: quality funnel, datasets with/without outliers, nested CV of
   linear / tree / forest models, long result tables, sensitivity, bundles.

Every intermediate that is read more than once is checkpointed in the
shared ``spark.checkpoint.dir`` (never a machine-local folder), so a lost
executor costs a stage retry, not a recomputation from the source.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as K
from ..operators import describe as D
from ..operators import distribution as V
from ..operators import linkage1d as L
from ..operators import results as R
from ..operators import sampling as S
from ..session import ensure_checkpoint_dir
from ..sources import io as IO


def stratify(df: DataFrame, column: str, out_path: str | None = None, label: str = "cluster",
             linkages: Sequence[str] = L.LINKAGES, ks: Sequence[int] = L.CLUSTER_COUNTS):
    """Entry A. Returns (stratified DataFrame, silhouette scores, best (linkage, k, cuts))."""
    ensure_checkpoint_dir(df.sparkSession)
    complete = K.keep_complete_rows(df)
    scores, best, _ = L.cluster_study(complete, column, linkages, ks)
    out = L.add_cluster_label(complete, column, best[2], label)
    if out_path:
        IO.write_table(out, os.path.join(out_path, "stratified"))
        IO.write_results({"silhouette": L.best_per_linkage(scores)}, out_path)
    return out, scores, best


def describe(raw: DataFrame, stratified: DataFrame, key_cols: Sequence[str], stratum: str,
             fraction: float = 0.10, log_cols: Sequence[str] = (), ratios: dict | None = None,
             exclude: Sequence[str] = (), out_path: str | None = None) -> dict[str, DataFrame]:
    """Entry B. Returns the named result DataFrames (all lazily defined or checkpointed)."""
    spark = raw.sparkSession
    ensure_checkpoint_dir(spark)
    bad = K.keep_bad_rows(raw)
    sample = (S.stratified_sample(stratified, key_cols, stratum, fraction)
              .filter("in_sample").drop("in_sample").checkpoint())
    num = K.numeric_columns(sample, [*exclude, *key_cols])
    derived_cols = [F.col(c) for c in num]
    if ratios:
        derived_cols += [K.ratio(a, b).alias(n) for n, (a, b) in ratios.items()]
    derived = sample.select(*derived_cols)
    logs = sample.select(*K.log_columns(log_cols, "_ln")) if log_cols else None
    out = {
        "null_or_nan_stats": D.describe(bad, exclude=[*exclude, *key_cols]),
        "stats": D.describe(sample, num),
        "derived_stats": D.describe(derived),
        "histograms": V.histogram(sample, num),
        "boxes": V.box_summary(sample, num),
        "correlation": V.correlation_long(K.keep_complete_rows(sample.select(*num), nulls_only=True), num),
    }
    if logs is not None:
        out["log_histograms"] = V.histogram(logs, logs.columns)
    if out_path:
        for prefix, name in [("null_or_nan_", "null_or_nan_stats"), ("", "stats"), ("derived_", "derived_stats")]:
            IO.write_stats(out[name], os.path.join(out_path, "stats"), IO.STATS_GROUPS[prefix])
        IO.write_results({k: v for k, v in out.items() if "stats" not in k}, out_path)
    return out


def report(stats_path: str, spark, order: Sequence[str]) -> DataFrame:
    """Report tables (O-05, O-06, O-93..O-96): statistics files back, one wide text
    table per group, rows in a fixed order, humanised headers."""
    long = IO.read_stats(spark, stats_path)
    IO.check_one_row_per_key(long, ["prefix", "statistic", "column"])
    cols = [r[0] for r in long.select("column").distinct().orderBy("column").collect()]  # column names only
    wide = (long.groupBy("prefix", "statistic").pivot("column", cols).agg(F.first("value")))
    shown = wide.select("prefix", R.fixed_order_key("statistic", order).alias("row_order"), "statistic",
                        *[K.display_number(c, F.col("statistic").isin("count", "outliers")).alias(c) for c in cols])
    shown = shown.drop("cluster") if "cluster" in shown.columns else shown
    return K.humanize_columns(shown.orderBy("prefix", "row_order", "statistic"))


def model(spark, sf_dir: str, out_path: str | None = None, **kw) -> dict[str, DataFrame]:
    """Entry C on the driver tables (``inputs.regression_table``), see ``model_table``."""
    from . import inputs as I
    return model_table(I.regression_table(spark, sf_dir), out_path=out_path, **kw)


def model_table(table: DataFrame, spec=None, out_path: str | None = None, tree_grid: dict | None = None,
                forest_grid: dict | None = None, kinds: Sequence[str] = ("linear", "tree", "forest"),
                cv_options: dict | None = None) -> dict[str, DataFrame]:
    """Entry C: quality funnel, datasets with/without outliers, every model kind, long
    result tables, ranking, sensitivity and (with ``out_path``) the NaN-checked
    results and the results document.

    ``spec`` (``model_study.ModelSpec``) names the column roles; ``tree_grid`` and
    ``forest_grid`` default to the full study grids.
    """
    from . import model_study as MS

    spark = table.sparkSession
    spec = spec or MS.DEFAULT_SPEC
    ensure_checkpoint_dir(spark)
    cv_options = cv_options or {}
    base = MS.datasets_of(table, spec)
    funnel = D.quality_counts(table, list(spec.outlier_cols))
    fms, imps, params, cands, tms, grids = [], [], [], [], [], {}
    for ds, df in base.items():
        df = df.checkpoint()
        tms.append(D.target_summary(df, spec.target).select(F.lit(ds).alias("dataset"),
                                                         F.col("mean").alias("target_mean"),
                                                         "minimum", "maximum", "rows"))
        tag = lambda x: x.withColumn("dataset", F.lit(ds))
        if "linear" in kinds:
            fm, imp, fit = MS.linear_study(df, spec)
            if out_path:
                IO.save_linear(fit, os.path.join(out_path, "models"), ds, "linear", spark)
            fms.append(tag(fm))
            imps.append(tag(imp))
        for kind, grid in (("tree", tree_grid), ("forest", forest_grid)):
            if kind not in kinds:
                continue
            fm, imp, prm, sc, timing, names, models = MS.tree_study(df, kind, grid=grid, spec=spec, **cv_options)
            grids[kind] = names
            if out_path and models:
                IO.save_models(models, os.path.join(out_path, "models"), ds, kind, MS.feature_names(spec), spark)
            fms.append(tag(fm).unionByName(tag(timing), allowMissingColumns=True))
            imps.append(tag(imp))
            params.append(tag(prm))
            cands.append(tag(sc))
    union = lambda xs: None if not xs else xs[0] if len(xs) == 1 else xs[0].unionByName(union(xs[1:]), allowMissingColumns=True)
    target_means = union(tms).checkpoint()
    tm_map = {r["dataset"]: r["target_mean"] for r in target_means.collect()}
    fold_metrics = union(fms).withColumn(
        "share_of_target_mean",
        F.when(F.col("metric").isin("rmse", "mae"),
               F.col("value") / F.element_at(F.create_map(*[x for k, v in tm_map.items()
                                                             for x in (F.lit(k), F.lit(v))]), F.col("dataset"))))
    fold_metrics = fold_metrics.checkpoint()
    quality = fold_metrics.filter(F.col("metric") != "fit_seconds")
    out = {
        "quality_counts": funnel,
        "target_means": target_means,
        "fold_metrics": fold_metrics,
        "importance": union(imps),
        "importance_summary": R.importance_summary(union(imps)),
        "ranking": R.model_ranking(quality, MS.MODEL_ORDER),
        "sensitivity": R.outlier_sensitivity(quality, target_means, MS.WITH, MS.WITHOUT),
    }
    if params:
        out["fold_params"] = union(params)
        out["candidate_scores"] = union(cands)
        best = R.best_candidate(union(cands))
        out["best_candidate"] = best
        out["best_params"] = R.best_params(union(cands), union(list(grids.values())))
        out["parameter_comparison"] = R.hyperparameter_comparison(out["best_params"], MS.WITH, MS.WITHOUT)
    out["document"] = IO.study_document({**out, "fold_metrics": quality})
    if out_path:
        IO.write_results({k: v for k, v in out.items() if k != "document"}, out_path)
        IO.write_document(out["document"], os.path.join(out_path, "document"))
    return out
