"""Sources and sinks (O-01..O-09).

Reads always carry an explicit schema (no inference at scale); writes go
through Spark's committers (task output is renamed into place only on job
commit), so a lost executor never leaves a half-written table behind.
"""

from __future__ import annotations

import json
import os
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.categories import enforce_domain
from ..functions.frames import literal_frame

# File-name prefix -> group of the three statistics tables, longest match first.
STATS_GROUPS = {"null_or_nan_": "null_or_nan", "derived_": "derived", "": "raw"}
STATS_FILE_STEM = "stats_"


# ------------------------------------------------------------------ O-01/O-02


def read_table(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "csv",
               category: tuple[str, Sequence[str]] | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """O-01 (+ O-02): typed scan of CSV (header) or Parquet; optional ordered-category guard.

    CSV is read FAILFAST, so a malformed number fails the job; an unknown
    category fails it too (``enforce_domain``). ``columns`` prunes the scan.
    """
    if fmt == "csv":
        df = (spark.read.schema(schema).option("header", True).option("mode", "FAILFAST")
              .option("nanValue", "NaN").csv(path))
    elif fmt == "parquet":
        df = spark.read.schema(schema).parquet(path)
    else:
        raise ValueError(f"unsupported format {fmt!r}")
    if columns:
        df = df.select(*columns)
    if category:
        df = enforce_domain(df, category[0], category[1])
    return df


# ------------------------------------------------------------------ O-03


def write_table_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """O-03: CSV with header (overwrite). ``single_file`` coalesces to one part
    file; use it only for small report tables."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Parquet sink, the primary format (overwrite)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


# ------------------------------------------------------------------ O-04..O-06


STATS_SCHEMA = T.StructType([
    T.StructField("prefix", T.StringType()),
    T.StructField("statistic", T.StringType()),
    T.StructField("column", T.StringType()),
    T.StructField("value", T.DoubleType()),
])


def write_stats(long: DataFrame, path: str, prefix: str) -> None:
    """O-04: statistics rows as JSON lines, one directory per group
    (``prefix=<group>/``); a rewrite replaces only that group's directory."""
    (long.withColumn("prefix", F.lit(prefix)).select("prefix", "statistic", "column", "value")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("prefix").json(path))


def read_stats(spark: SparkSession, path: str) -> DataFrame:
    """O-05: read statistics rows back, with the file they came from, and check
    that each (prefix, statistic, column) occurs exactly once."""
    schema = "statistic string, column string, value double, prefix string"
    return spark.read.schema(schema).json(path).withColumn("source_file", F.input_file_name())


def write_stat_files(long: DataFrame, path: str, prefix: str = "") -> None:
    """O-04: one wide JSON row per statistic, below ``path/file=<prefix>stats_<statistic>.json``. A rewrite replaces the files of
    these names only. Statistics without a value are left out of the row."""
    columns = [r[0] for r in long.groupBy("column").agg(F.min("place").alias("p")).orderBy("p").select("column").collect()] \
        if "place" in long.columns else sorted(r[0] for r in long.select("column").distinct().collect())   # column names only
    wide = long.groupBy("statistic").pivot("column", columns).agg(F.first("value"))
    (wide.select(F.concat(F.lit(prefix + STATS_FILE_STEM), "statistic", F.lit(".json")).alias("file"), *columns)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("file").json(path))


def read_stat_files(spark: SparkSession, path: str) -> DataFrame:
    """O-05 + O-06 + O-94: (group, file, statistic, columns...) of all statistics files below ``path``, one row each.

    Files may have different columns: the result has all of them, in the order in which they are first seen (raw, then null
    or NaN, then derived files by name). A file with more than one row raises TypeError; a file whose name does not follow the pattern
    has a NULL group.
    """
    raw = spark.read.text(path).select("value", F.regexp_extract(F.col("_metadata.file_path"), r"([^/=]*\.json)/[^/]*$", 1).alias("file"))
    rows = raw.select(stats_group(F.col("file")).alias("group"), "file",
                      F.regexp_extract("file", STATS_FILE_STEM + r"(.*)\.json$", 1).alias("statistic"),
                      F.from_json("value", "map<string,double>").alias("cells")).checkpoint()
    check_one_row_per_key(rows, ["file"])
    order = F.array_position(F.array(*[F.lit(g) for g in ("raw", "null_or_nan", "derived")]), F.col("group"))
    seen = rows.select(order.alias("o"), "file", F.posexplode(F.map_keys("cells")).alias("at", "column")) \
        .groupBy("column").agg(F.min(F.struct("o", "file", "at")).alias("first")).orderBy("first").select("column").collect()   # names only
    return rows.select("group", "file", "statistic", *[F.col("cells")[r["column"]].alias(r["column"]) for r in seen])


def check_one_row_per_key(df: DataFrame, keys: Sequence[str]) -> None:
    """Shape check: fail if a key occurs more than once (aggregate, nothing collected but offenders)."""
    dup = df.groupBy(*keys).count().filter("count > 1").limit(5).collect()
    if dup:
        raise TypeError(f"expected one row per {list(keys)}, found duplicates: {dup}")


def stats_group(path_col: Column) -> Column:
    """O-06: group of a statistics file by the longest matching name prefix,
    NULL when the name does not follow the pattern."""
    name = F.regexp_extract(path_col, r"([^/]*)$", 1)
    expr = None
    for p, group in sorted(STATS_GROUPS.items(), key=lambda kv: -len(kv[0])):
        cond = name.startswith(F.lit(p + STATS_FILE_STEM))
        expr = F.when(cond, F.lit(group)) if expr is None else expr.when(cond, F.lit(group))
    return expr


# ------------------------------------------------------------------ O-07/O-08


def check_no_nan(df: DataFrame, cols: Sequence[str]) -> None:
    """O-07 guard: the results document may not hold NaN or infinity."""
    floats = [c for c in cols if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType))]
    if not floats:
        return
    bad = df.filter(F.exists(F.array(*[F.col(c) for c in floats]),
                             lambda x: F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))).limit(1).collect()
    if bad:
        raise ValueError(f"non-finite value in results: {bad[0]}")


def write_results(tables: dict[str, DataFrame], path: str) -> None:
    """O-07: each long result table as JSON lines under ``path/<name>``, after the
    NaN check. Spark's commit protocol gives the tmp + rename replacement."""
    for name, df in tables.items():
        check_no_nan(df, df.columns)
        df.write.mode("overwrite").json(os.path.join(path, name))


def read_results(spark: SparkSession, path: str, name: str, schema: T.StructType | str) -> DataFrame:
    """O-08: one result table back, typed."""
    return spark.read.schema(schema).json(os.path.join(path, name))


def results_document(fold_metrics: DataFrame) -> DataFrame:
    """O-07 (nested shape): dataset -> model -> metric -> [per-fold values] and mean,
    built with ``collect_list`` per (dataset, model) — bounded by the fold count."""
    per = (fold_metrics.groupBy("dataset", "model", "metric")
           .agg(F.sort_array(F.collect_list(F.struct("fold", "value"))).alias("folds"),
                F.avg("value").alias("mean")))
    per_model = per.groupBy("dataset", "model").agg(
        F.map_from_entries(F.collect_list(F.struct("metric", F.struct("folds", "mean")))).alias("metrics"))
    return per_model.groupBy("dataset").agg(
        F.map_from_entries(F.collect_list(F.struct("model", "metrics"))).alias("models"))


def study_document(tables: dict[str, DataFrame]) -> DataFrame:
    """O-07: one nested row per dataset from the result tables of a study.

    Sections, each present if its table is: ``counts`` (quality_counts, the same for all), ``target`` (target_means), ``models``
    (fold_metrics: folds and means), ``importance`` (importance_summary: model -> features in order), ``parameters`` (best_params:
    model -> name -> value), ``ranking`` and ``comparison`` (sensitivity, parameter_comparison). Everything collected is bounded by models,
    folds and features, not by rows.
    """
    out = results_document(tables["fold_metrics"])
    entries = lambda key, value: F.map_from_entries(F.collect_list(F.struct(key, value)))
    if "target_means" in tables:
        out = out.join(tables["target_means"].select("dataset", F.struct(*[c for c in tables["target_means"].columns if c != "dataset"]).alias("target")),
                       "dataset", "left")
    if "importance_summary" in tables:
        one = tables["importance_summary"].groupBy("dataset", "model").agg(
            F.array_sort(F.collect_list(F.struct("position", "feature", "mean_importance"))).alias("features"))
        out = out.join(one.groupBy("dataset").agg(entries("model", "features").alias("importance")), "dataset", "left")
    if "best_params" in tables:
        one = tables["best_params"].groupBy("dataset", "model").agg(entries("name", "value").alias("values"))
        out = out.join(one.groupBy("dataset").agg(entries("model", "values").alias("parameters")), "dataset", "left")
    if "ranking" in tables:
        out = out.join(tables["ranking"].groupBy("dataset").agg(
            F.array_sort(F.collect_list(F.struct("position", "model", "mean_r2"))).alias("ranking")), "dataset", "left")
    whole = {"counts": "quality_counts", "sensitivity": "sensitivity", "parameter_comparison": "parameter_comparison"}
    for section, name in whole.items():
        if name in tables:   # one array for all datasets
            t = tables[name]
            out = out.join(t.agg(F.array_sort(F.collect_list(F.struct(*t.columns))).alias(section)), F.lit(True), "left")
    return out


def write_document(doc: DataFrame, path: str) -> None:
    """O-07: the document as JSON lines, one dataset each."""
    doc.write.mode("overwrite").json(path)


def read_document(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """O-08: the document back, typed."""
    return spark.read.schema(schema).json(path)


# ------------------------------------------------------------------ O-09


def save_models(models: dict[int, object], path: str, dataset: str, model_name: str,
                features: Sequence[str], spark: SparkSession) -> DataFrame:
    """O-09: persist the fitted model of every fold (MLlib writer, overwrite) and
    return a metadata table (dataset, model, fold, path, features)."""
    rows = []
    for fold, m in sorted(models.items()):
        p = os.path.join(path, f"{dataset}_{model_name}", f"fold={fold}")
        m.write().overwrite().save(p)
        rows.append((dataset, model_name, int(fold), p, list(features)))
    meta = literal_frame(spark, rows, "dataset string, model string, fold int, path string, features array<string>")
    meta.write.mode("overwrite").json(os.path.join(path, f"{dataset}_{model_name}", "_metadata"))
    return meta


def save_linear(fits, path: str, dataset: str, model_name: str, spark: SparkSession) -> DataFrame:
    """O-09 for a moment-fitted linear model (``models.LinearCV``): one row a fold (overwrite)."""
    rows = [(dataset, model_name, int(k), list(fits.features), float(fits.intercepts[k]), [float(x) for x in fits.coefs[k]],
             [float(x) for x in fits.std_coefs[k]]) for k in sorted(fits.intercepts)]
    table = literal_frame(spark, rows, LINEAR_SCHEMA)
    table.write.mode("overwrite").parquet(os.path.join(path, f"{dataset}_{model_name}"))
    return table


LINEAR_SCHEMA = ("dataset string, model string, fold int, features array<string>, intercept double, coefficients array<double>, "
                 "standardized array<double>")


def load_linear(spark: SparkSession, path: str, dataset: str, model_name: str):
    """The model that ``save_linear`` wrote; it predicts as the one saved."""
    from ..operators.models import LinearCV

    rows = spark.read.schema(LINEAR_SCHEMA).parquet(os.path.join(path, f"{dataset}_{model_name}")).collect()   # one row a fold
    out = LinearCV(list(rows[0]["features"]) if rows else [])
    for r in rows:
        out.intercepts[r["fold"]] = r["intercept"]
        out.coefs[r["fold"]], out.std_coefs[r["fold"]] = np.array(r["coefficients"]), np.array(r["standardized"])
    return out
