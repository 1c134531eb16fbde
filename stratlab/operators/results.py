"""Results layer over long result tables (O-46, O-57, O-58, O-83..O-88, O-90..O-93, O-97).

Long tables, one row per fact:
  fold_metrics(dataset, model, fold, metric, value, share_of_target_mean)
  fold_params(dataset, model, fold, name, value)
  candidate_scores(dataset, model, outer_fold, candidate_idx, mean_r2)
  importance(dataset, model, fold, feature, importance)
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _rank_of(col: str, order: Sequence[str]):
    return F.array_position(F.array(*[F.lit(v) for v in order]), F.col(col))


def metric_means(fold_metrics: DataFrame) -> DataFrame:
    """O-46: mean of each metric over folds, per dataset and model."""
    return (fold_metrics.groupBy("dataset", "model", "metric")
            .agg(F.avg("value").alias("mean_value"), F.avg("share_of_target_mean").alias("mean_share")))


def model_ranking(fold_metrics: DataFrame, model_order: Sequence[str]) -> DataFrame:
    """O-85 + O-86: position 1..n of each model by mean R2 per dataset; ties by model order."""
    means = metric_means(fold_metrics).filter(F.col("metric") == "r2")
    w = Window.partitionBy("dataset").orderBy(F.col("mean_value").desc(), _rank_of("model", model_order))
    return means.select("dataset", "model", F.col("mean_value").alias("mean_r2"),
                        F.row_number().over(w).alias("position")).withColumn("is_best", F.col("position") == 1)


def outlier_sensitivity(fold_metrics: DataFrame, target_means: DataFrame, with_ds: str, without_ds: str) -> DataFrame:
    """O-87: per model and metric, both means, their difference and (not for R2)
    the difference of the values normalised by each dataset's target mean."""
    means = metric_means(fold_metrics).select("dataset", "model", "metric", "mean_value")
    p = (means.groupBy("model", "metric").pivot("dataset", [with_ds, without_ds]).agg(F.first("mean_value"))
         .withColumnsRenamed({with_ds: "with_value", without_ds: "without_value"}))
    tm = {r["dataset"]: r["target_mean"] for r in target_means.collect()}  # one row per dataset
    j = p.withColumns({"tm_with": F.lit(tm[with_ds]), "tm_without": F.lit(tm[without_ds])})
    return j.select("model", "metric", "with_value", "without_value",
                    (F.col("without_value") - F.col("with_value")).alias("difference"),
                    F.when(F.col("metric") != "r2",
                           F.col("without_value") / F.col("tm_without") - F.col("with_value") / F.col("tm_with"))
                    .alias("normalised_difference"))


def r2_bars(fold_metrics: DataFrame, model_order: Sequence[str], dataset_order: Sequence[str]) -> DataFrame:
    """O-57: mean R2 per model x dataset with explicit order ranks (O-97 long form)."""
    means = metric_means(fold_metrics).filter(F.col("metric") == "r2")
    return means.select("model", "dataset", F.col("mean_value").alias("mean_r2"),
                        _rank_of("model", model_order).cast("int").alias("model_rank"),
                        _rank_of("dataset", dataset_order).cast("int").alias("dataset_rank"))


def importance_summary(importance: DataFrame) -> DataFrame:
    """O-84: mean importance over folds, with its position per (dataset, model)."""
    m = importance.groupBy("dataset", "model", "feature").agg(F.avg("importance").alias("mean_importance"))
    w = Window.partitionBy("dataset", "model").orderBy(F.col("mean_importance").desc(), "feature")
    return m.withColumn("position", F.row_number().over(w))


def importance_order(importance: DataFrame) -> DataFrame:
    """O-58: features ordered by their mean importance across datasets, per model."""
    s = importance_summary(importance)
    a = s.groupBy("model", "feature").agg(F.avg("mean_importance").alias("across_datasets"))
    w = Window.partitionBy("model").orderBy(F.col("across_datasets").desc(), "feature")
    return a.withColumn("order", F.row_number().over(w))


def best_candidate(candidate_scores: DataFrame) -> DataFrame:
    """O-83: candidate with the best mean (over outer folds) of inner mean R2; first wins."""
    m = (candidate_scores.groupBy("dataset", "model", "candidate_idx")
         .agg(F.avg("mean_r2").alias("overall_mean_r2")))
    w = Window.partitionBy("dataset", "model").orderBy(F.round("overall_mean_r2", 9).desc(), "candidate_idx")
    return m.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


def best_params(candidate_scores: DataFrame, candidates: DataFrame) -> DataFrame:
    """O-83: the parameters (name, value) of the overall best candidate, per dataset and model.
    ``candidates`` names the parameters of each candidate_idx, per model (and dataset, where it has that column)."""
    keys = [c for c in ("dataset", "model", "candidate_idx") if c in candidates.columns]
    return best_candidate(candidate_scores).join(candidates, keys).select(
        "dataset", "model", "candidate_idx", "overall_mean_r2", "name", "value")


def hyperparameter_comparison(best_params: DataFrame, with_ds: str, without_ds: str) -> DataFrame:
    """O-88: best hyperparameters side by side with a null-safe equality flag."""
    a = best_params.filter(F.col("dataset") == with_ds).select("model", "name", F.col("value").alias("with_value"))
    b = best_params.filter(F.col("dataset") == without_ds).select("model", "name", F.col("value").alias("without_value"))
    return (a.join(b, ["model", "name"], "full_outer")
            .withColumn("equal", F.col("with_value").eqNullSafe(F.col("without_value"))))


# ------------------------------------------------------------------ O-90..O-97


def head(df: DataFrame, n: int, *order) -> DataFrame:
    """O-90: first n rows in an explicit order."""
    return df.orderBy(*order).limit(n)


def top_k(df: DataFrame, col: str, k: int = 20, *tiebreak: str) -> DataFrame:
    """O-91: k largest values."""
    return sort_desc(df, col, *tiebreak).limit(k)


def sort_desc(df: DataFrame, col: str, *tiebreak: str) -> DataFrame:
    """O-92: descending, nulls last."""
    return df.orderBy(F.col(col).desc_nulls_last(), *tiebreak)


def fixed_order_key(col: str, order: Sequence[str]):
    """O-93: position in a fixed list, unknown items after it (then by name)."""
    pos = F.array_position(F.array(*[F.lit(v) for v in order]), F.col(col)).cast("int")
    return F.when(pos > 0, pos).otherwise(F.lit(len(order) + 1))


def wide_to_long(df: DataFrame, ids: Sequence[str], values: Sequence[str],
                 var: str = "variable", val: str = "value") -> DataFrame:
    """O-97: unpivot."""
    return df.unpivot(list(ids), list(values), var, val)
