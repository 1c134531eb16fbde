"""Feature preparation (O-67..O-69)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def one_hot(df: DataFrame, col: str, levels: Sequence[str], drop_level: str | None = None,
            keep_source: bool = False) -> DataFrame:
    """O-67: one double column ``{col}_{level}`` per known level.

    ``drop_level`` removes one level (the linear model's reference level);
    it is explicit because "first seen" has no meaning on a cluster.
    """
    cols = {f"{col}_{v}": (F.col(col) == F.lit(v)).cast("double") for v in levels if v != drop_level}
    out = df.withColumns(cols)
    return out if keep_source else out.drop(col)


def dummy_names(col: str, levels: Sequence[str], drop_level: str | None = None) -> list[str]:
    return [f"{col}_{v}" for v in levels if v != drop_level]


def assemble(df: DataFrame, feature_cols: Sequence[str], out: str = "features") -> DataFrame:
    """O-68: feature vector + label, keeping the stratum and any other column."""
    return VectorAssembler(inputCols=list(feature_cols), outputCol=out, handleInvalid="error").transform(df)


def fit_standardizer(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """O-69 fit: mean and population std per column (one aggregate)."""
    row = df.agg(*[x for c in cols for x in (F.avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"s_{c}"))]).collect()[0]
    return {c: (row[f"m_{c}"], row[f"s_{c}"]) for c in cols}


def apply_standardizer(df: DataFrame, params: dict[str, tuple[float, float]]) -> DataFrame:
    """O-69 transform: (x - mean) / std; a zero std leaves the centred value 0."""
    exprs = {}
    for c, (m, s) in params.items():
        exprs[c] = (F.col(c) - F.lit(m)) / F.lit(s) if s else F.col(c) - F.lit(m)
    return df.withColumns(exprs)


def standardize_by_fold(df: DataFrame, cols: Sequence[str], fold: str) -> DataFrame:
    """O-69: each row scaled by mean and population std of the other folds, as the train part of its held-out fold gives them.

    One grouped aggregate of counts, means and squared deviations per fold; the statistics of the other folds are merged on the
    table of folds, which is joined back.
    """
    parts = df.groupBy(fold).agg(*[x for i, c in enumerate(cols) for x in (
        F.count(c).alias(f"_n{i}"), F.avg(c).alias(f"_m{i}"), (F.var_pop(c) * F.count(c)).alias(f"_q{i}"))])
    own, other = parts.select(F.col(fold).alias("_fold")), parts
    pairs = own.join(other, F.col("_fold") != F.col(fold))   # k rows to k - 1 rows each
    mean = lambda i: F.sum(F.col(f"_n{i}") * F.col(f"_m{i}")) / F.sum(f"_n{i}")
    means = pairs.groupBy("_fold").agg(*[mean(i).alias(f"_mean{i}") for i in range(len(cols))])
    spread = pairs.join(means, "_fold").groupBy("_fold", *[f"_mean{i}" for i in range(len(cols))]).agg(*[
        F.sqrt(F.sum(F.col(f"_q{i}") + F.col(f"_n{i}") * (F.col(f"_m{i}") - F.col(f"_mean{i}")) ** 2) / F.sum(f"_n{i}")).alias(f"_std{i}")
        for i in range(len(cols))])
    out = df.join(spread, F.col(fold) == F.col("_fold"))
    scaled = {c: (F.col(c) - F.col(f"_mean{i}")) / F.when(F.col(f"_std{i}") == 0, 1.0).otherwise(F.col(f"_std{i}")) for i, c in enumerate(cols)}
    return out.withColumns(scaled).drop("_fold", *[f"_{x}{i}" for i in range(len(cols)) for x in ("mean", "std")])
