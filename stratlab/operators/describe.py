"""Descriptive statistics, outliers and quality counts (O-21..O-23, O-29..O-47).

``describe`` runs three aggregate jobs whatever the number of columns:
ranges (count/min/max), exact quartiles (see ``quantile``), and one final
aggregate with every statistic, outlier counts included, reshaped into a
long ``(statistic, column, value)`` table by ``stack``. The last job stays
lazy: it is returned as a DataFrame.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.columns import clean_numeric, numeric_columns
from . import quantile as Q

TUKEY_FACTOR = 1.5  # fixed value: Tukey fence multiplier

# Statistic names, in the order the statistics are produced.
STATISTICS = ["count", "mean", "q1", "median", "q3", "iqr", "std",
              "max", "min", "range", "outliers", "outliers_pct"]


def _dlit(x: float | None) -> Column:
    return F.lit(x).cast("double")


def quartiles(df: DataFrame, cols: Sequence[str], ranges=None) -> dict[str, tuple]:
    """O-33/O-34: nearest-rank (Q1, Q3, IQR) per column, from one ranges job and one rank job."""
    clean = clean_numeric(df.select(*cols), cols)
    qs = Q.quantiles(clean, cols, [0.25, 0.75], "nearest", ranges=ranges)
    out = {}
    for c in cols:
        q1, q3 = qs[(c, 0.25)], qs[(c, 0.75)]
        out[c] = (q1, q3, None if q1 is None else q3 - q1)
    return out


def fences(df: DataFrame, cols: Sequence[str], factor: float = TUKEY_FACTOR) -> dict[str, tuple]:
    """O-21: (low, high) Tukey fences per column, whole-table quartiles."""
    out = {}
    for c, (q1, q3, iqr) in quartiles(df, cols).items():
        out[c] = (None, None) if q1 is None else (q1 - factor * iqr, q3 + factor * iqr)
    return out


def outlier_predicate(c: str, fence: tuple) -> Column:
    """O-21: ``x < low or x > high`` with the fences as literals (NULL-safe: NULL stays NULL)."""
    lo, hi = fence
    x = F.col(c)
    return (x < _dlit(lo)) | (x > _dlit(hi))


def any_outlier_predicate(fence_by_col: dict[str, tuple]) -> Column:
    """O-22: outlier in any of the columns."""
    terms = [outlier_predicate(c, f) for c, f in fence_by_col.items()]
    return functools.reduce(operator.or_, terms)


def drop_outlier_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """O-22: keep rows that are known to be an outlier in none of ``cols`` (a row whose test is NULL goes, N14).

    All fences come from the same, unfiltered table.
    """
    pred = any_outlier_predicate(fences(df, cols))
    return df.filter(~pred)


def describe(df: DataFrame, cols: Sequence[str] | None = None, exclude: Iterable[str] = (),
             ranges=None, approx: bool = False, accuracy: int = 10_000) -> DataFrame:
    """O-39: the twelve statistics of every numeric column, long form.

    Columns: ``statistic`` (see STATISTICS), ``column``, ``value`` (double).
    Nulls are skipped, NaN counts as missing (N3, N12); an all-null column
    gives NULL statistics and 0 outliers with a NULL share (N4, N5).
    ``approx=True`` takes quartiles and median from one ``percentile_approx``
    job (rank error at most n / ``accuracy``) instead of the exact search.
    """
    cols = list(cols) if cols is not None else numeric_columns(df, exclude)
    clean = clean_numeric(df.select(*cols), cols)
    clean = clean.withColumns({c: F.col(c).cast("double") for c in cols})
    if approx:
        aq = Q.approx_quantiles(clean, cols, [0.25, 0.5, 0.75], accuracy)
        qs = {(c, q): aq[(c, q)] for c in cols for q in (0.25, 0.75)}
        med = {(c, 0.5): aq[(c, 0.5)] for c in cols}
    else:
        if ranges is None:
            ranges = Q.column_ranges(clean, cols)
        qset = Q.quantile_set(clean, cols, [(0.25, "nearest"), (0.75, "nearest"), (0.5, "linear")], ranges=ranges)
        qs = {(c, q): qset[(c, q, "nearest")] for c in cols for q in (0.25, 0.75)}
        med = {(c, 0.5): qset[(c, 0.5, "linear")] for c in cols}

    aggs: list[Column] = []
    for i, c in enumerate(cols):
        x = F.col(c)
        q1, q3 = qs[(c, 0.25)], qs[(c, 0.75)]
        iqr = None if q1 is None else q3 - q1
        lo = None if q1 is None else q1 - TUKEY_FACTOR * iqr
        hi = None if q1 is None else q3 + TUKEY_FACTOR * iqr
        n_out = F.count_if((x < _dlit(lo)) | (x > _dlit(hi)))
        aggs += [
            F.count(x).cast("double").alias(f"count_{i}"),
            F.avg(x).alias(f"mean_{i}"),
            _dlit(q1).alias(f"q1_{i}"),
            _dlit(med[(c, 0.5)]).alias(f"median_{i}"),
            _dlit(q3).alias(f"q3_{i}"),
            _dlit(iqr).alias(f"iqr_{i}"),
            F.stddev_samp(x).alias(f"std_{i}"),
            F.max(x).alias(f"max_{i}"),
            F.min(x).alias(f"min_{i}"),
            (F.max(x) - F.min(x)).alias(f"range_{i}"),
            n_out.cast("double").alias(f"outliers_{i}"),
            F.try_divide(n_out * F.lit(100.0), F.count(x)).alias(f"outliers_pct_{i}"),
        ]
    wide = clean.agg(*aggs)
    pairs = []
    for i, c in enumerate(cols):
        for s in STATISTICS:
            pairs.append(f"'{s}', '{c}', `{s}_{i}`")
    stack = f"stack({len(pairs)}, {', '.join(pairs)}) as (statistic, column, value)"
    return wide.selectExpr(stack)


def describe_with_strings(df: DataFrame, cols: Sequence[str] | None = None, **options) -> DataFrame:
    """O-39 for all columns: (statistic, column, value, text). String columns have a count (``value``), the least
    and the greatest string (``text``); their other statistics are NULL. Numeric columns as in ``describe``."""
    cols = list(cols) if cols is not None else df.columns
    kinds = {f.name: f.dataType for f in df.schema.fields}
    strings = [c for c in cols if isinstance(kinds[c], StringType)]
    numbers = [c for c in cols if c not in strings]
    out = describe(df, numbers, **options).withColumn("text", F.lit(None).cast("string")) if numbers else None
    if strings:
        wide = df.agg(*[x for i, c in enumerate(strings) for x in (
            F.count(c).cast("double").alias(f"count_{i}"), F.min(c).alias(f"min_{i}"), F.max(c).alias(f"max_{i}"))])
        cells = [(s, c, f"count_{i}" if s == "count" else "CAST(NULL AS DOUBLE)", f"{s}_{i}" if s in ("min", "max") else "CAST(NULL AS STRING)")
                 for i, c in enumerate(strings) for s in STATISTICS]
        rows = ", ".join(f"'{s}', '{c}', {v}, {t}" for s, c, v, t in cells)
        long = wide.selectExpr(f"stack({len(cells)}, {rows}) as (statistic, column, value, text)")
        out = long if out is None else out.unionByName(long)
    return out


def describe_wide(long: DataFrame, cols: Sequence[str], key: str = "statistic") -> DataFrame:
    """One row per statistic, one column per input column (the per-statistic table shape)."""
    return (long.groupBy(key).pivot("column", list(cols)).agg(F.first("value"))
            .select(key, *cols))


def quality_counts(df: DataFrame, outlier_cols: Sequence[str]) -> DataFrame:
    """O-23: one job for the data-quality funnel.

    total rows, bad rows (null/NaN anywhere), used rows, outlier rows among
    used rows (fences from the used rows), and their share.
    """
    from ..functions.columns import bad_row_predicate
    bad = bad_row_predicate(df)
    used = df.filter(~bad)
    f = fences(used, outlier_cols)
    out = F.coalesce(any_outlier_predicate(f), F.lit(False))
    return (df.agg(F.count(F.lit(1)).alias("total"),
                   F.count_if(bad).alias("bad"),
                   F.count_if(~bad & out).alias("outliers"))
            .select("total", "bad", (F.col("total") - F.col("bad")).alias("used"), "outliers",
                    F.try_divide(F.col("outliers").cast("double"),
                                 (F.col("total") - F.col("bad")).cast("double")).alias("outlier_share")))


def target_summary(df: DataFrame, target: str) -> DataFrame:
    """O-45 (and O-30/O-35 on one column): min, mean, max of the target."""
    x = F.col(target)
    return df.agg(F.min(x).alias("minimum"), F.avg(x).alias("mean"), F.max(x).alias("maximum"),
                  F.count(x).alias("rows"))


def group_sizes(df: DataFrame, label: str) -> DataFrame:
    """O-47: distinct labels and their sizes."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
