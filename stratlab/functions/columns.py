"""Column selectors, predicates and derived columns (O-10..O-28, O-55, O-95, O-96).

All helpers return ``Column`` expressions or DataFrames built from built-in
functions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

import functools
import math
import operator
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------- selectors


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """O-12: names of numeric columns (ints and floats), schema order."""
    skip = set(exclude)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def float_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """O-12: names of floating point columns (the only ones that can hold NaN)."""
    skip = set(exclude)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, (T.DoubleType, T.FloatType)) and f.name not in skip]


def select_numeric(df: DataFrame, exclude: Iterable[str] = ()) -> DataFrame:
    """O-12 + O-11: keep numeric columns, minus an exclusion list."""
    return df.select(*numeric_columns(df, exclude))



def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """O-13."""
    return df.withColumnsRenamed(mapping)


def suffix_columns(cols: Iterable[str], suffix: str, fn=None) -> list[Column]:
    """O-14: ``fn(col)`` aliased with a suffix, one expression per column."""
    fn = fn or F.col
    return [fn(c).alias(f"{c}{suffix}") for c in cols]


def with_constant(df: DataFrame, name: str, value) -> DataFrame:
    """O-15."""
    return df.withColumn(name, F.lit(value))


# ---------------------------------------------------------------- predicates


def nan_to_null(c: str | Column) -> Column:
    """N12: NaN is ignored by statistics, so treat it as missing."""
    col = F.col(c) if isinstance(c, str) else c
    return F.when(~F.isnan(col), col)


def clean_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Replace NaN by NULL in floating columns (others are untouched)."""
    floats = set(float_columns(df))
    return df.withColumns({c: nan_to_null(c) for c in cols if c in floats})


def bad_row_predicate(df: DataFrame) -> Column:
    """O-17 / N1: any column null, or any floating column NaN.

    ``isnan(NULL)`` is false in Spark, so the disjunction is never NULL.
    """
    terms = [F.col(c).isNull() for c in df.columns]
    terms += [F.isnan(F.col(c)) for c in float_columns(df)]
    if not terms:
        return F.lit(False)
    return functools.reduce(operator.or_, terms)


def keep_bad_rows(df: DataFrame) -> DataFrame:
    """O-17: rows with at least one null or NaN."""
    return df.filter(bad_row_predicate(df))


def keep_complete_rows(df: DataFrame, nulls_only: bool = False) -> DataFrame:
    """O-18: complement of O-17 (``na.drop`` drops null and NaN alike).

    ``nulls_only`` keeps NaN rows, like dropping nulls alone.
    """
    if nulls_only:
        return df.filter(functools.reduce(operator.and_,
                                          [F.col(c).isNotNull() for c in df.columns]))
    return df.na.drop(how="any")


def is_in(c: str | Column, values: Sequence) -> Column:
    """O-19."""
    col = F.col(c) if isinstance(c, str) else c
    return col.isin(list(values))


def equals(c: str | Column, value) -> Column:
    """O-20."""
    col = F.col(c) if isinstance(c, str) else c
    return col == F.lit(value)


# ---------------------------------------------------------------- arithmetic


def ratio(num: str | Column, den: str | Column) -> Column:
    """O-24: ``num / den`` that is NULL for a zero or NULL denominator (N5, N6)."""
    n = F.col(num) if isinstance(num, str) else num
    d = F.col(den) if isinstance(den, str) else den
    return F.try_divide(n, d)


def natural_log(c: str | Column) -> Column:
    """O-25: ``ln`` (NULL for x <= 0, N7)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.ln(col)


def log_columns(cols: Sequence[str], suffix: str = "_ln") -> list[Column]:
    """O-25 + O-14."""
    return suffix_columns(cols, suffix, natural_log)


def abs_value(c: str | Column) -> Column:
    """O-28."""
    col = F.col(c) if isinstance(c, str) else c
    return F.abs(col)


def negate(c: str | Column) -> Column:
    """O-28."""
    col = F.col(c) if isinstance(c, str) else c
    return -col


def round_half_away(c: str | Column, places: int) -> Column:
    """Round to ``places`` decimals as ``round(x * 10^p) / 10^p``.

    Used for report and comparison columns: scaling first makes the half-way
    rule identical across engines.
    """
    col = F.col(c) if isinstance(c, str) else c
    scale = float(10 ** places)
    return F.round(col * F.lit(scale), 0) / F.lit(scale)


# ---------------------------------------------------------------- projection

EARTH_RADIUS_M = 6378137.0  # fixed value: Web Mercator sphere radius (EPSG:3857)


def web_mercator(lon: str | Column, lat: str | Column) -> tuple[Column, Column]:
    """O-55: EPSG:4326 degrees to EPSG:3857 metres."""
    lo = F.col(lon) if isinstance(lon, str) else lon
    la = F.col(lat) if isinstance(lat, str) else lat
    x = F.lit(EARTH_RADIUS_M) * F.radians(lo)
    y = F.lit(EARTH_RADIUS_M) * F.ln(F.tan(F.lit(math.pi / 4) + F.radians(la) / 2))
    return x.alias("x_m"), y.alias("y_m")


# ---------------------------------------------------------------- report text


def humanize_columns(df: DataFrame) -> DataFrame:
    """O-95: ``_`` to space in all column names."""
    return df.withColumnsRenamed({c: c.replace("_", " ") for c in df.columns})


def display_number(c: str | Column, integral: Column | bool = False) -> Column:
    """O-96: numeric cell as report text.

    NULL/NaN -> ``--``; an integer quantity (``integral``: counts) -> no
    decimals; integral and |x| >= 100 -> no decimals; |x| >= 100 -> two
    decimals; |x| >= 1 -> three; otherwise four (thresholds: fixed values). Ties of the
    decimal text round to even. Thousands separated by a
    thin space as in the report tables.
    """
    col = (F.col(c) if isinstance(c, str) else c).cast("double")
    a = F.abs(col)
    thousands = lambda s: F.regexp_replace(s, ",", "\\\\,")
    is_int = integral if isinstance(integral, Column) else F.lit(bool(integral))
    return (F.when(col.isNull() | F.isnan(col), F.lit("--"))
            .when(is_int, thousands(F.format_number(col, 0)))
            .when((col == F.floor(col)) & (a >= 100), thousands(F.format_number(col, 0)))
            .when(a >= 100, thousands(F.format_number(col, 2)))
            .when(a >= 1, F.format_number(col, 3))
            .otherwise(F.format_number(col, 4)))
