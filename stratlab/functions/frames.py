"""Small literal tables and literal arrays built on the JVM side.

``createDataFrame(list)`` plans a Python-backed RDD scan, and building a
literal with one ``F.lit`` per value costs one JVM round trip per value. A
table of a few hundred driver-side values (a domain, bin specs, fold
coefficients, halo rows, cluster tables) is instead rendered as Spark SQL
literal text and parsed once: ``inline(array(named_struct(...)))`` over a
one-row range, which stays inside whole-stage codegen.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def sql_literal(value, dtype: T.DataType) -> str:
    """Spark SQL text of ``value`` typed as ``dtype``."""
    if value is None:
        return f"CAST(NULL AS {dtype.simpleString()})"
    if isinstance(dtype, T.StructType):
        parts = ", ".join(f"'{f.name}', {sql_literal(v, f.dataType)}" for v, f in zip(value, dtype.fields))
        return f"named_struct({parts})"
    if isinstance(dtype, T.ArrayType):
        if not value:
            return f"CAST(array() AS {dtype.simpleString()})"
        return "array(" + ", ".join(sql_literal(v, dtype.elementType) for v in value) + ")"
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        v = float(value)
        if math.isnan(v):
            return "CAST('NaN' AS DOUBLE)"
        if math.isinf(v):
            return f"CAST('{'-' if v < 0 else ''}Infinity' AS DOUBLE)"
        return f"CAST({v!r}D AS {dtype.simpleString()})" if isinstance(dtype, T.FloatType) else f"{v!r}D"
    if isinstance(dtype, T.StringType):
        s = str(value).replace("\\", "\\\\").replace("'", "\\'")
        return f"'{s}'"
    if isinstance(dtype, T.BooleanType):
        return "true" if value else "false"
    if isinstance(dtype, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)):
        return f"CAST({int(value)} AS {dtype.simpleString()})"
    return f"CAST('{value}' AS {dtype.simpleString()})"


def double_array(values: Sequence) -> Column:
    """array<double> literal (None allowed) in one JVM call."""
    return F.expr(sql_literal(list(values), T.ArrayType(T.DoubleType())))


def double_matrix(rows: Sequence[Sequence]) -> Column:
    """array<array<double>> literal in one JVM call."""
    return F.expr(sql_literal([list(r) for r in rows], T.ArrayType(T.ArrayType(T.DoubleType()))))


def literal_frame(spark: SparkSession, rows: Sequence[Sequence], schema: str | T.StructType) -> DataFrame:
    """A DataFrame of ``rows`` (small, driver-side) with the given schema."""
    st = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
    if not rows:
        return spark.createDataFrame([], st)
    arr = sql_literal([tuple(r) for r in rows], T.ArrayType(st))
    return spark.range(1).selectExpr(f"inline({arr})")
