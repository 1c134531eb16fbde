"""Ordered categories (O-02, O-26, O-27, O-40..O-43).

Spark has no enum type: an ordered category is a string column plus its
1-based rank in a declared domain, ``array_position(domain, value)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from .frames import literal_frame


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def category_rank(c: str | Column, domain: Sequence[str]) -> Column:
    """1-based position in the domain, 0 when absent, NULL for NULL."""
    return F.array_position(F.array(*[F.lit(v) for v in domain]), _col(c)).cast("int")


def enforce_domain(df: DataFrame, name: str, domain: Sequence[str]) -> DataFrame:
    """O-02: fail the job on a value outside the declared domain (NULL passes)."""
    col = F.col(name)
    checked = (F.when(col.isNull() | col.isin(list(domain)), col)
               .otherwise(F.raise_error(F.concat(
                   F.lit(f"value outside the domain of {name}: "), col))))
    return df.withColumn(name, checked)



def merge_levels(c: str | Column, levels: Sequence[str], into: str) -> Column:
    """O-26: map several levels onto one, keep the others (cast to string, O-27)."""
    col = _col(c)
    return F.when(col.isin(list(levels)), F.lit(into)).otherwise(col.cast("string"))


def level_counts_row(df: DataFrame, name: str, levels: Sequence[str]) -> DataFrame:
    """O-40: one row, one count column per level."""
    return df.agg(*[F.count_if(F.col(name) == F.lit(v)).alias(v) for v in levels])


def domain_frame(spark: SparkSession, name: str, domain: Sequence[str]) -> DataFrame:
    """The domain as a tiny DataFrame (value, rank); size is the domain size."""
    rows = [(v, i + 1) for i, v in enumerate(domain)]
    schema = T.StructType([T.StructField(name, T.StringType(), False),
                           T.StructField("rank", T.IntegerType(), False)])
    return literal_frame(spark, rows, schema)


def level_frequency(df: DataFrame, name: str, domain: Sequence[str]) -> DataFrame:
    """O-41 + O-42: count per level, zero-filled, in domain order.

    The counts are a partial aggregate (one row per level per task); the
    domain table is tiny and broadcast into the join.
    """
    spark = df.sparkSession
    counts = df.groupBy(name).agg(F.count(F.lit(1)).alias("n"))
    dom = domain_frame(spark, name, domain)
    return (F.broadcast(dom).join(counts, on=name, how="left")
            .select(name, "rank", F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n"))
            .orderBy("rank"))


def level_share(freq: DataFrame) -> DataFrame:
    """O-43: non-empty levels with their percent of the total (pie data)."""
    from pyspark.sql import Window
    total = F.sum("n").over(Window.partitionBy())
    return (freq.filter(F.col("n") > 0)
            .withColumn("share_pct", F.col("n") * F.lit(100.0) / total))
