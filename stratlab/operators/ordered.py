"""Order-dependent helpers that never put the whole table in one task.

A window without ``PARTITION BY`` runs in a single task. Instead, rows are range-partitioned
on the order columns (Spark samples the borders itself) and written once; the partition number is a bucket that grows
with the order. Windows run per bucket, and what crosses the borders (running totals, neighbouring
values) comes by a join with a table of one row per bucket. That table is scanned in two levels as well:
inside groups of ``SUPER`` buckets, then over one row per group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

ROWS_PER_BUCKET = 500_000
SUPER = 1024


def range_buckets(df: DataFrame, order: str | Sequence[str], buckets: int | None = None, out: str = "_bucket",
                  rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Add an int bucket id, growing with the ``order`` columns (NULLs excluded upstream); equal keys share a bucket.

    The result is written (checkpoint), so the ids stay what they are. Without ``buckets`` there is one for each
    ``rows_per_bucket`` rows, and at least one for each core.
    """
    order = [order] if isinstance(order, str) else list(order)
    ensure_checkpoint_dir(df.sparkSession)
    if buckets is None:
        df = df.checkpoint()   # counted, then dealt out: computed once
        buckets = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // rows_per_bucket))
    return df.repartitionByRange(max(1, buckets), *order).withColumn(out, F.spark_partition_id()).checkpoint()


def before_buckets(totals: DataFrame, sums: dict[str, str], bucket: str = "_bucket") -> DataFrame:
    """For one row per bucket: (bucket, for each new name the sum of a column over all earlier buckets)."""
    t = totals.withColumn("_super", F.floor(F.col(bucket) / SUPER))
    inside = Window.partitionBy("_super").orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    over = Window.orderBy("_super").rowsBetween(Window.unboundedPreceding, -1)   # one row per SUPER buckets
    groups = t.groupBy("_super").agg(*[F.sum(c).alias(f"_g{i}") for i, c in enumerate(sums.values())])
    groups = groups.select("_super", *[F.sum(f"_g{i}").over(over).alias(f"_o{i}") for i in range(len(sums))])
    zero = F.lit(0)
    return t.join(groups, "_super").select(bucket, *[
        (F.coalesce(F.col(f"_o{i}"), zero) + F.coalesce(F.sum(c).over(inside), zero)).alias(name)
        for i, (name, c) in enumerate(sums.items())])


def beside_buckets(edges: DataFrame, first: str, last: str, before: str, after: str, bucket: str = "_bucket",
                   keys: Sequence[str] = ()) -> DataFrame:
    """For one row per bucket: (keys, bucket, ``last`` of the bucket before, ``first`` of the one after)."""
    e = edges.withColumn("_super", F.floor(F.col(bucket) / SUPER))
    inside = Window.partitionBy(*keys, "_super").orderBy(bucket)
    over = Window.partitionBy(*keys).orderBy("_super")   # one row per SUPER buckets
    groups = e.groupBy(*keys, "_super").agg(F.min_by(first, bucket).alias("_f"), F.max_by(last, bucket).alias("_l"))
    groups = groups.select(*keys, "_super", F.lag("_l").over(over).alias("_before"), F.lead("_f").over(over).alias("_after"))
    return e.join(groups, [*keys, "_super"]).select(
        *keys, bucket, F.coalesce(F.lag(last).over(inside), F.col("_before")).alias(before),
        F.coalesce(F.lead(first).over(inside), F.col("_after")).alias(after))


def running_sum(df: DataFrame, order_col: str, weight_col: str | list[str], out: str | list[str] = "cum",
                buckets: int | None = None, tiebreak: list[str] | None = None) -> DataFrame:
    """Inclusive running sum(s) of ``weight_col`` in ``order_col`` order, over the whole table.

    Several weight columns share one bucketing and one window pass. Rows must
    be unique on (order_col, *tiebreak) for a deterministic result.
    """
    weights = [weight_col] if isinstance(weight_col, str) else list(weight_col)
    outs = [out] if isinstance(out, str) else list(out)
    order = [order_col, *(tiebreak or [])]
    b = range_buckets(df, order, buckets)
    totals = b.groupBy("_bucket").agg(*[F.sum(w).alias(f"_tot{i}") for i, w in enumerate(weights)])
    offsets = before_buckets(totals, {f"_off{i}": f"_tot{i}" for i in range(len(weights))})
    w = Window.partitionBy("_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    res = b.join(offsets, "_bucket")
    res = res.withColumns({o: F.col(f"_off{i}") + F.sum(wc).over(w) for i, (wc, o) in enumerate(zip(weights, outs))})
    return res.drop("_bucket", *[f"_off{i}" for i in range(len(weights))])


def with_neighbours(df: DataFrame, order_col: str, buckets: int | None = None,
                    prev: str = "prev_value", nxt: str = "next_value") -> DataFrame:
    """Previous and next value of ``order_col`` over the whole table (values must be distinct)."""
    b = range_buckets(df, order_col, buckets)
    edges = b.groupBy("_bucket").agg(F.min(order_col).alias("_lo"), F.max(order_col).alias("_hi"))
    edges = beside_buckets(edges, "_lo", "_hi", "_prev_hi", "_next_lo")
    w = Window.partitionBy("_bucket").orderBy(order_col)
    return (b.join(edges, "_bucket")
            .withColumn(prev, F.coalesce(F.lag(order_col).over(w), F.col("_prev_hi")))
            .withColumn(nxt, F.coalesce(F.lead(order_col).over(w), F.col("_next_lo")))
            .drop("_bucket", "_prev_hi", "_next_lo"))
