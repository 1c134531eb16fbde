"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratlab.session import ensure_checkpoint_dir


#: Rows of an Arrow batch that are Python objects at once.
SLICE_ROWS = 1_024


def worker_cache(owner: str, name: str, make: Callable[[], object]):
    """A value kept by a Python worker over all its tasks, until another owner keeps one there.

    Functions of this library travel to the executors by value, so their module
    globals do not outlive a task; a registered module object does. A worker serves one operator after
    the other, so it holds what one owner (a model or a file) needs, not what all before it needed.
    """
    values = free_worker_cache(owner)
    if name not in values:
        values[name] = make()
    return values[name]


def free_worker_cache(owner: str) -> dict:
    """Drops what other owners keep in a Python worker; an operator that keeps nothing there calls it before it takes memory."""
    holder = sys.modules.setdefault("stratlab_worker_cache", types.ModuleType("stratlab_worker_cache"))
    if getattr(holder, "owner", None) != owner:
        holder.owner, holder.values = owner, {}
        pa.default_memory_pool().release_unused()
    return holder.values


def thin_by_hash(df: DataFrame, hash_column: str, rows: int, limit: int) -> DataFrame:
    """Rows of ``df`` (about ``rows``) whose hash falls in a share that holds some three times ``limit`` of
    them; a top-k by hash of the result then moves few rows however many partitions there are."""
    if rows <= 4 * limit:
        return df
    span = 1 << 40
    return df.where(F.pmod(F.col(hash_column), F.lit(span)) < int(span * 3 * limit / rows))


class Scratch:
    """Written intermediate tables in the shared folder of ``spark.checkpoint.dir``.

    A written table cuts lineage and survives the loss of executors. ``drop``
    removes tables that no returned DataFrame reads any more.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.base = f"{ensure_checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"
        self.count = 0

    def path(self, name: str) -> str:
        self.count += 1
        return f"{self.base}/{self.count:03d}-{name}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def write_narrow(self, df: DataFrame, name: str) -> DataFrame:
        """As ``write``, for a few numbers a row: two tasks a core, so a small table is not hundreds of files, one a partition."""
        return self.write(df.coalesce(2 * self.spark.sparkContext.defaultParallelism), name)

    def drop(self, df: DataFrame | None) -> None:
        path = getattr(df, "_scratch_path", None)
        if path:
            target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)
