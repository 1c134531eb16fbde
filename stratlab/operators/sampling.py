"""Exact-size stratified samples and stratified folds (O-65, O-66, O-70, O-71).

Row order inside a stratum is the hash order ``md5(key | seed)`` with the
key as tie-break: reproducible, independent of partitioning, and the same
in DuckDB (``md5`` agrees), so results can be checked by SQL.

Scale: no window ever runs over a whole stratum. Rows are bucketed by a
hash prefix (``prefix_bits``, sized from the largest stratum); a partial
``groupBy(stratum, prefix).count()`` plus a window over those counts gives
every bucket's offset inside its stratum, and ``row_number`` runs only
inside a (stratum, prefix) bucket. A stratum holding a third of all rows is
thus spread over 2^bits buckets, i.e. over all tasks.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

DEFAULT_SEED = 42           # fixed value: the study's random state
DEFAULT_FOLDS = 10          # fixed value: outer and inner fold count
TARGET_BUCKET_ROWS = 1 << 20


def hash_key(key_cols: Sequence[str], seed: int = DEFAULT_SEED) -> Column:
    """Hex md5 of the key columns joined by '|' and the seed."""
    return F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in key_cols], F.lit(str(seed))))


def _prefix_bits(max_stratum_rows: int) -> int:
    need = max(0, math.ceil(math.log2(max(1, max_stratum_rows) / TARGET_BUCKET_ROWS)))
    bits = max(8, need)
    return int(math.ceil(bits / 4) * 4)


def stratum_counts(df: DataFrame, stratum: str) -> DataFrame:
    """(stratum, _n): rows of each stratum, as a table of whatever length."""
    return df.groupBy(stratum).agg(F.count(F.lit(1)).alias("_n"))


def quotas(counts: DataFrame, stratum: str, fraction: float) -> DataFrame:
    """(stratum, _n, _quota) by the rule of ``allocate``, as a table.

    The rows left over after the floors go to the largest remainders (ties: stratum
    order); the window that ranks them sees one row per stratum, not the data.
    """
    total = counts.agg(F.sum("_n")).first()[0] or 0
    draws = int(math.floor(fraction * total))
    share = counts.withColumn("_share", F.col("_n") * F.lit(float(draws)) / F.lit(float(total or 1)))
    share = share.withColumn("_floor", F.floor("_share"))
    left = draws - (share.agg(F.sum("_floor")).first()[0] or 0)
    rank = F.row_number().over(Window.orderBy((F.col("_share") - F.col("_floor")).desc(), F.col(stratum).asc_nulls_last()))
    return share.select(stratum, "_n", (F.col("_floor") + (rank <= left).cast("long")).alias("_quota"))


def allocate(counts: Sequence[tuple], fraction: float) -> dict:
    """Per-stratum sample sizes: total floor(f * N); floors of the proportional
    share, remaining units to the largest remainders (ties: stratum order)."""
    total = sum(n for _, n in counts)
    draws = int(math.floor(fraction * total))
    cont = [(s, n * draws / total if total else 0.0) for s, n in counts]
    quota = {s: int(math.floor(c)) for s, c in cont}
    left = draws - sum(quota.values())
    order = sorted(range(len(cont)), key=lambda i: (-(cont[i][1] - math.floor(cont[i][1])), i))
    for i in order[:left]:
        quota[cont[i][0]] += 1
    return quota


def _ranked(df: DataFrame, key_cols: Sequence[str], stratum: str, seed: int, bits: int) -> DataFrame:
    nhex = bits // 4
    return (df.withColumn("_h", hash_key(key_cols, seed))
            .withColumn("_p", F.substring("_h", 1, nhex))   # of one width: ordered as the numbers are
            # one key that is never null: the rows are dealt out by it once, for the offsets and for the ranks
            .withColumn("_k", F.concat(F.substring("_h", 1, nhex), F.coalesce(F.concat(F.lit("="), F.col(stratum).cast("string")), F.lit("")))))


def _join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join with NULL-safe keys (a NULL stratum is a stratum of its own)."""
    r = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    cond = None
    for k in keys:
        e = left[k].eqNullSafe(r[f"_r_{k}"])
        cond = e if cond is None else cond & e
    return left.join(r, cond, how).drop(*[f"_r_{k}" for k in keys])


def _bucket_offsets(h: DataFrame, stratum: str) -> DataFrame:
    """(stratum, _p, _k, _cnt, _before): rows of the stratum in lower prefixes."""
    hist = h.groupBy(stratum, "_p", "_k").agg(F.count(F.lit(1)).alias("_cnt"))
    w = Window.partitionBy(stratum).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    return hist.withColumn("_before", F.coalesce(F.sum("_cnt").over(w), F.lit(0)))


def stratified_sample(df: DataFrame, key_cols: Sequence[str], stratum: str, fraction: float,
                      seed: int = DEFAULT_SEED, flag: str = "in_sample") -> DataFrame:
    """O-65/O-66: every row with a boolean ``flag``; exactly the allocated count
    per stratum is true (the sample), the rest is the complement."""
    ensure_checkpoint_dir(df.sparkSession)
    counts = stratum_counts(df, stratum).checkpoint()
    qdf = quotas(counts, stratum, fraction).select(stratum, "_quota")
    bits = _prefix_bits(counts.agg(F.max("_n")).first()[0] or 1)
    h = _ranked(df, key_cols, stratum, seed, bits)
    offs = _join_on(_bucket_offsets(h, stratum).drop("_k"), qdf, [stratum])
    # the one bucket per stratum where the quota ends, and how many rows it gives
    bounds = (offs.filter((F.col("_before") < F.col("_quota"))
                          & (F.col("_before") + F.col("_cnt") >= F.col("_quota")))
              .select(stratum, F.col("_p").alias("_bp"), (F.col("_quota") - F.col("_before")).alias("_need")))
    tagged = _join_on(h, bounds, [stratum], "left")
    plain = (tagged.filter(F.col("_bp").isNull() | (F.col("_p") != F.col("_bp")))
             .withColumn(flag, F.coalesce(F.col("_p") < F.col("_bp"), F.lit(False))))
    w = Window.partitionBy(stratum, "_p").orderBy("_h", *key_cols)
    edge = (tagged.filter(F.col("_p") == F.col("_bp"))
            .withColumn(flag, F.row_number().over(w) <= F.col("_need")))
    return plain.unionByName(edge).drop("_h", "_p", "_k", "_bp", "_need")


def stratified_folds(df: DataFrame, key_cols: Sequence[str], stratum: str, k: int = DEFAULT_FOLDS,
                     seed: int = DEFAULT_SEED, fold: str = "fold", inner: str | None = None,
                     position: str | None = None) -> DataFrame:
    """O-70 (+ O-71 when ``inner`` is given): stratified k-fold ids.

    Rows are laid out stratum by stratum (stratum order), hash order inside;
    global position p goes to fold ``p % k``. Per-(fold, stratum) counts are
    the interleaved allocation: fold sizes differ by at most one, and so do a
    stratum's counts across folds.

    ``inner``: array column, element j = the row's fold inside the training
    part of outer fold j (NULL when the row is in fold j): the same layout
    applied to the rows outside fold j, derived arithmetically from p.
    ``position``: keep p itself (with p = k*a + b, the inner fold for outer
    fold j is (b - [b > j] - a) mod k, see ``inner_fold_of_cell``).
    """
    ensure_checkpoint_dir(df.sparkSession)
    counts = stratum_counts(df, stratum).checkpoint()
    bits = _prefix_bits(counts.agg(F.max("_n")).first()[0] or 1)
    before = Window.orderBy(F.col(stratum).asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(stratum, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))   # one row per stratum
    h = _ranked(df, key_cols, stratum, seed, bits)
    offs = _join_on(_bucket_offsets(h, stratum).select(stratum, "_k", "_before"), starts, [stratum]).drop(stratum)
    w = Window.partitionBy("_k").orderBy("_h", *key_cols)
    pos = (F.col("_start") + F.col("_before") + F.row_number().over(w) - 1)
    out = h.join(offs, "_k").withColumn("_pos", pos)
    out = out.withColumn(fold, (F.col("_pos") % k).cast("int"))
    if inner:
        def count_mod(x: Column, j: int) -> Column:
            # positions q in [0, x) with q % k == j
            return F.floor((x + F.lit(k - 1 - j)) / F.lit(k))
        elems = []
        for j in range(k):
            ipos = F.col("_pos") - count_mod(F.col("_pos"), j)
            elems.append(F.when(F.col(fold) != j, (ipos % k).cast("int")))
        out = out.withColumn(inner, F.array(*elems))
    if position:
        out = out.withColumn(position, F.col("_pos"))
    return out.drop("_h", "_p", "_k", "_before", "_start", "_pos")


def inner_fold_of_cell(b: int, c: int, j: int, k: int = DEFAULT_FOLDS) -> int | None:
    """Inner fold, for outer fold j, of every row whose position p has
    p % k == b and (p // k) % k == c; None for rows of fold j itself."""
    if b == j:
        return None
    return (b - (1 if b > j else 0) - c) % k
