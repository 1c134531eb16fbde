"""Agglomerative clustering of one numeric column (O-59..O-64, O-47).

In one dimension every cluster of single, complete, average or ward
linkage is an interval of the sorted values, and all four linkages are
reducible, so every pair of adjacent intervals that are each other's
nearest neighbour can merge in the same round without changing the
dendrogram. The dendrogram is then a table ``(boundary, height)``: the
largest value left of a merge point and the merge height. A cut into at
most k clusters keeps the boundaries whose height exceeds the k-th largest.

Rounds run on distinct values with weights (equal values merge at height
0). A boundary merges when its key ``(distance, hash of the right value, right
value)`` is strictly below both neighbouring keys; the hash makes ties break the
same way everywhere and keeps rounds few on evenly spaced data.

Intervals live in value-range buckets, whose number shrinks when few
intervals are left. In a round every bucket merges all that it can in one pass
over its intervals: a merge needs a smaller key than both neighbours, and the
distance to the interval beyond a border at the start of the round is a lower
bound, as an interval that grows moves away from its neighbours (complete,
average and ward linkage on a line). Only pairs that depend on a border wait;
borders move by half a bucket each round. What lies beyond a border comes by a
join with the table of bucket edges. Each round is one written table.

Single linkage needs no rounds: its boundary heights are the gaps between
consecutive distinct values.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .ordered import beside_buckets, range_buckets, running_sum, with_neighbours
from ..functions.frames import literal_frame

# Linkage order (first wins on equal scores) and the k sweep.
LINKAGES = ["single", "complete", "average", "ward"]
CLUSTER_COUNTS = list(range(2, 11))

SCORE_PLACES = 9   # scores equal to so many places are ties: float sums differ in the last ones between runs
INTERVALS_PER_BUCKET = 200_000
LEAST_PER_BUCKET = 64   # below that, buckets are joined rather than kept for parallelism

#: Slots of the range partitioning for each bucket that the first round has.
SLOTS = 4

_ROUND = "linkage string, _kind int, lo double, hi double, n double, s double, hl string, slot int"


# ------------------------------------------------------------------ inputs


def distinct_weighted(df: DataFrame, col: str) -> DataFrame:
    """(lo, hi, n, s, hl): one interval per distinct non-null value, NaN dropped."""
    x = F.col(col).cast("double")
    d = (df.select(x.alias("v")).filter(F.col("v").isNotNull() & ~F.isnan("v"))
         .groupBy("v").agg(F.count(F.lit(1)).cast("double").alias("n")))
    return d.select(F.col("v").alias("lo"), F.col("v").alias("hi"), "n",
                    (F.col("v") * F.col("n")).alias("s"),
                    F.md5(F.round(F.col("v") * 10_000).cast("bigint").cast("string")).alias("hl"))


# ------------------------------------------------------------------ rounds


def pair_distance(a: tuple, b: tuple, linkage: str) -> float:
    """Distance between adjacent intervals (lo, hi, n, s, ...), a left of b."""
    if linkage == "single":
        return b[0] - a[1]
    if linkage == "complete":
        return b[1] - a[0]
    between = b[3] / b[2] - a[3] / a[2]
    if linkage == "average":
        return between
    if linkage == "ward":
        return math.sqrt(2.0 * a[2] * b[2] / (a[2] + b[2])) * between
    raise ValueError(f"unknown linkage {linkage!r}")


def merge_bucket(intervals: list[tuple], before: tuple | None, after: tuple | None, linkage: str
                 ) -> tuple[list[tuple], list[tuple[float, float]]]:
    """(intervals left, merges as (boundary, height)) of one bucket.

    ``intervals``: (lo, hi, n, s, hl, ...) in order; ``before`` and ``after`` are the intervals beyond
    the borders. A pair merges while its key is below both neighbouring keys. A merge changes the keys
    beside it only, so each one has at most four pairs looked at again.
    """
    def key(a, b):
        return None if a is None or b is None else (pair_distance(a, b, linkage), b[4], b[0])

    m = len(intervals)
    at = [before, *intervals, after]                 # place 0 and m + 1: beyond the borders
    left, right = list(range(-1, m + 1)), list(range(1, m + 3))
    keys = [key(at[i], at[i + 1]) for i in range(m + 1)]   # of the interval at i and the one right of it
    merges, look = [], list(range(m - 1, 0, -1))
    while look:
        i = look.pop()
        own = keys[i] if 0 < i < m and at[i] is not None and right[i] <= m else None
        if own is None:
            continue
        j = right[i]
        k_left, k_right = keys[left[i]], keys[j]
        if (k_left is not None and k_left < own) or (k_right is not None and k_right < own):
            continue
        a, b = at[i], at[j]
        merges.append((a[1], own[0]))
        at[i], at[j] = (a[0], b[1], a[2] + b[2], a[3] + b[3], *a[4:]), None
        right[i] = right[j]
        if right[j] <= m + 1:
            left[right[j]] = i
        keys[j] = None
        keys[left[i]] = key(at[left[i]], at[i])
        keys[i] = key(at[i], at[right[i]])
        look += [right[i], i, left[i], left[left[i]] if left[i] > 0 else 0]
    return [x for x in at[1:m + 1] if x is not None], merges


def _round(iv: DataFrame, width: dict[str, int], shift: int) -> DataFrame:
    """One round of all linkages as rows of kind 0 (intervals left) and 1 (merges: boundary in lo, height in hi).

    A bucket is ``width`` neighbouring slots; ``shift`` 1 moves the borders by half a bucket.
    """
    wide = F.element_at(F.create_map(*[F.lit(x) for kv in width.items() for x in kv]), F.col("linkage"))
    b = iv.withColumn("_b", F.floor((F.col("slot") + F.floor(wide / 2) * shift) / wide))
    me = F.struct("lo", "hi", "n", "s", "hl")
    edges = b.groupBy("linkage", "_b").agg(F.min_by(me, "lo").alias("first"), F.max_by(me, "lo").alias("last"))
    edges = beside_buckets(edges, "first", "last", "before", "after", "_b", ["linkage"]) \
        .withColumnsRenamed({"linkage": "_of", "_b": "_at"})

    def run(key: tuple, rows: pd.DataFrame, border: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("lo", kind="mergesort")
        beyond = [None if x is None else (x["lo"], x["hi"], x["n"], x["s"], x["hl"]) for x in
                  ((border["before"].iloc[0], border["after"].iloc[0]) if len(border) else (None, None))]
        left, merges = merge_bucket(list(zip(*[rows[c].tolist() for c in ("lo", "hi", "n", "s", "hl", "slot")])), *beyond, key[0])
        out = [(key[0], 0, *x) for x in left] + [(key[0], 1, at, height, None, None, None, None) for at, height in merges]
        out = pd.DataFrame(out, columns=["linkage", "_kind", "lo", "hi", "n", "s", "hl", "slot"])
        return out.astype({"slot": "Int32"})

    return b.select("linkage", "_b", "lo", "hi", "n", "s", "hl", "slot").groupBy("linkage", "_b") \
        .cogroup(edges.groupBy("_of", "_at")).applyInPandas(run, _ROUND)


def all_boundaries(d: DataFrame, linkages: Sequence[str], least_per_bucket: int = LEAST_PER_BUCKET,
                   per_bucket: int = INTERVALS_PER_BUCKET) -> DataFrame:
    """O-59: dendrograms as (linkage, boundary, height), from ``distinct_weighted`` output.

    The rounds of several linkages run together: one exchange, one written table and one count a round. The values are
    range-partitioned once, into slots that an interval keeps (its first value's); a bucket is some neighbouring slots.
    """
    spark = d.sparkSession
    ensure_checkpoint_dir(spark)
    merged = []
    if "single" in linkages:
        nb = with_neighbours(d.select("lo"), "lo", prev="_prev")
        merged.append(nb.filter(F.col("_prev").isNotNull()).select(
            F.lit("single").alias("linkage"), F.col("_prev").alias("boundary"), (F.col("lo") - F.col("_prev")).alias("height")))
    others = [x for x in linkages if x != "single"]
    if others:
        d = d.checkpoint()
        n = d.count()
        most = max(-(-n // per_bucket), min(spark.sparkContext.defaultParallelism, n // least_per_bucket), 1)
        slots = SLOTS * most
        iv = range_buckets(d, "lo", slots, out="slot").withColumn("linkage", F.explode(F.array(*[F.lit(x) for x in others])))
        left, still, k = dict.fromkeys(others, n), dict.fromkeys(others, 0), 0
        while any(x > 1 for x in left.values()):
            # buckets are only joined when there are few intervals in all, so that none of them gets large
            buckets = {x: max(1, min(most, m // least_per_bucket)) for x, m in left.items() if m > 1}
            done = _round(iv.filter(F.col("linkage").isin(list(buckets))), {x: -(-slots // b) if b > 1 else 2 * slots + 2 for x, b in buckets.items()},
                          k % 2).checkpoint()
            merged.append(done.filter("_kind = 1").select("linkage", F.col("lo").alias("boundary"), F.col("hi").alias("height")))
            iv = done.filter("_kind = 0").drop("_kind")
            now = {r["linkage"]: r["count"] for r in iv.groupBy("linkage").count().collect()}
            for x in buckets:
                still[x] = still[x] + 1 if now.get(x, 0) == left[x] else 0
                if still[x] > 1:   # the smallest key of all is inside a bucket in one of two rounds
                    raise RuntimeError(f"{x} linkage does not get on with {left[x]} intervals")
                left[x] = now.get(x, 0)
            k += 1
    if not merged:
        return d.select(F.lit("").alias("linkage"), F.col("lo").alias("boundary"), F.col("lo").alias("height")).limit(0)
    return functools.reduce(DataFrame.unionByName, merged)


def linkage_boundaries(d: DataFrame, linkage: str, least_per_bucket: int = LEAST_PER_BUCKET,
                       per_bucket: int = INTERVALS_PER_BUCKET) -> DataFrame:
    """O-59: dendrogram of one linkage as (boundary, height), from ``distinct_weighted`` output."""
    return all_boundaries(d, [linkage], least_per_bucket, per_bucket).drop("linkage")


# ------------------------------------------------------------------ cuts and labels


def top_boundaries(bounds: DataFrame, kmax: int = max(CLUSTER_COUNTS)) -> list[tuple[float, float]]:
    """The ``kmax`` highest merges (a top-k: all a cut into <= kmax clusters needs)."""
    rows = bounds.orderBy(F.col("height").desc(), F.col("boundary")).limit(kmax).collect()
    return [(r["boundary"], r["height"]) for r in rows]


def top_boundaries_by_linkage(bounds: DataFrame, kmax: int = max(CLUSTER_COUNTS)) -> dict[str, list[tuple[float, float]]]:
    """The ``kmax`` highest merges of each linkage, from one table of them."""
    rank = F.row_number().over(Window.partitionBy("linkage").orderBy(F.col("height").desc(), F.col("boundary")))
    out: dict[str, list[tuple[float, float]]] = {}
    for r in bounds.withColumn("_r", rank).filter(F.col("_r") <= kmax).orderBy("linkage", "_r").collect():
        out.setdefault(r["linkage"], []).append((r["boundary"], r["height"]))
    return out


def cuts_for(top: Sequence[tuple[float, float]], k: int) -> list[float]:
    """O-60: boundaries cut for at most k clusters: height above the k-th largest
    (ties at that height stay merged, so fewer clusters can result)."""
    thr = top[k - 1][1] if len(top) >= k else float("-inf")
    return sorted(b for b, h in top if h > thr)


def label_expr(x: str | Column, cuts: Sequence[float]) -> Column:
    """O-62: 1 + number of cut boundaries below the value (labels ascend with value).

    A sum of comparisons (at most k - 1 terms) keeps the expression inside
    whole-stage codegen, unlike a higher-order ``filter``.
    """
    col = F.col(x) if isinstance(x, str) else x
    out = F.lit(1)
    for c in sorted(cuts):
        out = out + F.when(col > F.lit(float(c)), 1).otherwise(0)
    return out.cast("int")


# ------------------------------------------------------------------ silhouette


def silhouette_scores(d: DataFrame, settings: dict[tuple[str, int], list[float]]) -> DataFrame:
    """O-63 for many labellings at once: (linkage, k, silhouette, clusters).

    Exact Euclidean silhouette in 1-D from prefix sums: for x in cluster C,
    a(x) = sum |x - y| over C / (|C| - 1) from the running count and sum
    inside C; b(x) = min |x - mean(C')| over the two neighbouring clusters;
    s = (b - a) / max(a, b), 0 for a singleton cluster; averaged over all
    points (distinct values weighted by their count).

    Passes over the distinct values whatever the number of labellings: global
    running sums (bucketed, see ``ordered``; checkpointed); a lookup of those
    sums at the cut values (clusters are intervals, so cluster sums are
    differences); one aggregate of the per-value silhouette terms with the
    clusters as literals, one column per labelling. No row is replicated.
    """
    spark = d.sparkSession
    ensure_checkpoint_dir(spark)
    base = d.select(F.col("lo").alias("x"), "n", "s")
    g = running_sum(base, "x", ["n", "s"], ["G_n", "G_s"]).checkpoint()
    keys = list(settings)
    # clusters are intervals, so their sums are differences of the running sums
    # at the cut values (data values): one lookup of at most 36 x 9 rows
    all_cuts = sorted({c for cuts in settings.values() for c in cuts})
    at_cut = {r["x"]: (r["G_n"], r["G_s"]) for r in
              g.filter(F.col("x").isin(all_cuts)).select("x", "G_n", "G_s").collect()} if all_cuts else {}
    totals = base.agg(F.sum("n").alias("N"), F.sum("s").alias("S")).collect()[0]
    # per labelling: its clusters as literals in one aggregate column each
    x = F.col("x")
    sums, meta = [], []
    for i, key in enumerate(keys):
        cuts = sorted(settings[key])
        pn = [0.0] + [at_cut[c][0] for c in cuts] + [float(totals["N"] or 0)]
        ps = [0.0] + [at_cut[c][1] for c in cuts] + [float(totals["S"] or 0)]
        cn = [b - a for a, b in zip(pn, pn[1:])]
        cs = [b - a for a, b in zip(ps, ps[1:])]
        means = [s_ / n_ if n_ else None for n_, s_ in zip(cn, cs)]

        def pick(values):
            """The value of the cluster that x is in."""
            out = F.lit(values[-1]).cast("double")
            for cut, v in reversed(list(zip(cuts, values))):
                out = F.when(x <= F.lit(float(cut)), F.lit(v).cast("double")).otherwise(out)
            return out

        c_n, c_s = pick(cn), pick(cs)
        cnt_le, sum_le = F.col("G_n") - pick(pn[:-1]), F.col("G_s") - pick(ps[:-1])
        within = x * cnt_le - sum_le + (c_s - sum_le) - x * (c_n - cnt_le)
        a = F.when(c_n > 1, within / (c_n - 1))
        b = F.least(F.abs(x - pick([None, *means[:-1]])), F.abs(x - pick([*means[1:], None])))
        sil = F.when(c_n <= 1, F.lit(0.0)).otherwise(F.coalesce(F.try_divide(b - a, F.greatest(a, b)), F.lit(0.0)))
        sums.append(F.sum(sil * F.col("n")).alias(f"_s{i}"))
        meta.append((key[0], int(key[1]), sum(1 for v in cn if v > 0)))
    got = g.agg(*sums).first()
    n_tot = float(totals["N"] or 0)
    rows = [(l, k, float(got[i]) / n_tot, c) for i, (l, k, c) in enumerate(meta)] if totals["N"] else []
    return literal_frame(spark, rows, "linkage string, k int, silhouette double, clusters int")


def best_setting(scores: DataFrame) -> DataFrame:
    """O-64: best k per linkage and best overall; first wins on ties
    (linkage order, then smaller k)."""
    rank = F.array_position(F.array(*[F.lit(l) for l in LINKAGES]), F.col("linkage"))
    return (scores.withColumn("linkage_rank", rank)
            .orderBy(F.round("silhouette", SCORE_PLACES).desc(), "linkage_rank", "k").limit(1).drop("linkage_rank"))


def best_per_linkage(scores: DataFrame) -> DataFrame:
    """O-64 (per linkage) and O-56 marker: is_best flag on the score-by-k series."""
    w = Window.partitionBy("linkage").orderBy(F.round("silhouette", SCORE_PLACES).desc(), "k")
    return scores.withColumn("is_best", F.row_number().over(w) == 1)


# ------------------------------------------------------------------ end to end


def cluster_study(df: DataFrame, col: str, linkages: Sequence[str] = LINKAGES,
                  ks: Sequence[int] = CLUSTER_COUNTS):
    """O-59..O-64: dendrograms, k sweep, silhouettes, best labelling.

    Returns (scores DataFrame, best (linkage, k, cuts)). The distinct-value
    table is checkpointed once and shared by every linkage.
    """
    ensure_checkpoint_dir(df.sparkSession)
    d = distinct_weighted(df, col).checkpoint()
    settings = {}
    tops = top_boundaries_by_linkage(all_boundaries(d, linkages), max(ks))
    for l in linkages:
        for k in ks:
            settings[(l, k)] = cuts_for(tops.get(l, []), k)
    scores = silhouette_scores(d, settings).checkpoint()
    best = best_setting(scores).first()
    if best is None:   # no values
        return scores, (linkages[0], min(ks), []), settings
    return scores, (best["linkage"], best["k"], settings[(best["linkage"], best["k"])]), settings


def add_cluster_label(df: DataFrame, col: str, cuts: Sequence[float], name: str = "cluster") -> DataFrame:
    """O-16 re-aimed: the label from the value, not from row position."""
    return df.withColumn(name, label_expr(F.col(col).cast("double"), cuts))
