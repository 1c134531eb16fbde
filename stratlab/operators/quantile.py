"""Exact order statistics (O-33, O-31, O-51 quartiles).

Definitions, with ``n`` the count of non-null values and ``sorted`` the
ascending values:

* nearest rank (O-33): ``sorted[floor((n - 1) * q + 0.5)]``
* linear (O-31 median, O-51 box quartiles): ``h = (n - 1) * q``,
  ``sorted[floor h] + (h - floor h) * (sorted[ceil h] - sorted[floor h])``

How a rank is found without sorting or collecting the column:

1. one aggregate gives ``count``, ``min``, ``max`` per column;
2. while a bracket ``[lo, hi]`` still holds more than ``exact_rows`` values,
   one aggregate job histograms every open bracket into ``buckets`` equal
   width cells (an ``explode`` feeding a partial ``groupBy``, so each task
   emits at most targets x buckets rows); the cell holding the wanted rank
   becomes the new bracket (its own min/max, so repeated values end the
   search at once);
3. one last aggregate runs ``percentile_disc`` on the values inside each
   bracket with the fraction ``(rank + 0.5) / m``, which selects exactly
   the rank-th value.

Each step is a global aggregate with bounded state; nothing row-sized
reaches the driver or a single task. Heavy duplicates (a third of all rows
on one value) only make the bracket collapse sooner.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_EXACT_ROWS = 100_000
DEFAULT_BUCKETS = 1024


def nearest_rank_index(n: int, q: float) -> int:
    """0-based index of the nearest-rank quantile (half rounds up)."""
    return int(math.floor((n - 1) * q + 0.5))


def _dlit(x: float) -> str:
    return f"CAST('{x!r}' AS DOUBLE)"


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


@dataclass
class _Target:
    col: str
    rank: int
    lo: float
    hi: float
    r: int      # rank inside the bracket
    m: int      # values inside the bracket
    value: float | None = None
    done: bool = False


def column_ranges(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[int, float | None, float | None]]:
    """One aggregate: (count, min, max) of each column (NaN must already be NULL)."""
    if not cols:
        return {}
    aggs = []
    for i, c in enumerate(cols):
        col = F.col(c).cast("double")
        aggs += [F.count(col).alias(f"n{i}"), F.min(col).alias(f"lo{i}"), F.max(col).alias(f"hi{i}")]
    row = df.agg(*aggs).collect()[0]
    return {c: (int(row[f"n{i}"]), row[f"lo{i}"], row[f"hi{i}"]) for i, c in enumerate(cols)}


def order_statistics(df: DataFrame, wanted: dict[str, Iterable[int]],
                     ranges: dict[str, tuple[int, float | None, float | None]] | None = None,
                     exact_rows: int = DEFAULT_EXACT_ROWS, buckets: int = DEFAULT_BUCKETS) -> dict[tuple[str, int], float | None]:
    """Exact ``sorted(col)[rank]`` for every requested (column, 0-based rank).

    ``df`` columns must be numeric with NaN already replaced by NULL.
    """
    cols = list(wanted)
    if ranges is None:
        ranges = column_ranges(df, cols)
    targets: list[_Target] = []
    for c in cols:
        n, lo, hi = ranges[c]
        for r in sorted(set(int(x) for x in wanted[c])):
            t = _Target(c, r, lo, hi, r, n)
            if n == 0 or r < 0 or r >= n:
                t.done = True
            elif lo == hi:
                t.value, t.done = lo, True
            targets.append(t)

    while True:
        # a round narrows every open bracket (its ends fall into different cells), so this ends
        open_ = [t for t in targets if not t.done and t.m > exact_rows]
        if not open_:
            break
        widths = {id(t): (t.lo, t.hi) for t in open_}
        # one histogram per distinct (column, bracket): targets of a column share it at first
        brackets = sorted({(t.col, t.lo, t.hi) for t in open_}, key=lambda k: (k[0], k[1], k[2]))
        cells = []
        for i, (c, lo, hi) in enumerate(brackets):
            x = F.col(c).cast("double")
            width = (hi - lo) / buckets
            b = F.least(F.floor((x - F.lit(lo)) / F.lit(width)), F.lit(buckets - 1)).cast("int")
            cells.append(F.when((x >= F.lit(lo)) & (x <= F.lit(hi)),
                                F.struct(F.lit(i).alias("t"), b.alias("b"), x.alias("v"))))
        hist = (df.select(F.explode(F.array(*cells)).alias("s")).filter(F.col("s").isNotNull())
                .groupBy(F.col("s.t").alias("t"), F.col("s.b").alias("b"))
                .agg(F.count(F.lit(1)).alias("n"), F.min("s.v").alias("lo"), F.max("s.v").alias("hi"))
                .collect())
        by_bracket: dict[int, list] = {}
        for row in hist:
            by_bracket.setdefault(row["t"], []).append(row)
        for rows in by_bracket.values():
            rows.sort(key=lambda r: r["b"])
        index = {k: i for i, k in enumerate(brackets)}
        for t in open_:
            acc = 0
            for row in by_bracket.get(index[(t.col, t.lo, t.hi)], []):
                if acc + row["n"] > t.r:
                    t.lo, t.hi, t.r, t.m = row["lo"], row["hi"], t.r - acc, row["n"]
                    break
                acc += row["n"]
            if t.lo == t.hi:
                t.value, t.done = t.lo, True
            elif (t.lo, t.hi) == widths[id(t)]:
                raise ArithmeticError(f"the range of {t.col!r} cannot be divided: {t.lo} to {t.hi}")

    rest = [t for t in targets if not t.done]
    if rest:
        exprs = []
        for i, t in enumerate(rest):
            frac = (t.r + 0.5) / t.m
            exprs.append(F.expr(
                f"percentile_disc({frac!r}) WITHIN GROUP (ORDER BY CASE WHEN "
                f"CAST({_q(t.col)} AS DOUBLE) BETWEEN {_dlit(t.lo)} AND {_dlit(t.hi)} "
                f"THEN CAST({_q(t.col)} AS DOUBLE) END)").alias(f"p{i}"))
        row = df.agg(*exprs).collect()[0]
        for i, t in enumerate(rest):
            t.value, t.done = row[f"p{i}"], True
    return {(t.col, t.rank): (None if t.value is None else float(t.value)) for t in targets}


def quantiles(df: DataFrame, cols: Sequence[str], qs: Sequence[float], method: str = "nearest",
              ranges: dict | None = None, **kw) -> dict[tuple[str, float], float | None]:
    """Exact quantiles per (column, q); ``method`` is ``nearest`` (O-33) or ``linear``."""
    if method not in ("nearest", "linear"):
        raise ValueError(f"unknown quantile method {method!r}")
    got = quantile_set(df, cols, [(q, method) for q in qs], ranges=ranges, **kw)
    return {(c, q): v for (c, q, _), v in got.items()}


def quantile_set(df: DataFrame, cols: Sequence[str], requests: Sequence[tuple[float, str]],
                 ranges: dict | None = None, **kw) -> dict[tuple[str, float, str], float | None]:
    """Several (q, method) pairs per column with one ranges job and one rank search."""
    if ranges is None:
        ranges = column_ranges(df, cols)
    wanted: dict[str, set[int]] = {c: set() for c in cols}
    plan = {}
    for c in cols:
        n = ranges[c][0]
        for q, method in requests:
            if n == 0:
                plan[(c, q, method)] = None
                continue
            if method == "nearest":
                k = nearest_rank_index(n, q)
                plan[(c, q, method)] = (k, k, 0.0)
            else:
                h = (n - 1) * q
                lo, hi = int(math.floor(h)), int(math.ceil(h))
                plan[(c, q, method)] = (lo, hi, h - lo)
            wanted[c].update(plan[(c, q, method)][:2])
    stats = order_statistics(df, {c: v for c, v in wanted.items() if v}, ranges=ranges, **kw)
    out = {}
    for key, p in plan.items():
        if p is None:
            out[key] = None
            continue
        a, b = stats[(key[0], p[0])], stats[(key[0], p[1])]
        out[key] = a if p[2] == 0.0 or a is None else a + p[2] * (b - a)
    return out


def approx_quantiles(df: DataFrame, cols: Sequence[str], qs: Sequence[float],
                     accuracy: int = 10_000) -> dict[tuple[str, float], float | None]:
    """Sketch-based quantiles (``percentile_approx``), when asked for."""
    row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), list(qs), accuracy).alias(f"a{i}")
                   for i, c in enumerate(cols)]).collect()[0]
    out = {}
    for i, c in enumerate(cols):
        vals = row[f"a{i}"]
        for j, q in enumerate(qs):
            out[(c, q)] = None if vals is None else vals[j]
    return out
