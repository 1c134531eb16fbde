"""Chart data as small DataFrames (O-44, O-48..O-55).

Every operator scans the input once or twice with aggregates whose state
is bounded by the output size (bins, grid points, pairs), never by the row
count.
"""

from __future__ import annotations

import functools
import math
import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import clean_numeric
from . import quantile as Q
from .ordered import running_sum
from ..functions.frames import literal_frame

KDE_GRID = 200        # fixed value: density curve grid size
KDE_REACH = 40.0      # |z| beyond which the Gaussian kernel underflows to exactly 0.0
FIXED_BINS = 30       # fixed value: bins of the stacked histogram
BOX_WHISKER = 1.5     # fixed value: whisker reach in IQRs


def _d(x) -> Column:
    return F.lit(x).cast("double")


# ------------------------------------------------------------------ O-44


def correlation_long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson r for every pair (a, b) with pos(a) > pos(b): lower triangle, no diagonal.

    r = covar_samp / (stddev_samp a * stddev_samp b); a constant column gives
    NULL instead of a division error.
    """
    aggs, pairs = [], []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols[:i]):
            k = len(pairs)
            aggs.append(F.try_divide(F.covar_samp(a, b),
                                     F.stddev_samp(a) * F.stddev_samp(b)).alias(f"r{k}"))
            pairs.append(f"'{a}', '{b}', r{k}")
    wide = df.agg(*aggs)
    return wide.selectExpr(f"stack({len(pairs)}, {', '.join(pairs)}) as (column_a, column_b, r)")


# ------------------------------------------------------------------ bins


def auto_bin_count(n: int, lo: float, hi: float, iqr: float) -> int:
    """Bin count of the automatic rule: width = min(Sturges, Freedman-Diaconis)
    (Sturges alone when the FD width is 0); bins = ceil(range / width)."""
    if n == 0 or lo is None or hi == lo:
        return 1
    rng = hi - lo
    sturges = rng / (math.log2(n) + 1.0)
    fd = 2.0 * iqr * n ** (-1.0 / 3.0) if iqr else 0.0
    width = min(fd, sturges) if fd > 0 else sturges
    return max(1, int(math.ceil(rng / width)))


def bin_index(x: Column, lo: float, hi: float, nb: int) -> Column:
    """Equal-width bin of ``x`` on edges lo + i * (hi - lo) / nb, last bin closed.

    The first guess ``floor((x - lo) * nb / (hi - lo))`` is corrected against
    the edges themselves, so a value on an edge lands in the upper bin.
    (Single-expression form; ``with_bin`` is the cheaper staged form.)
    """
    if hi == lo:
        return F.lit(0)
    step = (hi - lo) / nb
    g = F.least(F.greatest(F.floor((x - _d(lo)) * _d(nb / (hi - lo))), F.lit(0)), F.lit(nb - 1)).cast("int")
    edge = lambda i: _d(lo) + i.cast("double") * _d(step)
    g = F.when(x < edge(g), g - 1).otherwise(g)
    return F.when((x >= edge(g + 1)) & (g != nb - 1), g + 1).otherwise(g)


def with_bin(df: DataFrame, x: str, specs: dict[str, tuple[float, float, int]] | tuple[float, float, int],
             out: str = "bin", key: str = "column") -> DataFrame:
    """Add ``out`` = ``bin_index`` of ``x``, in three projection steps.

    ``specs`` is one (lo, hi, nb) or a map key value -> (lo, hi, nb) chosen
    by column ``key``. Each step references the previous one's column, so the
    first guess is computed once per row instead of being copied into every
    branch of the correction.
    """
    def pick(i: int) -> Column:
        if isinstance(specs, tuple):
            return _d(specs[i]) if i < 2 else F.lit(specs[i])
        e = None
        for k, sp in specs.items():
            v = _d(sp[i]) if i < 2 else F.lit(sp[i])
            e = F.when(F.col(key) == k, v) if e is None else e.when(F.col(key) == k, v)
        return e
    lo, hi, nb = pick(0), pick(1), pick(2)
    xc = F.col(x)
    step = (hi - lo) / nb.cast("double")
    staged = df.withColumns({"_lo": lo, "_nb": nb, "_st": step,
                             "_f": nb.cast("double") / (hi - lo), "_flat": hi == lo})
    staged = staged.withColumn("_g0", F.least(F.greatest(F.floor((xc - F.col("_lo")) * F.col("_f")), F.lit(0)),
                                              F.col("_nb") - 1).cast("int"))
    staged = staged.withColumn("_g1", F.when(xc < F.col("_lo") + F.col("_g0").cast("double") * F.col("_st"),
                                             F.col("_g0") - 1).otherwise(F.col("_g0")))
    staged = staged.withColumn(out, F.when(F.col("_flat"), F.lit(0))
                               .when((xc >= F.col("_lo") + (F.col("_g1") + 1).cast("double") * F.col("_st"))
                                     & (F.col("_g1") != F.col("_nb") - 1), F.col("_g1") + 1)
                               .otherwise(F.col("_g1")))
    return staged.drop("_lo", "_nb", "_st", "_f", "_flat", "_g0", "_g1")


def _stack_values(df: DataFrame, cols: Sequence[str], extra: Sequence[str] = ()) -> DataFrame:
    """Long form (column, x, *extra) of several numeric columns, NULLs dropped."""
    arr = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in cols])
    return (df.select(*extra, F.explode(arr).alias("_s"))
            .select(F.col("_s.column").alias("column"), F.col("_s.x").alias("x"), *extra)
            .filter(F.col("x").isNotNull()))


def _bins_table(spark, specs: dict[str, tuple[float, float, int]]) -> DataFrame:
    rows = [(c, lo, hi, nb) for c, (lo, hi, nb) in specs.items()]
    spec = literal_frame(spark, rows, "column string, lo double, hi double, nb int")
    return (spec.select("column", "lo", "hi", "nb", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("bin"))
            .select("column", "bin",
                    (F.col("lo") + F.col("bin") * ((F.col("hi") - F.col("lo")) / F.col("nb"))).alias("bin_lo"),
                    F.when(F.col("bin") == F.col("nb") - 1, F.col("hi"))
                    .otherwise(F.col("lo") + (F.col("bin") + 1) * ((F.col("hi") - F.col("lo")) / F.col("nb")))
                    .alias("bin_hi")))


def histogram(df: DataFrame, cols: Sequence[str], bins: int | dict[str, int] | None = None,
              by: str | None = None) -> DataFrame:
    """O-48 (automatic bins) and O-49 (fixed bins, optionally split ``by`` a label).

    Output: column, [by], bin, bin_lo, bin_hi, n — empty bins included.
    """
    clean = clean_numeric(df.select(*cols, *([by] if by else [])), cols)
    ranges = Q.column_ranges(clean, cols)
    specs = {}
    if bins is None:
        qs = Q.quantiles(clean, cols, [0.25, 0.75], "linear", ranges=ranges)
        for c in cols:
            n, lo, hi = ranges[c]
            iqr = None if n == 0 else qs[(c, 0.75)] - qs[(c, 0.25)]
            specs[c] = (lo, hi, auto_bin_count(n, lo, hi, iqr or 0.0))
    else:
        for c in cols:
            n, lo, hi = ranges[c]
            specs[c] = (lo, hi, bins if isinstance(bins, int) else bins[c])
    specs = {c: s for c, s in specs.items() if s[0] is not None}
    if not specs:
        return df.sparkSession.createDataFrame([], "column string, bin int, bin_lo double, bin_hi double, n bigint")
    long = _stack_values(clean, list(specs), [by] if by else [])
    keys = ["column", *([by] if by else []), "bin"]
    counts = with_bin(long, "x", specs).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    grid = _bins_table(df.sparkSession, specs)
    if by:
        # every label gets every column's bins; labels stay a table, whatever their number
        grid = (clean.select(by).distinct()
                .withColumn("column", F.explode(F.array(*[F.lit(c) for c in specs])))
                .join(grid, "column"))
    n = counts.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "n")
    same = functools.reduce(operator.and_, [grid[k].eqNullSafe(n[f"_k{i}"]) for i, k in enumerate(keys)])
    return (grid.join(n, same, "left")
            .select(*keys, "bin_lo", "bin_hi", F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n")))


# ------------------------------------------------------------------ O-50


def kde_curve(df: DataFrame, col: str, grid: int = KDE_GRID) -> DataFrame:
    """Gaussian density on ``grid`` points spanning [min, max], Scott bandwidth
    std(ddof=1) * n^(-1/5); also scaled to counts of the automatic histogram.

    Exact: each distinct value (weighted by its count) adds its kernel to every
    grid point through an array expansion and a partial aggregate by grid index
    (no join). Output: column, i, x, density, count_scaled.
    """
    clean = clean_numeric(df.select(col), [col]).filter(F.col(col).isNotNull())
    st = clean.agg(F.count(col).alias("n"), F.min(col).alias("lo"), F.max(col).alias("hi"),
                   F.stddev_samp(col).alias("sd")).collect()[0]
    n, lo, hi, sd = st["n"], st["lo"], st["hi"], st["sd"]
    spark = df.sparkSession
    if n < 2 or not sd:
        return spark.createDataFrame([], "column string, i int, x double, density double, count_scaled double")
    bw = sd * n ** (-0.2)
    step = (hi - lo) / (grid - 1)
    qs = Q.quantiles(clean, [col], [0.25, 0.75], "linear")
    nb = auto_bin_count(n, lo, hi, qs[(col, 0.75)] - qs[(col, 0.25)])
    binw = (hi - lo) / nb
    norm = 1.0 / (n * bw * math.sqrt(2 * math.pi))
    weights = clean.groupBy(col).agg(F.count(F.lit(1)).alias("w"))
    gx = lambda i: F.when(i == grid - 1, _d(hi)).otherwise(_d(lo) + i.cast("double") * _d(step))
    # A term with |z| > KDE_REACH is exp(-z^2/2) == 0.0 exactly in double precision,
    # so each value only visits the grid points within KDE_REACH bandwidths (one
    # extra point each side absorbs rounding of the index bounds).
    x = F.col(col)
    first = F.greatest(F.lit(0), F.floor((x - _d(KDE_REACH * bw) - _d(lo)) / _d(step)).cast("int") - 1)
    last = F.least(F.lit(grid - 1), F.ceil((x + _d(KDE_REACH * bw) - _d(lo)) / _d(step)).cast("int") + 1)
    pts = weights.select("w", x, F.explode(F.sequence(first, last)).alias("i"))
    dens = (pts.select("i", (F.col("w") * F.exp(-0.5 * F.pow((gx(F.col("i")) - x) / _d(bw), 2))).alias("k"))
            .groupBy("i").agg(F.sum("k").alias("s")))
    allp = df.sparkSession.range(grid).select(F.col("id").cast("int").alias("i"))
    dens = allp.join(dens, "i", "left").fillna(0.0, ["s"])
    return dens.select(F.lit(col).alias("column"), F.col("i").cast("int").alias("i"),
                       gx(F.col("i")).alias("x"),
                       (F.col("s") * _d(norm)).alias("density"),
                       (F.col("s") * _d(norm * n * binw)).alias("count_scaled"))


# ------------------------------------------------------------------ O-51/O-52


def _box_from_quartiles(q1, med, q3):
    iqr = q3 - q1
    return q1, med, q3, q1 - BOX_WHISKER * iqr, q3 + BOX_WHISKER * iqr


def box_summary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """O-51: linear quartiles, whiskers (extreme points inside the 1.5 IQR
    fences, never inside the box) and flier count, per column."""
    clean = clean_numeric(df.select(*cols), cols)
    qs = Q.quantiles(clean, cols, [0.25, 0.5, 0.75], "linear")
    parts = []
    for c in cols:
        if qs[(c, 0.5)] is None:
            continue
        q1, med, q3, lo, hi = _box_from_quartiles(qs[(c, 0.25)], qs[(c, 0.5)], qs[(c, 0.75)])
        x = F.col(c)
        wlo = F.least(F.min(F.when(x >= _d(lo), x)), _d(q1))
        whi = F.greatest(F.max(F.when(x <= _d(hi), x)), _d(q3))
        parts.append((c, q1, med, q3, wlo, whi))
    aggs = []
    for k, (c, q1, med, q3, wlo, whi) in enumerate(parts):
        aggs += [wlo.alias(f"wlo{k}"), whi.alias(f"whi{k}")]
    row = clean.agg(*aggs).collect()[0] if aggs else None
    exprs = []
    for k, (c, q1, med, q3, _, _) in enumerate(parts):
        wl, wh = row[f"wlo{k}"], row[f"whi{k}"]
        exprs.append(F.struct(F.lit(c).alias("column"), _d(q1).alias("q1"), _d(med).alias("median"),
                              _d(q3).alias("q3"), _d(wl).alias("whisker_lo"), _d(wh).alias("whisker_hi"),
                              F.count_if((F.col(c) < _d(wl)) | (F.col(c) > _d(wh))).alias("fliers")))
    if not exprs:
        return df.sparkSession.createDataFrame(
            [], "column string, q1 double, median double, q3 double, whisker_lo double, whisker_hi double, fliers bigint")
    return clean.agg(F.array(*exprs).alias("a")).select(F.inline("a"))


def box_summary_by(df: DataFrame, value: str, by: str, levels: Sequence[str]) -> DataFrame:
    """O-52: box summary of ``value`` per level of ``by``, levels in the given order.

    Each level becomes its own column for the exact quantile search, so a
    level holding most rows is split across all tasks like any column.
    """
    split = df.select(*[F.when(F.col(by) == F.lit(v), F.col(value)).alias(f"_l{i}")
                        for i, v in enumerate(levels)])
    box = box_summary(split, [f"_l{i}" for i in range(len(levels))])
    names = F.create_map(*[x for i, v in enumerate(levels) for x in (F.lit(f"_l{i}"), F.lit(v))])
    ranks = F.create_map(*[x for i, v in enumerate(levels) for x in (F.lit(f"_l{i}"), F.lit(i + 1))])
    return box.select(names[F.col("column")].alias(by), ranks[F.col("column")].alias("rank"),
                      *[c for c in box.columns if c != "column"])


# ------------------------------------------------------------------ O-53


def ecdf(df: DataFrame, col: str) -> DataFrame:
    """Empirical CDF at each distinct value: value, n, cum_n, ecdf (= cum_n / N).

    Distinct values with counts (partial aggregate), then a running sum that
    runs per value-range bucket (see ``ordered.running_sum``).
    """
    clean = clean_numeric(df.select(col), [col]).filter(F.col(col).isNotNull())
    d = clean.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    total = clean.count()
    cum = running_sum(d, "value", "n", "cum_n")
    return cum.select("value", "n", "cum_n", (F.col("cum_n") / _d(total)).alias("ecdf"))


# ------------------------------------------------------------------ O-54/O-55


def binned_scatter(df: DataFrame, x: str, y: str, bins: int = 50) -> DataFrame:
    """O-54 at scale: 2-D equal-width bin counts of (x, y) over complete pairs."""
    clean = clean_numeric(df.select(x, y), [x, y]).na.drop()
    r = Q.column_ranges(clean, [x, y])
    (_, xl, xh), (_, yl, yh) = r[x], r[y]
    if xl is None:
        return df.sparkSession.createDataFrame([], "xbin int, ybin int, n bigint")
    binned = with_bin(with_bin(clean, x, (xl, xh, bins), "xbin"), y, (yl, yh, bins), "ybin")
    return binned.groupBy("xbin", "ybin").agg(F.count(F.lit(1)).alias("n"))


def scatter_points(df: DataFrame, x: str, others: Sequence[str]) -> DataFrame:
    """O-54 exact form: long (other, x, y) pairs of one column against each other column."""
    arr = F.array(*[F.struct(F.lit(o).alias("other"), F.col(o).cast("double").alias("y")) for o in others])
    return df.select(F.col(x).cast("double").alias("x"), F.explode(arr).alias("_p")).select(
        F.col("_p.other").alias("other"), "x", F.col("_p.y").alias("y"))


def split_by_level(df: DataFrame, col: str, levels: Sequence[str]) -> dict[str, DataFrame]:
    """O-55: the rows of each level of a category in domain order, levels without rows left out (one count for all)."""
    held = {r[0] for r in df.filter(F.col(col).isin(list(levels))).select(col).distinct().collect()}   # at most one row a level
    return {v: df.filter(F.col(col) == v) for v in levels if v in held}
