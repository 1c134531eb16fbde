"""DuckDB SQL text for the registered queries (the correctness oracle).

Only string building lives here; the SQL is run by the checker, never by
the library.
"""

from __future__ import annotations

from collections.abc import Sequence

STATS = ["count", "mean", "q1", "median", "q3", "iqr", "std",
         "max", "min", "range", "outliers", "outliers_pct"]


def r(expr: str, places: int = 4) -> str:
    """Rounding used on both sides: round(x * 10^p) / 10^p."""
    s = float(10 ** places)
    return f"(round(({expr}) * {s}) / {s})"


def clean_cols(cols: Sequence[str]) -> str:
    """NaN -> NULL, as double (DuckDB isnan(NULL) is NULL, so CASE keeps NULL)."""
    return ", ".join(
        f"CASE WHEN isnan(CAST({c} AS DOUBLE)) THEN NULL ELSE CAST({c} AS DOUBLE) END AS {c}"
        for c in cols)


def nearest(c: str, q: float) -> str:
    return (f"(list_sort(list({c}) FILTER (WHERE {c} IS NOT NULL)))"
            f"[CAST(floor((count({c}) - 1) * {q!r} + 0.5) AS BIGINT) + 1]")


def linear(c: str, q: float) -> str:
    lst = f"(list_sort(list({c}) FILTER (WHERE {c} IS NOT NULL)))"
    h = f"((count({c}) - 1) * {q!r})"
    a = f"{lst}[CAST(floor({h}) AS BIGINT) + 1]"
    b = f"{lst}[CAST(ceil({h}) AS BIGINT) + 1]"
    return f"({a} + ({h} - floor({h})) * ({b} - {a}))"


def quartile_cte(src: str, cols: Sequence[str], name: str = "qt") -> str:
    """CTEs ``s`` (cleaned source) and ``{name}`` (one row of quartiles and fences)."""
    parts = []
    for c in cols:
        parts += [f"{nearest(c, 0.25)} AS {c}__q1", f"{nearest(c, 0.75)} AS {c}__q3",
                  f"{linear(c, 0.5)} AS {c}__med"]
    fence = ", ".join(
        f"{c}__q1, {c}__q3, {c}__med, {c}__q3 - {c}__q1 AS {c}__iqr, "
        f"{c}__q1 - 1.5 * ({c}__q3 - {c}__q1) AS {c}__lo, "
        f"{c}__q3 + 1.5 * ({c}__q3 - {c}__q1) AS {c}__hi" for c in cols)
    return (f"s AS (SELECT {clean_cols(cols)} FROM ({src}) src0), "
            f"{name}0 AS (SELECT {', '.join(parts)} FROM s), "
            f"{name} AS (SELECT {fence} FROM {name}0)")


def describe_sql(src: str, cols: Sequence[str], places: int = 4) -> str:
    """Long-form describe: (statistic, column, value)."""
    aggs = []
    for c in cols:
        out = f"count_if({c} < {c}__lo OR {c} > {c}__hi)"
        aggs += [
            f"CAST(count({c}) AS DOUBLE) AS {c}__count", f"avg({c}) AS {c}__mean",
            f"any_value({c}__q1) AS {c}__q1", f"any_value({c}__med) AS {c}__median",
            f"any_value({c}__q3) AS {c}__q3", f"any_value({c}__iqr) AS {c}__iqr",
            f"stddev_samp({c}) AS {c}__std", f"max({c}) AS {c}__max", f"min({c}) AS {c}__min",
            f"max({c}) - min({c}) AS {c}__range", f"CAST({out} AS DOUBLE) AS {c}__outliers",
            f"CASE WHEN count({c}) = 0 THEN NULL ELSE CAST({out} AS DOUBLE) * 100.0 / CAST(count({c}) AS DOUBLE) END AS {c}__outliers_pct",
        ]
    unions = " UNION ALL ".join(
        f"SELECT '{st}' AS statistic, '{c}' AS column, {r(f'{c}__{st}', places)} AS value FROM w"
        for c in cols for st in STATS)
    return (f"WITH {quartile_cte(src, cols)}, "
            f"w AS (SELECT {', '.join(aggs)} FROM s CROSS JOIN qt) {unions}")


def bin_sql(x: str, lo: str, hi: str, nb: str) -> str:
    """Equal-width bin with the same edge corrections as the Spark side."""
    g0 = (f"CAST(least(greatest(floor(({x} - {lo}) * (CAST({nb} AS DOUBLE) / ({hi} - {lo}))), 0), "
          f"{nb} - 1) AS INTEGER)")
    step = f"(({hi} - {lo}) / CAST({nb} AS DOUBLE))"
    g1 = f"(CASE WHEN {x} < {lo} + CAST({g0} AS DOUBLE) * {step} THEN {g0} - 1 ELSE {g0} END)"
    return (f"(CASE WHEN {hi} = {lo} THEN 0 WHEN {x} >= {lo} + CAST({g1} + 1 AS DOUBLE) * {step} "
            f"AND {g1} <> {nb} - 1 THEN {g1} + 1 ELSE {g1} END)")


def auto_bins_sql(n: str, lo: str, hi: str, iqr: str) -> str:
    """Automatic bin count: min(Sturges, Freedman-Diaconis) width."""
    st = f"(({hi} - {lo}) / (log2({n}) + 1.0))"
    fd = f"(2.0 * {iqr} * pow(CAST({n} AS DOUBLE), CAST(-1 AS DOUBLE) / 3.0))"
    width = f"(CASE WHEN {fd} > 0 THEN least({fd}, {st}) ELSE {st} END)"
    return (f"(CASE WHEN {n} = 0 OR {hi} = {lo} THEN 1 "
            f"ELSE greatest(1, CAST(ceil(({hi} - {lo}) / {width}) AS INTEGER)) END)")


def histogram_sql(src: str, cols: Sequence[str], bins: int | None = None, by: str | None = None,
                  places: int = 6) -> str:
    """Histogram with empty bins: column, [by], bin, bin_lo, bin_hi, n."""
    long = " UNION ALL ".join(
        f"SELECT '{c}' AS column, {c} AS x{', ' + by if by else ''} FROM s WHERE {c} IS NOT NULL" for c in cols)
    specs = []
    for c in cols:
        nb = str(bins) if bins else auto_bins_sql(f"count({c})", f"min({c})", f"max({c})",
                                                  f"({linear(c, 0.75)} - {linear(c, 0.25)})")
        specs.append(f"SELECT '{c}' AS column, min({c}) AS lo, max({c}) AS hi, {nb} AS nb FROM s")
    by_sel = f", {by}" if by else ""
    grid_by = f" CROSS JOIN (SELECT DISTINCT {by} FROM s) lb" if by else ""
    step = "((sp.hi - sp.lo) / CAST(sp.nb AS DOUBLE))"
    return f"""
WITH s AS (SELECT {clean_cols(cols)}{by_sel} FROM ({src}) src0),
sp AS ({' UNION ALL '.join(specs)}),
lg AS ({long}),
cnt AS (SELECT lg.column{', lg.' + by if by else ''}, {bin_sql('lg.x', 'sp.lo', 'sp.hi', 'sp.nb')} AS bin, count(*) AS n
        FROM lg JOIN sp ON lg.column = sp.column GROUP BY ALL),
grid AS (SELECT sp.column{by_sel}, CAST(b.range AS INTEGER) AS bin,
                sp.lo + CAST(b.range AS DOUBLE) * ((sp.hi - sp.lo) / CAST(sp.nb AS DOUBLE)) AS bin_lo,
                CASE WHEN b.range = sp.nb - 1 THEN sp.hi
                     ELSE sp.lo + CAST(b.range + 1 AS DOUBLE) * ((sp.hi - sp.lo) / CAST(sp.nb AS DOUBLE)) END AS bin_hi
         FROM sp CROSS JOIN range(0, (SELECT max(nb) FROM sp)) b{grid_by}
         WHERE b.range < sp.nb)
SELECT grid.column{', grid.' + by if by else ''}, grid.bin, {r('grid.bin_lo', places)} AS bin_lo,
       {r('grid.bin_hi', places)} AS bin_hi, CAST(coalesce(cnt.n, 0) AS BIGINT) AS n
FROM grid LEFT JOIN cnt ON grid.column = cnt.column AND grid.bin = cnt.bin
     {'AND grid.' + by + ' IS NOT DISTINCT FROM cnt.' + by if by else ''}
"""


def box_sql(src: str, cols: Sequence[str], places: int = 6) -> str:
    parts = []
    for c in cols:
        parts.append(f"""
SELECT '{c}' AS "column", q1, med AS median, q3, wlo AS whisker_lo, whi AS whisker_hi,
       (SELECT CAST(count_if({c} < wlo OR {c} > whi) AS BIGINT) FROM s) AS fliers
FROM (SELECT q1, med, q3,
        least((SELECT min({c}) FROM s WHERE {c} >= q1 - 1.5 * (q3 - q1)), q1) AS wlo,
        greatest((SELECT max({c}) FROM s WHERE {c} <= q3 + 1.5 * (q3 - q1)), q3) AS whi
      FROM (SELECT {linear(c, 0.25)} AS q1, {linear(c, 0.5)} AS med, {linear(c, 0.75)} AS q3 FROM s) t0) t1""")
    body = " UNION ALL ".join(parts)
    keep = ", ".join(f"{r(x, places)} AS {x}" for x in ["q1", "median", "q3", "whisker_lo", "whisker_hi"])
    return (f"WITH s AS (SELECT {clean_cols(cols)} FROM ({src}) src0) "
            f'SELECT "column", {keep}, fliers FROM ({body}) u')
