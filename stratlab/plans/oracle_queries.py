"""DuckDB oracle text for each registered query (same keys as ``queries.REGISTRY``)."""

from __future__ import annotations

from . import inputs as I
from .oracle import describe_sql, quartile_cte, r

ORACLE: dict[str, str] = {}


def _bad(cols_all: list[str], floats: list[str]) -> str:
    terms = [f"{c} IS NULL" for c in cols_all] + [f"coalesce(isnan({c}), false)" for c in floats]
    return "(" + " OR ".join(terms) + ")"


ORACLE["describe_measures"] = describe_sql(I.SQL["measures"], I.MEASURES)

_gap_cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag"]
_gap_bad = _bad(_gap_cols, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
_out3 = ["l_extendedprice", "l_quantity", "l_discount"]
ORACLE["quality_funnel"] = f"""
WITH g AS ({I.SQL['measures_with_gaps']}),
{quartile_cte(f"SELECT * FROM ({I.SQL['measures_with_gaps']}) g0 WHERE NOT {_gap_bad}", _out3)},
flags AS (
  SELECT {_gap_bad} AS bad,
         ({' OR '.join(f'(g.{c} < qt.{c}__lo OR g.{c} > qt.{c}__hi)' for c in _out3)}) AS outl
  FROM g CROSS JOIN qt)
SELECT CAST(count(*) AS BIGINT) AS total,
       CAST(count_if(bad) AS BIGINT) AS bad,
       CAST(count(*) - count_if(bad) AS BIGINT) AS used,
       CAST(count_if(NOT bad AND coalesce(outl, false)) AS BIGINT) AS outliers,
       {r("CAST(count_if(NOT bad AND coalesce(outl, false)) AS DOUBLE) / CAST(count(*) - count_if(bad) AS DOUBLE)", 6)} AS outlier_share
FROM flags
"""


# ------------------------------------------------------------ distributions
from .oracle import auto_bins_sql, bin_sql, box_sql, histogram_sql, linear  # noqa: E402

_merged = ("CASE WHEN event_type IN ('view', 'click', 'signup') THEN 'engaged' ELSE event_type END")

ORACLE["histogram_auto"] = histogram_sql(I.SQL["measures"], I.MEASURES)
ORACLE["histogram_by_label"] = histogram_sql(
    f"SELECT value, {_merged} AS event_group FROM events", ["value"], bins=30, by="event_group")

ORACLE["kde_curve"] = f"""
WITH s AS (SELECT value AS x FROM events WHERE value IS NOT NULL AND NOT isnan(value)),
st AS (SELECT count(x) AS n, min(x) AS lo, max(x) AS hi, stddev_samp(x) AS sd,
              {linear('x', 0.75)} - {linear('x', 0.25)} AS iqr FROM s),
p AS (SELECT n, lo, hi, sd * pow(CAST(n AS DOUBLE), -0.2) AS bw, (hi - lo) / 199.0 AS step,
             (hi - lo) / CAST({auto_bins_sql('n', 'lo', 'hi', 'iqr')} AS DOUBLE) AS binw FROM st),
g AS (SELECT CAST(range AS INTEGER) AS i,
             CASE WHEN range = 199 THEN hi ELSE lo + CAST(range AS DOUBLE) * step END AS gx FROM p, range(0, 200)),
d AS (SELECT g.i, any_value(g.gx) AS gx, sum(exp(-0.5 * pow((g.gx - s.x) / p.bw, 2))) AS sm
      FROM g CROSS JOIN s CROSS JOIN p GROUP BY g.i)
SELECT 'value' AS column, d.i, {r('d.gx', 6)} AS x,
       {r('d.sm * (1.0 / (p.n * p.bw * sqrt(2 * pi())))', 10)} AS density,
       {r('d.sm * ((1.0 / (p.n * p.bw * sqrt(2 * pi()))) * p.n * p.binw)', 4)} AS count_scaled
FROM d CROSS JOIN p
"""

ORACLE["box_summary"] = box_sql(I.SQL["measures"], I.MEASURES)

_prio_parts = []
for _i, _p in enumerate(I.PRIORITIES):
    _prio_parts.append(
        f"SELECT '{_p}' AS o_orderpriority, {_i + 1} AS rank, * EXCLUDE (\"column\") FROM ("
        + box_sql(f"SELECT o_totalprice AS v FROM orders WHERE o_orderpriority = '{_p}'", ["v"]) + ") b")
ORACLE["box_summary_by_priority"] = " UNION ALL ".join(_prio_parts)

ORACLE["ecdf"] = f"""
WITH d AS (SELECT value, count(*) AS n FROM events WHERE value IS NOT NULL AND NOT isnan(value) GROUP BY value)
SELECT value, CAST(n AS BIGINT) AS n, CAST(sum(n) OVER (ORDER BY value) AS BIGINT) AS cum_n,
       {r('CAST(sum(n) OVER (ORDER BY value) AS DOUBLE) / (SELECT sum(n) FROM d)', 8)} AS ecdf
FROM d
"""

ORACLE["binned_scatter"] = f"""
WITH s AS (SELECT l_quantity AS x, l_extendedprice AS y FROM lineitem
           WHERE l_quantity IS NOT NULL AND l_extendedprice IS NOT NULL),
m AS (SELECT min(x) AS xl, max(x) AS xh, min(y) AS yl, max(y) AS yh FROM s)
SELECT {bin_sql('x', 'xl', 'xh', '50')} AS xbin, {bin_sql('y', 'yl', 'yh', '50')} AS ybin, count(*) AS n
FROM s CROSS JOIN m GROUP BY ALL
"""

ORACLE["scatter_points"] = """
SELECT 'user_id' AS other, value AS x, CAST(user_id AS DOUBLE) AS y FROM events
UNION ALL SELECT 'event_id', value, CAST(event_id AS DOUBLE) FROM events
"""

ORACLE["mercator_points"] = f"""
SELECT c_custkey, c_mktsegment,
       {r('6378137.0 * radians(c_acctbal / 100.0)', 2)} AS x_m,
       {r('6378137.0 * ln(tan(pi() / 4 + radians(CAST(c_custkey % 170 - 85 AS DOUBLE)) / 2))', 2)} AS y_m
FROM customer
"""


# ------------------------------------------------------ columns and filters
_gsrc = I.SQL["measures_with_gaps"]
ORACLE["describe_bad_rows"] = describe_sql(
    f"SELECT * FROM ({_gsrc}) g WHERE {_gap_bad}", ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
ORACLE["complete_rows"] = f"SELECT * FROM ({_gsrc}) g WHERE NOT {_gap_bad}"
ORACLE["non_null_rows_by_flag"] = f"""
SELECT l_returnflag, count(*) AS n FROM ({_gsrc}) g
WHERE l_quantity IS NOT NULL AND l_extendedprice IS NOT NULL AND l_discount IS NOT NULL
  AND l_tax IS NOT NULL AND l_returnflag IS NOT NULL GROUP BY l_returnflag"""
_types = ", ".join(f"'{t}'" for t in I.EVENT_TYPES)
ORACLE["category_guard"] = f"""
SELECT event_id, event_type, CAST(list_position([{_types}], event_type) AS INTEGER) AS type_rank,
       event_type IN ('view', 'click', 'signup') AS is_engaged, event_type = 'purchase' AS is_purchase
FROM events"""
ORACLE["category_merge"] = f"""
SELECT event_id, {_merged} AS event_group,
       CAST(list_position(['error', 'engaged', 'purchase'], {_merged}) AS INTEGER) AS group_rank
FROM events"""
ORACLE["level_counts_row"] = """
SELECT CAST(count_if(event_type = 'view') AS BIGINT) AS view, CAST(count_if(event_type = 'click') AS BIGINT) AS click,
       CAST(count_if(event_type = 'signup') AS BIGINT) AS signup FROM events"""
ORACLE["level_frequency"] = f"""
WITH d(l_returnflag, rank) AS (VALUES ('A', 1), ('N', 2), ('R', 3)),
c AS (SELECT l_returnflag, count(*) AS n FROM ({_gsrc}) g WHERE {_gap_bad} GROUP BY l_returnflag)
SELECT d.l_returnflag, CAST(d.rank AS INTEGER) AS rank, CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM d LEFT JOIN c USING (l_returnflag)"""
ORACLE["level_share"] = f"""
WITH d(event_group, rank) AS (VALUES ('error', 1), ('engaged', 2), ('purchase', 3)),
c AS (SELECT {_merged} AS event_group, count(*) AS n FROM events GROUP BY 1),
f AS (SELECT d.event_group, CAST(d.rank AS INTEGER) AS rank, CAST(coalesce(c.n, 0) AS BIGINT) AS n
      FROM d LEFT JOIN c USING (event_group))
SELECT event_group, rank, n, {r('n * 100.0 / sum(n) OVER ()', 6)} AS share_pct FROM f WHERE n > 0"""
ORACLE["select_by_type"] = """
SELECT o_custkey, o_totalprice AS total_price, o_totalprice AS total_price_copy, 'orders' AS source FROM orders"""
ORACLE["ratio_columns"] = f"""
SELECT l_orderkey, l_linenumber,
       {r('l_extendedprice / nullif(l_quantity, 0)', 6)} AS price_per_unit,
       {r('l_tax / nullif(l_discount, 0)', 6)} AS tax_per_discount,
       {r('l_extendedprice * l_discount / nullif(l_quantity, 0)', 6)} AS discount_per_unit
FROM lineitem"""
ORACLE["log_columns"] = f"""
SELECT l_orderkey, l_linenumber,
       {r('CASE WHEN l_quantity > 0 THEN ln(l_quantity) END', 6)} AS l_quantity_ln,
       {r('CASE WHEN l_discount > 0 THEN ln(l_discount) END', 6)} AS l_discount_ln,
       {r('CASE WHEN l_tax > 0 THEN ln(l_tax) END', 6)} AS l_tax_ln
FROM lineitem"""
ORACLE["signed_values"] = f"SELECT event_id, -value AS neg_value, {r('abs(value - 100.0)', 6)} AS dist_100 FROM events"
_o3 = ["target", "x_quantity", "x_tax_ratio"]
ORACLE["outlier_free_rows"] = f"""
WITH {quartile_cte(I.SQL['regression_table'], _o3)}, t AS ({I.SQL['regression_table']})
SELECT t.row_key, t.target FROM t CROSS JOIN qt
WHERE NOT coalesce({' OR '.join(f'(t.{c} < qt.{c}__lo OR t.{c} > qt.{c}__hi)' for c in _o3)}, false)"""
ORACLE["target_summary"] = f"""
SELECT min(value) AS minimum, {r('avg(value)', 6)} AS mean, max(value) AS maximum, count(value) AS rows FROM events"""
_ccols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_cpairs = []
for _i, _a in enumerate(_ccols):
    for _b in _ccols[:_i]:
        _cpairs.append(
            f"SELECT '{_a}' AS column_a, '{_b}' AS column_b, "
            f"{r(f'covar_samp({_a}, {_b}) / nullif(stddev_samp({_a}) * stddev_samp({_b}), 0)', 6)} AS r FROM c")
ORACLE["correlation_pairs"] = (
    f"WITH c AS (SELECT * FROM ({_gsrc}) g WHERE l_quantity IS NOT NULL AND NOT isnan(l_quantity) "
    f"AND l_extendedprice IS NOT NULL AND l_discount IS NOT NULL AND l_tax IS NOT NULL) "
    + " UNION ALL ".join(_cpairs))


# ------------------------------------------------------------ sampling
_pos = """
e AS (SELECT event_id, event_type, value, md5(concat(CAST(event_id AS VARCHAR), '|', '42')) AS h FROM events),
c AS (SELECT event_type, count(*) AS n FROM e GROUP BY 1),
st AS (SELECT event_type, sum(n) OVER (ORDER BY event_type ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - n AS start FROM c),
rk AS (SELECT e.*, st.start + row_number() OVER (PARTITION BY e.event_type ORDER BY h, event_id) - 1 AS pos,
              row_number() OVER (PARTITION BY e.event_type ORDER BY h, event_id) AS rn
       FROM e JOIN st USING (event_type))"""
_alloc = """
tot AS (SELECT sum(n) AS total, CAST(floor(0.1 * sum(n)) AS BIGINT) AS draws FROM c),
a AS (SELECT event_type, n * draws / total AS cont FROM c, tot),
q0 AS (SELECT event_type, floor(cont) AS fl,
              row_number() OVER (ORDER BY cont - floor(cont) DESC, event_type) AS ord FROM a),
q AS (SELECT event_type, fl + CASE WHEN ord <= (SELECT draws FROM tot) - (SELECT sum(fl) FROM q0) THEN 1 ELSE 0 END AS quota
      FROM q0)"""
ORACLE["stratified_sample"] = f"""WITH {_pos}, {_alloc}
SELECT event_id, event_type, value FROM rk JOIN q USING (event_type) WHERE rn <= quota"""
ORACLE["sample_complement"] = f"""WITH {_pos}, {_alloc}
SELECT event_id, event_type FROM rk JOIN q USING (event_type) WHERE rn > quota"""
ORACLE["stratified_folds"] = f"""WITH {_pos}
SELECT event_id, event_type, CAST(pos % 10 AS INTEGER) AS fold FROM rk"""
ORACLE["inner_folds"] = f"""WITH {_pos}
SELECT event_id, CAST(j.range AS INTEGER) AS outer_fold,
       CAST((pos - floor((pos + 9 - j.range) / 10)) % 10 AS INTEGER) AS inner_fold
FROM rk CROSS JOIN range(0, 10) j WHERE pos % 10 <> j.range"""


# ------------------------------------------------------------ clustering
_single = """
d AS (SELECT value AS x, CAST(count(*) AS DOUBLE) AS n, value * CAST(count(*) AS DOUBLE) AS s
      FROM events WHERE value IS NOT NULL AND NOT isnan(value) GROUP BY value),
g AS (SELECT lag(x) OVER (ORDER BY x) AS boundary, x - lag(x) OVER (ORDER BY x) AS height FROM d),
top AS (SELECT boundary, height, row_number() OVER (ORDER BY height DESC, boundary) AS rk
        FROM g WHERE boundary IS NOT NULL),
ks AS (SELECT CAST(range AS INTEGER) AS k FROM range(2, 11)),
thr AS (SELECT k, (SELECT height FROM top WHERE rk = k) AS h FROM ks),
cuts AS (SELECT thr.k, top.boundary FROM thr JOIN top ON top.rk <= 10 AND (thr.h IS NULL OR top.height > thr.h))"""
ORACLE["dendrogram_single"] = f"""WITH {_single}
SELECT boundary, {r('height', 6)} AS height FROM g WHERE boundary IS NOT NULL"""
ORACLE["single_linkage_labels"] = f"""WITH {_single}
SELECT e.event_id, ks.k, CAST(1 + (SELECT count(*) FROM cuts c WHERE c.k = ks.k AND c.boundary < e.value) AS INTEGER) AS cluster
FROM events e CROSS JOIN ks"""
ORACLE["cluster_sizes_single"] = f"""WITH {_single}
SELECT cluster, count(*) AS n FROM (
  SELECT CAST(1 + (SELECT count(*) FROM cuts c WHERE c.k = 4 AND c.boundary < e.value) AS INTEGER) AS cluster
  FROM events e) t GROUP BY cluster"""
ORACLE["silhouette_single"] = f"""WITH {_single},
lab AS (SELECT ks.k, d.x, d.n, d.s,
               CAST(1 + (SELECT count(*) FROM cuts c WHERE c.k = ks.k AND c.boundary < d.x) AS INTEGER) AS label
        FROM d CROSS JOIN ks),
cl AS (SELECT k, label, sum(n) AS C_n, sum(s) AS C_s FROM lab GROUP BY k, label),
cl2 AS (SELECT k, label, C_n, C_s,
               lag(C_s) OVER (PARTITION BY k ORDER BY label) / lag(C_n) OVER (PARTITION BY k ORDER BY label) AS m_prev,
               lead(C_s) OVER (PARTITION BY k ORDER BY label) / lead(C_n) OVER (PARTITION BY k ORDER BY label) AS m_next
        FROM cl),
pt AS (SELECT lab.*, cl2.C_n, cl2.C_s, cl2.m_prev, cl2.m_next,
              sum(lab.n) OVER (PARTITION BY lab.k, lab.label ORDER BY lab.x) AS cnt_le,
              sum(lab.s) OVER (PARTITION BY lab.k, lab.label ORDER BY lab.x) AS sum_le
       FROM lab JOIN cl2 USING (k, label)),
ab AS (SELECT k, label, n,
              CASE WHEN C_n > 1 THEN (x * cnt_le - sum_le + (C_s - sum_le) - x * (C_n - cnt_le)) / (C_n - 1) END AS a,
              least(abs(x - m_prev), abs(x - m_next)) AS b, C_n FROM pt),
sv AS (SELECT k, label, n, CASE WHEN C_n <= 1 THEN 0.0
                                ELSE coalesce((b - a) / nullif(greatest(a, b), 0), 0.0) END AS sil FROM ab)
SELECT 'single' AS linkage, k, {r('sum(sil * n) / sum(n)', 6)} AS silhouette,
       CAST(count(DISTINCT label) AS INTEGER) AS clusters
FROM sv GROUP BY k"""


# ------------------------------------------------------------ features, models, results
ORACLE["one_hot_category"] = f"""
SELECT row_key, category, CAST(category = 'A' AS DOUBLE) AS category_A, CAST(category = 'N' AS DOUBLE) AS category_N,
       CAST(category = 'R' AS DOUBLE) AS category_R, 2 AS linear_levels FROM ({I.SQL['regression_table']}) t"""
ORACLE["standardized_features"] = f"""
WITH t AS ({I.SQL['regression_table']}),
m AS (SELECT avg(x_quantity) AS mq, stddev_pop(x_quantity) AS sq, avg(x_tax_ratio) AS mr, stddev_pop(x_tax_ratio) AS sr FROM t)
SELECT row_key, {r('(x_quantity - mq) / sq', 6)} AS x_quantity, {r('(x_tax_ratio - mr) / sr', 6)} AS x_tax_ratio
FROM t CROSS JOIN m"""
_fm = f"""
{quartile_cte(I.SQL['regression_table'], ['target', 'x_quantity', 'x_tax_ratio'])},
base AS ({I.SQL['regression_table']}),
wo AS (SELECT b.* FROM base b CROSS JOIN qt WHERE NOT coalesce(
        (b.target < qt.target__lo OR b.target > qt.target__hi) OR
        (b.x_quantity < qt.x_quantity__lo OR b.x_quantity > qt.x_quantity__hi) OR
        (b.x_tax_ratio < qt.x_tax_ratio__lo OR b.x_tax_ratio > qt.x_tax_ratio__hi), false)),
ds AS (SELECT 'with_outliers' AS dataset, * FROM base UNION ALL SELECT 'without_outliers' AS dataset, * FROM wo),
hs AS (SELECT *, md5(concat(row_key, '|', '42')) AS h FROM ds),
c AS (SELECT dataset, stratum, count(*) AS n FROM hs GROUP BY ALL),
st AS (SELECT dataset, stratum,
              sum(n) OVER (PARTITION BY dataset ORDER BY stratum ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - n AS start
       FROM c),
fd AS (SELECT hs.*, CAST((st.start + row_number() OVER (PARTITION BY hs.dataset, hs.stratum ORDER BY hs.h, hs.row_key) - 1) % 10 AS INTEGER) AS fold
       FROM hs JOIN st USING (dataset, stratum)),
feat AS (SELECT dataset, fold, target, 'ols_quantity' AS model, 'x_quantity' AS feature, x_quantity AS x FROM fd
         UNION ALL SELECT dataset, fold, target, 'ols_tax_ratio', 'x_tax_ratio', x_tax_ratio FROM fd
         UNION ALL SELECT dataset, fold, target, 'ols_tax', 'x_tax', x_tax FROM fd),
folds AS (SELECT DISTINCT dataset, fold FROM fd),
coef AS (SELECT f.dataset, t.model, any_value(t.feature) AS feature, f.fold, regr_slope(t.target, t.x) AS b,
                regr_intercept(t.target, t.x) AS a, stddev_pop(t.x) AS sdx
         FROM folds f JOIN feat t ON t.dataset = f.dataset AND t.fold <> f.fold GROUP BY f.dataset, t.model, f.fold),
pred AS (SELECT t.dataset, t.model, t.fold, t.target, t.target - (c.a + c.b * t.x) AS e
         FROM feat t JOIN coef c USING (dataset, model, fold)),
tm AS (SELECT dataset, avg(target) AS target_mean FROM fd GROUP BY dataset),
w AS (SELECT dataset, model, fold, 1 - sum(e * e) / (var_pop(target) * count(*)) AS r2,
             sqrt(avg(e * e)) AS rmse, avg(abs(e)) AS mae FROM pred GROUP BY ALL),
fm AS (SELECT w.dataset, model, fold, m.metric,
              CASE m.metric WHEN 'r2' THEN r2 WHEN 'rmse' THEN rmse ELSE mae END AS value,
              CASE m.metric WHEN 'r2' THEN NULL WHEN 'rmse' THEN rmse / tm.target_mean ELSE mae / tm.target_mean END
                AS share_of_target_mean
       FROM w JOIN tm USING (dataset) CROSS JOIN (VALUES ('r2'), ('rmse'), ('mae')) m(metric)),
im AS (SELECT dataset, model, fold, feature, abs(b * sdx) AS importance FROM coef),
mm AS (SELECT dataset, model, metric, avg(value) AS mean_value, avg(share_of_target_mean) AS mean_share
       FROM fm GROUP BY ALL)"""
_morder = ", ".join(f"'{m}'" for m in ["linear", "tree", "forest", "ols_quantity", "ols_tax_ratio", "ols_tax"])
ORACLE["linear_cv_metrics"] = f"""WITH {_fm}
SELECT dataset, model, fold, metric, {r('value', 4)} AS value, {r('share_of_target_mean', 6)} AS share_of_target_mean FROM fm"""
ORACLE["linear_cv_importance"] = f"""WITH {_fm}
SELECT dataset, model, fold, feature, {r('importance', 6)} AS importance FROM im"""
ORACLE["model_means"] = f"""WITH {_fm}
SELECT dataset, model, metric, {r('mean_value', 4)} AS mean_value, {r('mean_share', 6)} AS mean_share FROM mm"""
ORACLE["model_ranking"] = f"""WITH {_fm}
SELECT dataset, model, {r('mean_value', 6)} AS mean_r2,
       CAST(row_number() OVER (PARTITION BY dataset ORDER BY mean_value DESC, list_position([{_morder}], model)) AS INTEGER) AS position,
       row_number() OVER (PARTITION BY dataset ORDER BY mean_value DESC, list_position([{_morder}], model)) = 1 AS is_best
FROM mm WHERE metric = 'r2'"""
ORACLE["outlier_sensitivity"] = f"""WITH {_fm},
p AS (SELECT model, metric, max(CASE WHEN dataset = 'with_outliers' THEN mean_value END) AS wv,
             max(CASE WHEN dataset = 'without_outliers' THEN mean_value END) AS wov FROM mm GROUP BY ALL),
t2 AS (SELECT max(CASE WHEN dataset = 'with_outliers' THEN target_mean END) AS tw,
              max(CASE WHEN dataset = 'without_outliers' THEN target_mean END) AS two FROM tm)
SELECT model, metric, {r('wv', 4)} AS with_value, {r('wov', 4)} AS without_value, {r('wov - wv', 4)} AS difference,
       {r("CASE WHEN metric <> 'r2' THEN wov / two - wv / tw END", 8)} AS normalised_difference
FROM p CROSS JOIN t2"""
ORACLE["r2_bars"] = f"""WITH {_fm}
SELECT model, dataset, {r('mean_value', 6)} AS mean_r2, CAST(list_position([{_morder}], model) AS INTEGER) AS model_rank,
       CAST(list_position(['with_outliers', 'without_outliers'], dataset) AS INTEGER) AS dataset_rank
FROM mm WHERE metric = 'r2'"""
ORACLE["importance_order"] = f"""WITH {_fm},
sm AS (SELECT dataset, model, feature, avg(importance) AS mi FROM im GROUP BY ALL),
a AS (SELECT model, feature, avg(mi) AS across FROM sm GROUP BY ALL)
SELECT model, feature, {r('across', 6)} AS across_datasets,
       CAST(row_number() OVER (PARTITION BY model ORDER BY across DESC, feature) AS INTEGER) AS "order" FROM a"""


_nested = _fm.split("feat AS (")[0].replace(
    "fd AS (SELECT hs.*, CAST((st.start + row_number() OVER (PARTITION BY hs.dataset, hs.stratum ORDER BY hs.h, hs.row_key) - 1) % 10 AS INTEGER) AS fold",
    "fd AS (SELECT hs.*, st.start + row_number() OVER (PARTITION BY hs.dataset, hs.stratum ORDER BY hs.h, hs.row_key) - 1 AS pos")
_nested += """
cells AS (SELECT dataset, target, x_quantity, x_tax_ratio, x_tax, CAST(j.range AS INTEGER) AS outer_f,
                 CAST((pos - floor((pos + 9 - j.range) / 10)) % 10 AS INTEGER) AS inner_f
          FROM fd CROSS JOIN range(0, 10) j WHERE pos % 10 <> j.range),
cf AS (SELECT dataset, outer_f, inner_f, 0 AS cand, target, x_quantity AS x FROM cells
       UNION ALL SELECT dataset, outer_f, inner_f, 1, target, x_tax_ratio FROM cells
       UNION ALL SELECT dataset, outer_f, inner_f, 2, target, x_tax FROM cells),
combos AS (SELECT DISTINCT dataset, outer_f, inner_f FROM cells),
icoef AS (SELECT c.dataset, c.outer_f, c.inner_f, t.cand, regr_slope(t.target, t.x) AS b, regr_intercept(t.target, t.x) AS a
          FROM combos c JOIN cf t ON t.dataset = c.dataset AND t.outer_f = c.outer_f AND t.inner_f <> c.inner_f
          GROUP BY c.dataset, c.outer_f, c.inner_f, t.cand),
ipred AS (SELECT t.dataset, t.outer_f, t.inner_f, t.cand, t.target, t.target - (k.a + k.b * t.x) AS e
          FROM cf t JOIN icoef k USING (dataset, outer_f, inner_f, cand)),
ir2 AS (SELECT dataset, outer_f, inner_f, cand, 1 - sum(e * e) / (var_pop(target) * count(*)) AS r2 FROM ipred GROUP BY ALL),
cs AS (SELECT dataset, 'ols_select' AS model, outer_f AS outer_fold, cand AS candidate_idx, avg(r2) AS mean_r2 FROM ir2 GROUP BY ALL),
bestc AS (SELECT dataset, outer_fold, candidate_idx FROM (
            SELECT *, row_number() OVER (PARTITION BY dataset, outer_fold ORDER BY mean_r2 DESC, candidate_idx) AS rn FROM cs) z
          WHERE rn = 1),
fdf AS (SELECT *, CAST(pos % 10 AS INTEGER) AS fold FROM fd),
ofe AS (SELECT dataset, fold, target, 0 AS cand, x_quantity AS x FROM fdf
        UNION ALL SELECT dataset, fold, target, 1, x_tax_ratio FROM fdf
        UNION ALL SELECT dataset, fold, target, 2, x_tax FROM fdf),
ocoef AS (SELECT b.dataset, b.outer_fold, b.candidate_idx, regr_slope(t.target, t.x) AS b1, regr_intercept(t.target, t.x) AS b0
          FROM bestc b JOIN ofe t ON t.dataset = b.dataset AND t.fold <> b.outer_fold AND t.cand = b.candidate_idx
          GROUP BY ALL),
opred AS (SELECT t.dataset, t.fold, t.target, t.target - (k.b0 + k.b1 * t.x) AS e
          FROM ofe t JOIN ocoef k ON t.dataset = k.dataset AND t.fold = k.outer_fold AND t.cand = k.candidate_idx),
ow AS (SELECT dataset, fold, 1 - sum(e * e) / (var_pop(target) * count(*)) AS r2, sqrt(avg(e * e)) AS rmse,
              avg(abs(e)) AS mae FROM opred GROUP BY ALL),
ob AS (SELECT dataset, candidate_idx, avg(mean_r2) AS om FROM cs GROUP BY ALL),
obest AS (SELECT dataset, candidate_idx, om FROM (
            SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY om DESC, candidate_idx) AS rn FROM ob) z WHERE rn = 1)"""
_feat_name = "CASE candidate_idx WHEN 0 THEN 'x_quantity' WHEN 1 THEN 'x_tax_ratio' ELSE 'x_tax' END"
ORACLE["feature_search_scores"] = f"""WITH {_nested}
SELECT dataset, model, outer_fold, candidate_idx, {r('mean_r2', 6)} AS mean_r2 FROM cs"""
ORACLE["feature_search_params"] = f"""WITH {_nested}
SELECT dataset, 'ols_select' AS model, outer_fold AS fold, 'feature' AS name, {_feat_name} AS value FROM bestc"""
ORACLE["feature_search_metrics"] = f"""WITH {_nested}
SELECT dataset, 'ols_select' AS model, fold, m.metric,
       {r("CASE m.metric WHEN 'r2' THEN r2 WHEN 'rmse' THEN rmse ELSE mae END", 4)} AS value
FROM ow CROSS JOIN (VALUES ('r2'), ('rmse'), ('mae')) m(metric)"""
ORACLE["best_candidate"] = f"""WITH {_nested}
SELECT dataset, 'ols_select' AS model, candidate_idx, {r('om', 6)} AS overall_mean_r2 FROM obest"""
ORACLE["hyperparameter_comparison"] = f"""WITH {_nested},
bp AS (SELECT dataset, {_feat_name} AS value FROM obest)
SELECT 'ols_select' AS model, 'feature' AS name, a.value AS with_value, b.value AS without_value,
       a.value IS NOT DISTINCT FROM b.value AS equal
FROM (SELECT value FROM bp WHERE dataset = 'with_outliers') a, (SELECT value FROM bp WHERE dataset = 'without_outliers') b"""


# one-split trees: the best split of every fit by cumulative sums over the values of each feature
_leaves = [1, 1_000, 4_000]
_stump = _fm.split("feat AS (")[0].replace(
    "fd AS (SELECT hs.*, CAST((st.start + row_number() OVER (PARTITION BY hs.dataset, hs.stratum ORDER BY hs.h, hs.row_key) - 1) % 10 AS INTEGER) AS fold",
    "fd0 AS (SELECT hs.*, st.start + row_number() OVER (PARTITION BY hs.dataset, hs.stratum ORDER BY hs.h, hs.row_key) - 1 AS pos")
_stump += f"""
ym AS (SELECT dataset, avg(target) AS y0 FROM fd0 GROUP BY dataset),
fd AS (SELECT fd0.*, target - y0 AS y, CAST(pos % 10 AS INTEGER) AS fold, CAST(floor(pos / 10) AS BIGINT) % 10 AS c FROM fd0 JOIN ym USING (dataset)),
lg AS (SELECT dataset, fold, c, y, 0 AS f, x_quantity AS v FROM fd UNION ALL SELECT dataset, fold, c, y, 1, x_tax_ratio FROM fd
       UNION ALL SELECT dataset, fold, c, y, 2, CAST(category = 'A' AS DOUBLE) FROM fd
       UNION ALL SELECT dataset, fold, c, y, 3, CAST(category = 'N' AS DOUBLE) FROM fd
       UNION ALL SELECT dataset, fold, c, y, 4, CAST(category = 'R' AS DOUBLE) FROM fd),
cell AS (SELECT dataset, fold, c, f, v, CAST(count(*) AS DOUBLE) AS n, sum(y) AS s, sum(y * y) AS q FROM lg GROUP BY ALL),
role AS (SELECT cell.*, CAST(o.range AS INTEGER) AS o, CAST(i.range AS INTEGER) AS i,
                CASE WHEN i.range = -1 THEN fold = o.range
                     ELSE (fold - CASE WHEN fold > o.range THEN 1 ELSE 0 END - c + 20) % 10 = i.range END AS held
         FROM cell CROSS JOIN range(0, 10) o CROSS JOIN range(-1, 10) i WHERE fold <> o.range OR i.range = -1),
fv AS (SELECT dataset, o, i, f, v, sum(CASE WHEN held THEN 0 ELSE n END) AS tn, sum(CASE WHEN held THEN 0 ELSE s END) AS ts,
              sum(CASE WHEN held THEN n ELSE 0 END) AS hn, sum(CASE WHEN held THEN s ELSE 0 END) AS hs,
              sum(CASE WHEN held THEN q ELSE 0 END) AS hq FROM role GROUP BY ALL),
cu AS (SELECT dataset, o, i, f, v, sum(tn) OVER u AS ln, sum(ts) OVER u AS ls, sum(hn) OVER u AS lhn, sum(hs) OVER u AS lhs,
              sum(tn) OVER a AS N, sum(ts) OVER a AS S, sum(hn) OVER a AS HN, sum(hs) OVER a AS HS, sum(hq) OVER a AS HQ
       FROM fv WINDOW u AS (PARTITION BY dataset, o, i, f ORDER BY v ROWS UNBOUNDED PRECEDING), a AS (PARTITION BY dataset, o, i, f)),
sp AS (SELECT cu.*, l.idx, l.leaf, ls * ls / ln + (S - ls) * (S - ls) / (N - ln) - S * S / N AS gain
       FROM cu CROSS JOIN (VALUES {', '.join(f'({i}, {x})' for i, x in enumerate(_leaves))}) l(idx, leaf)
       WHERE ln >= leaf AND N - ln >= leaf),
top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY dataset, o, i, idx ORDER BY gain DESC, f, v) AS rn FROM sp WHERE gain > 0) z WHERE rn = 1),
al AS (SELECT DISTINCT dataset, o, i, N, S, HN, HS, HQ, l.idx FROM (SELECT * FROM cu WHERE f = 3) c
       CROSS JOIN (VALUES {', '.join(f'({i})' for i in range(len(_leaves)))}) l(idx)),
bs AS (SELECT al.*, coalesce(t.f, 0) AS f, coalesce(t.v, CAST('infinity' AS DOUBLE)) AS v, coalesce(t.lhn, 0) AS lhn, coalesce(t.lhs, 0) AS lhs,
              coalesce(t.ls / t.ln, al.S / al.N) AS ml, coalesce((t.S - t.ls) / (t.N - t.ln), al.S / al.N) AS mr
       FROM al LEFT JOIN top t ON t.dataset = al.dataset AND t.o = al.o AND t.i = al.i AND t.idx = al.idx),
ir AS (SELECT dataset, o, idx, 1 - (HQ - 2 * (ml * lhs + mr * (HS - lhs)) + ml * ml * lhn + mr * mr * (HN - lhn)) / (HQ - HS * HS / HN) AS r2
       FROM bs WHERE i >= 0),
cs AS (SELECT dataset, o, idx, avg(r2) AS mean_r2 FROM ir GROUP BY ALL),
ch AS (SELECT dataset, o, idx FROM (
         SELECT *, row_number() OVER (PARTITION BY dataset, o ORDER BY round(mean_r2, 9) DESC, idx) AS rn FROM cs) z WHERE rn = 1),
rf AS (SELECT bs.* FROM bs JOIN ch USING (dataset, o, idx) WHERE bs.i = -1),
er AS (SELECT fd.dataset, fd.fold, fd.y, fd.y - CASE WHEN (CASE rf.f WHEN 0 THEN x_quantity WHEN 1 THEN x_tax_ratio
              WHEN 2 THEN CAST(category = 'A' AS DOUBLE) WHEN 3 THEN CAST(category = 'N' AS DOUBLE) ELSE CAST(category = 'R' AS DOUBLE) END) <= rf.v
              THEN ml ELSE mr END AS e FROM fd JOIN rf ON rf.dataset = fd.dataset AND rf.o = fd.fold),
sw AS (SELECT dataset, fold, 1 - sum(e * e) / (var_pop(y) * count(*)) AS r2, sqrt(avg(e * e)) AS rmse, avg(abs(e)) AS mae FROM er GROUP BY ALL),
leaf AS (SELECT * FROM (VALUES {', '.join(f"({i}, '{x}')" for i, x in enumerate(_leaves))}) l(idx, value))"""
ORACLE["stump_search_scores"] = f"""WITH {_stump}
SELECT dataset, o AS outer_fold, idx AS candidate_idx, {r('mean_r2', 6)} AS mean_r2 FROM cs"""
ORACLE["stump_search_metrics"] = f"""WITH {_stump}
SELECT dataset, fold, m.metric, {r("CASE m.metric WHEN 'r2' THEN r2 WHEN 'rmse' THEN rmse ELSE mae END", 4)} AS value
FROM sw CROSS JOIN (VALUES ('r2'), ('rmse'), ('mae')) m(metric)"""
ORACLE["stump_search_params"] = f"""WITH {_stump}
SELECT dataset, o AS fold, 'minInstancesPerNode' AS name, value FROM ch JOIN leaf USING (idx)
UNION ALL SELECT dataset, o, 'maxDepth', '1' FROM ch"""
ORACLE["stump_best_params"] = f"""WITH {_stump},
ob AS (SELECT dataset, idx, row_number() OVER (PARTITION BY dataset ORDER BY round(avg(mean_r2), 9) DESC, idx) AS rn FROM cs GROUP BY dataset, idx),
bp AS (SELECT dataset, 'minInstancesPerNode' AS name, value FROM ob JOIN leaf USING (idx) WHERE rn = 1
       UNION ALL SELECT dataset, 'maxDepth', '1' FROM ob WHERE rn = 1)
SELECT 'tree' AS model, a.name, a.value AS with_value, b.value AS without_value, a.value IS NOT DISTINCT FROM b.value AS equal
FROM bp a JOIN bp b USING (name) WHERE a.dataset = 'with_outliers' AND b.dataset = 'without_outliers'"""



# ------------------------------------------------------------ sources and report
ORACLE["typed_scan"] = "SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem"
_der = ("SELECT l_extendedprice / nullif(l_quantity, 0) AS price_per_unit, "
        "l_tax / nullif(l_discount, 0) AS tax_per_discount, l_quantity FROM lineitem")
_groups_sql = f"""
SELECT 'null_or_nan' AS "group", 'null_or_nan_stats_' || statistic || '.json' AS file, statistic, "column", value
FROM ({describe_sql(f"SELECT * FROM ({_gsrc}) g WHERE {_gap_bad}", ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])}) a
UNION ALL
SELECT 'raw', 'stats_' || statistic || '.json', statistic, "column", value FROM ({describe_sql(I.SQL["measures"], I.MEASURES)}) b
UNION ALL
SELECT 'derived', 'derived_stats_' || statistic || '.json', statistic, "column", value
FROM ({describe_sql(_der, ["price_per_unit", "tax_per_discount", "l_quantity"])}) c"""
ORACLE["stats_groups"] = _groups_sql


def _fmt(v: str) -> str:
    return (f"CASE WHEN {v} IS NULL OR isnan({v}) THEN '--' "
            f"WHEN statistic IN ('count', 'outliers') THEN replace(format('{{:,.0f}}', {v}), ',', '\\,') "
            f"WHEN {v} = floor({v}) AND abs({v}) >= 100 THEN replace(format('{{:,.0f}}', {v}), ',', '\\,') "
            f"WHEN abs({v}) >= 100 THEN replace(format('{{:,.2f}}', {v}), ',', '\\,') "
            f"WHEN abs({v}) >= 1 THEN printf('%.3f', {v}) ELSE printf('%.4f', {v}) END")


_order = ", ".join(f"'{s}'" for s in ["count", "mean", "q1", "median", "q3", "iqr", "std", "range", "outliers", "outliers_pct"])
_raw = describe_sql(I.SQL["measures"], I.MEASURES, places=12)
ORACLE["stats_report_table"] = f"""
WITH d AS ({_raw}),
w AS (SELECT statistic, {', '.join(f"max(CASE WHEN \"column\" = '{c}' THEN value END) AS {c}" for c in I.MEASURES)}
      FROM d GROUP BY statistic)
SELECT CAST(CASE WHEN list_position([{_order}], statistic) > 0 THEN list_position([{_order}], statistic) ELSE 11 END AS INTEGER) AS "row order",
       statistic, {', '.join(f'{_fmt(c)} AS "{c.replace("_", " ")}"' for c in I.MEASURES)}
FROM w"""
ORACLE["head_orders"] = "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5"
ORACLE["top_price_per_unit"] = f"""
SELECT l_orderkey, l_linenumber, {r('ppu', 6)} AS price_per_unit FROM (
  SELECT l_orderkey, l_linenumber, l_extendedprice / nullif(l_quantity, 0) AS ppu FROM lineitem
  ORDER BY ppu DESC NULLS LAST, l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 20) t"""
ORACLE["describe_unpivot"] = describe_sql(I.SQL["measures"], I.MEASURES)


ORACLE["results_navigation"] = f"""WITH {_fm}
SELECT dataset, model, {r('mean_value', 6)} AS mean_r2 FROM mm WHERE metric = 'r2'"""
_sil = ORACLE["silhouette_single"].replace(
    f"SELECT 'single' AS linkage, k, {r('sum(sil * n) / sum(n)', 6)} AS silhouette,",
    f"SELECT 'single' AS linkage, k, {r('sum(sil * n) / sum(n)', 9)} AS silhouette,")
ORACLE["best_k_single"] = f"""
SELECT linkage, k, {r('silhouette', 6)} AS silhouette FROM ({_sil}) t
ORDER BY silhouette DESC, k LIMIT 1"""


# ------------------------------------------------------------ complete, average and ward linkage
# the merge rounds as a recursive CTE: kind 0 are the intervals of a round, kind 1 its merges
_linkages = f"""
d AS (SELECT value AS x, CAST(count(*) AS DOUBLE) AS n, value * CAST(count(*) AS DOUBLE) AS s
      FROM events WHERE value IS NOT NULL AND NOT isnan(value) GROUP BY value),
rounds AS (
  SELECT l.linkage, 0 AS kind, x AS lo, x AS hi, n, s,
         md5(CAST(CAST(round(x * 10000) AS BIGINT) AS VARCHAR)) AS hl, CAST(NULL AS DOUBLE) AS height
  FROM d CROSS JOIN (VALUES ('complete'), ('average'), ('ward')) l(linkage)
  UNION ALL
  SELECT linkage, kind, lo,
         CASE WHEN kind = 0 AND sel THEN nhi ELSE hi END, CASE WHEN kind = 0 AND sel THEN n + nn ELSE n END,
         CASE WHEN kind = 0 AND sel THEN s + ns ELSE s END, hl, CASE WHEN kind = 1 THEN dist END
  FROM (SELECT *, coalesce(lag(sel) OVER (PARTITION BY linkage ORDER BY lo), false) AS gone
        FROM (SELECT *, dist IS NOT NULL
                     AND coalesce((dist, nhl, nlo) < (pdist, hl, lo), true)
                     AND coalesce((dist, nhl, nlo) < (ndist, nnhl, nnlo), true) AS sel
              FROM (SELECT *, lag(dist) OVER w AS pdist, lead(dist) OVER w AS ndist, lead(nhl) OVER w AS nnhl,
                           lead(nlo) OVER w AS nnlo
                    FROM (SELECT *, CASE WHEN nlo IS NULL THEN NULL
                                         WHEN linkage = 'complete' THEN nhi - lo
                                         WHEN linkage = 'average' THEN ns / nn - s / n
                                         ELSE sqrt(2.0::DOUBLE * n * nn / (n + nn)) * (ns / nn - s / n) END AS dist
                          FROM (SELECT linkage, lo, hi, n, s, hl, lead(lo) OVER v AS nlo, lead(hi) OVER v AS nhi,
                                       lead(n) OVER v AS nn, lead(s) OVER v AS ns, lead(hl) OVER v AS nhl
                                FROM rounds WHERE kind = 0 WINDOW v AS (PARTITION BY linkage ORDER BY lo)) a
                         ) b WINDOW w AS (PARTITION BY linkage ORDER BY lo)) c) e) f
       CROSS JOIN (VALUES (0), (1)) k(kind)
  WHERE ((kind = 1 AND sel) OR (kind = 0 AND NOT gone
        AND (nlo IS NOT NULL OR pdist IS NOT NULL)))),
bounds AS (SELECT linkage, hi AS boundary, height FROM rounds WHERE kind = 1)"""
ORACLE["dendrogram_linkages"] = f"""WITH RECURSIVE {_linkages}
SELECT linkage, boundary, {r('height', 6)} AS height FROM bounds"""
_sweep = f"""{_linkages},
every AS (SELECT * FROM bounds UNION ALL
          SELECT 'single' AS linkage, b, h FROM (SELECT lag(x) OVER (ORDER BY x) AS b, x - lag(x) OVER (ORDER BY x) AS h FROM d) g
          WHERE b IS NOT NULL),
top AS (SELECT linkage, boundary, height, row_number() OVER (PARTITION BY linkage ORDER BY height DESC, boundary) AS rk FROM every),
ks AS (SELECT l.linkage, l.lrank, CAST(range AS INTEGER) AS k
       FROM range(2, 11) CROSS JOIN (VALUES ('single', 1), ('complete', 2), ('average', 3), ('ward', 4)) l(linkage, lrank)),
thr AS (SELECT ks.*, t.height AS h FROM ks LEFT JOIN top t ON t.linkage = ks.linkage AND t.rk = ks.k),
cuts AS (SELECT thr.linkage, thr.k, top.boundary FROM thr JOIN top ON top.linkage = thr.linkage AND top.rk <= 10
         AND (thr.h IS NULL OR top.height > thr.h)),
lab AS (SELECT ks.linkage, ks.lrank, ks.k, d.x, d.n, d.s,
               CAST(1 + (SELECT count(*) FROM cuts c WHERE c.linkage = ks.linkage AND c.k = ks.k AND c.boundary < d.x) AS INTEGER) AS label
        FROM d CROSS JOIN ks),
cl AS (SELECT linkage, k, label, sum(n) AS C_n, sum(s) AS C_s FROM lab GROUP BY ALL),
cl2 AS (SELECT *, lag(C_s) OVER q / lag(C_n) OVER q AS m_prev, lead(C_s) OVER q / lead(C_n) OVER q AS m_next
        FROM cl WINDOW q AS (PARTITION BY linkage, k ORDER BY label)),
pt AS (SELECT lab.*, cl2.C_n, cl2.C_s, cl2.m_prev, cl2.m_next,
              sum(lab.n) OVER (PARTITION BY lab.linkage, lab.k, lab.label ORDER BY lab.x) AS cnt_le,
              sum(lab.s) OVER (PARTITION BY lab.linkage, lab.k, lab.label ORDER BY lab.x) AS sum_le
       FROM lab JOIN cl2 USING (linkage, k, label)),
ab AS (SELECT linkage, lrank, k, label, n,
              CASE WHEN C_n > 1 THEN (x * cnt_le - sum_le + (C_s - sum_le) - x * (C_n - cnt_le)) / (C_n - 1) END AS a,
              least(abs(x - m_prev), abs(x - m_next)) AS b, C_n FROM pt),
sv AS (SELECT linkage, lrank, k, label, n, CASE WHEN C_n <= 1 THEN 0.0
                                ELSE coalesce((b - a) / nullif(greatest(a, b), 0), 0.0) END AS sil FROM ab),
sc AS (SELECT linkage, lrank, k, sum(sil * n) / sum(n) AS score, CAST(count(DISTINCT label) AS INTEGER) AS clusters
       FROM sv GROUP BY linkage, lrank, k)"""
ORACLE["silhouette_sweep"] = f"""WITH RECURSIVE {_sweep}
SELECT linkage, k, {r('score', 6)} AS silhouette, clusters,
       row_number() OVER (PARTITION BY linkage ORDER BY round(score, 9) DESC, k) = 1 AS is_best FROM sc"""
ORACLE["best_clustering"] = f"""WITH RECURSIVE {_sweep},
best AS (SELECT linkage, k FROM sc ORDER BY round(score, 9) DESC, lrank, k LIMIT 1)
SELECT b.linkage, b.k, t.cluster, count(*) AS n FROM best b CROSS JOIN (
  SELECT CAST(1 + (SELECT count(*) FROM cuts c JOIN best USING (linkage, k) WHERE c.boundary < e.value) AS INTEGER) AS cluster
  FROM events e) t GROUP BY ALL"""


# ------------------------------------------------------------ files, strings, documents, several features
ORACLE["mercator_by_segment"] = f"""
SELECT CAST(dense_rank() OVER (ORDER BY list_position([{', '.join(f"'{x}'" for x in I.SEGMENTS)}], c_mktsegment)) - 1 AS INTEGER) AS plot,
       c_mktsegment AS segment, c_custkey, x_m, y_m
FROM ({ORACLE["mercator_points"]}) t WHERE list_position([{', '.join(f"'{x}'" for x in I.SEGMENTS)}], c_mktsegment) > 0"""
ORACLE["assembled_features"] = f"""
SELECT row_key, x_quantity AS feature_0, x_tax_ratio AS feature_1, CAST(category = 'A' AS DOUBLE) AS feature_2,
       CAST(category = 'N' AS DOUBLE) AS feature_3, CAST(category = 'R' AS DOUBLE) AS feature_4, target, stratum
FROM ({I.SQL['regression_table']}) t"""
ORACLE["standardized_by_fold"] = f"""WITH {_fm},
w2 AS (SELECT * FROM fd WHERE dataset = 'with_outliers'),
sc AS (SELECT f.fold, avg(t.x_quantity) AS mq, stddev_pop(t.x_quantity) AS sq, avg(t.x_tax_ratio) AS mr, stddev_pop(t.x_tax_ratio) AS sr
       FROM (SELECT DISTINCT fold FROM w2) f JOIN w2 t ON t.fold <> f.fold GROUP BY f.fold)
SELECT row_key, fold, {r('(x_quantity - mq) / sq', 6)} AS x_quantity, {r('(x_tax_ratio - mr) / sr', 6)} AS x_tax_ratio FROM w2 JOIN sc USING (fold)"""
_unions = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "price_per_unit", "tax_per_discount"]
ORACLE["stats_files_round_trip"] = f"""
SELECT "group", file, statistic, {', '.join(f"max(CASE WHEN \"column\" = '{c}' THEN value END) AS {c}" for c in _unions)}
FROM ({_groups_sql}) t GROUP BY "group", file, statistic"""
_texts = ["l_returnflag", "l_linestatus"]
_stat_list = ["count", "mean", "q1", "median", "q3", "iqr", "std", "max", "min", "range", "outliers", "outliers_pct"]
ORACLE["describe_with_strings"] = f"""
SELECT statistic, "column", value, CAST(NULL AS VARCHAR) AS text FROM ({describe_sql("SELECT l_quantity FROM lineitem", ["l_quantity"])}) t
UNION ALL """ + " UNION ALL ".join(
    f"SELECT '{st}', '{c}', {f'CAST(count({c}) AS DOUBLE)' if st == 'count' else 'NULL'}, {f'{st}({c})' if st in ('min', 'max') else 'NULL'}"
    + (" FROM lineitem" if st in ("count", "min", "max") else "")
    for c in _texts for st in _stat_list)


def _residuals(features: list[str]) -> str:
    """Successive residual regressions: each feature is cleared of those before it, then the target of all, by train rows only."""
    cols = [*features, "y"]
    ctes = [f"""
g0 AS (SELECT dataset, CAST(j.range AS INTEGER) AS j, fold, target AS y, {', '.join(features)} FROM lf CROSS JOIN range(0, 10) j),
m0 AS (SELECT dataset, j, {', '.join(f'avg({c}) AS m_{c}' for c in cols)} FROM g0 WHERE fold <> j GROUP BY ALL),
r0 AS (SELECT g0.dataset, g0.j, fold, {', '.join(f'{c} - m_{c} AS {c}' for c in cols)} FROM g0 JOIN m0 USING (dataset, j))"""]
    for i, f in enumerate(features):
        rest = cols[i + 1:]
        ctes.append(f"""
k{i} AS (SELECT dataset, j, {', '.join(f'sum({f} * {c}) / sum({f} * {f}) AS b_{c}' for c in rest)} FROM r{i} WHERE fold <> j GROUP BY ALL),
r{i + 1} AS (SELECT t.dataset, t.j, fold, {', '.join(f'{c} - b_{c} * {f} AS {c}' for c in rest)} FROM r{i} t JOIN k{i} USING (dataset, j))""")
    return ",".join(ctes)


_full = ["f1", "f2", "f3", "f4"]
ORACLE["linear_cv_full"] = f"""WITH {_fm},
lf AS (SELECT dataset, fold, target, x_quantity AS f1, x_tax_ratio AS f2, CAST(category = 'N' AS DOUBLE) AS f3,
              CAST(category = 'R' AS DOUBLE) AS f4 FROM fd),{_residuals(_full)},
held AS (SELECT r4.dataset, r4.fold, r4.y AS e FROM r4 WHERE r4.fold = r4.j),
tv AS (SELECT dataset, fold, var_pop(target) * count(*) AS sst FROM lf GROUP BY ALL),
lw AS (SELECT h.dataset, h.fold, 1 - sum(e * e) / any_value(sst) AS r2, sqrt(avg(e * e)) AS rmse, avg(abs(e)) AS mae
       FROM held h JOIN tv ON tv.dataset = h.dataset AND tv.fold = h.fold GROUP BY h.dataset, h.fold)
SELECT dataset, 'linear' AS model, fold, m.metric, {r("CASE m.metric WHEN 'r2' THEN r2 WHEN 'rmse' THEN rmse ELSE mae END", 4)} AS value
FROM lw CROSS JOIN (VALUES ('r2'), ('rmse'), ('mae')) m(metric)"""
ORACLE["study_document"] = f"""WITH {_fm},
p AS (SELECT model, metric, max(CASE WHEN dataset = 'with_outliers' THEN mean_value END) AS wv,
             max(CASE WHEN dataset = 'without_outliers' THEN mean_value END) AS wov FROM mm GROUP BY ALL),
dsn AS (SELECT DISTINCT dataset FROM fd),
counts AS (SELECT (SELECT count(*) FROM lineitem) AS a, (SELECT count(*) FROM fd WHERE dataset = 'with_outliers') AS b,
                  (SELECT count(*) FROM fd WHERE dataset = 'without_outliers') AS c),
d AS (
SELECT dataset, 'target' AS section, '' AS model, 'target_mean' AS name, target_mean AS value FROM tm
UNION ALL SELECT dataset, 'r2', model, 'mean', mean_value FROM mm WHERE metric = 'r2'
UNION ALL SELECT dataset, 'importance', model, feature, avg(importance) FROM im GROUP BY dataset, model, feature
UNION ALL SELECT dataset, 'position', model, '', CAST(row_number() OVER (PARTITION BY dataset ORDER BY mean_value DESC, list_position([{_morder}], model)) AS DOUBLE)
          FROM mm WHERE metric = 'r2'
UNION ALL SELECT dataset, 'difference', model, metric, wov - wv FROM p CROSS JOIN dsn
UNION ALL SELECT dataset, 'counts', '', 'total', CAST(b AS DOUBLE) FROM counts CROSS JOIN dsn
UNION ALL SELECT dataset, 'counts', '', 'bad', 0.0 FROM dsn
UNION ALL SELECT dataset, 'counts', '', 'used', CAST(b AS DOUBLE) FROM counts CROSS JOIN dsn
UNION ALL SELECT dataset, 'counts', '', 'outliers', CAST(b - c AS DOUBLE) FROM counts CROSS JOIN dsn)
SELECT dataset, section, model, name, {r('value', 4)} AS value FROM d"""
