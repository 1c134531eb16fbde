"""Cross-validated regression (O-72..O-83, O-89).

Linear model (O-72, O-79): one aggregate per call gives, for every fold,
the row count, feature/target means and centred co-moments; the training
statistics of outer fold j are the other folds' statistics merged with the
pairwise (Chan) update, and the normal equations are solved on the driver
for a (p+1) x (p+1) system. One scan serves all folds. The numeric features
are standardised on the training part (population std) only for the
reported coefficients: an affine rescale does not change OLS predictions.

Trees and forests (O-73..O-78): MLlib estimators under ``CrossValidator``
with the stratified inner folds as ``foldCol``; the outer loop (10 steps)
stays a Python loop over the cached table, each step distributed. Forests whose
MLlib models are not asked for are searched by path evaluation (``forests``).

Metrics (O-80): one grouped aggregate over predictions gives R2 (against
the held-out fold's own mean), RMSE and MAE per (model, fold).
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.regression import DecisionTreeRegressor, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .features import assemble
from .forests import nested_forest_search

SEED = 42            # fixed value: the study's random state
MAX_DEPTH_NONE = 30  # MLlib's depth cap stands in for "no limit"

# Full hyperparameter grids of the study (min_samples_split has no MLlib twin).
TREE_GRID = {"maxDepth": [MAX_DEPTH_NONE, 3, 5, 10, 20], "minInstancesPerNode": [1, 2, 4]}
FOREST_GRID = {"numTrees": [50, 100, 200, 400], "maxDepth": [MAX_DEPTH_NONE, 5, 10, 20],
               "featureSubsetStrategy": ["all", "sqrt", "log2"]}


def subset_sizes(strategies: Sequence[str], n_features: int) -> list[str]:
    """Feature subsets as counts: all, floor of the square root, floor of the logarithm
    (MLlib's own names round up); equal counts are one candidate."""
    size = {"all": n_features, "sqrt": max(1, int(n_features ** 0.5)), "log2": max(1, int(np.log2(n_features)))}
    return list(dict.fromkeys("all" if s == "all" else str(size.get(s, s)) for s in strategies))


# ------------------------------------------------------------------ OLS by fold statistics


def fold_moments(df: DataFrame, fold: str, cols: Sequence[str]) -> dict[int, tuple]:
    """Per fold: (n, mean vector, co-moment matrix M = n * covariance_pop) of ``cols``."""
    aggs = [F.count(F.lit(1)).alias("_n")] + [F.avg(c).alias(f"_m{i}") for i, c in enumerate(cols)]
    for i, a in enumerate(cols):
        for j in range(i, len(cols)):
            aggs.append(F.covar_pop(a, cols[j]).alias(f"_c{i}_{j}"))
    out = {}
    for r in df.groupBy(fold).agg(*aggs).collect():
        n = int(r["_n"])
        mu = np.array([r[f"_m{i}"] for i in range(len(cols))], float)
        m = np.zeros((len(cols), len(cols)))
        for i in range(len(cols)):
            for j in range(i, len(cols)):
                m[i, j] = m[j, i] = r[f"_c{i}_{j}"] * n
        out[int(r[fold])] = (n, mu, m)
    return out


def merge_moments(parts: Sequence[tuple]) -> tuple:
    """Pairwise merge of (n, mean, co-moment) summaries."""
    n, mu, m = parts[0]
    for nb, mub, mb in parts[1:]:
        tot = n + nb
        delta = mub - mu
        m = m + mb + np.outer(delta, delta) * (n * nb / tot)
        mu = mu + delta * (nb / tot)
        n = tot
    return n, mu, m


def ols_from_moments(n: int, mu: np.ndarray, m: np.ndarray) -> tuple[float, np.ndarray]:
    """Intercept and coefficients; last entry of ``mu``/``m`` is the target.

    Solved on features scaled to unit spread, so that features of very unequal
    scales keep their coefficients; minimum-norm there, so a constant feature gets
    coefficient 0.
    """
    sxx, sxy = m[:-1, :-1], m[:-1, -1]
    scale = np.sqrt(np.maximum(np.diag(sxx), 0.0))
    scale[scale == 0] = 1.0
    beta = np.linalg.pinv(sxx / np.outer(scale, scale), hermitian=True) @ (sxy / scale) / scale
    return float(mu[-1] - beta @ mu[:-1]), beta


def r2_from_moments(n: int, mu: np.ndarray, m: np.ndarray, b0: float, b1: float) -> float:
    """Held-out R2 of y ~ b0 + b1 * x from the held-out rows' (n, means, co-moments)
    of (x, y): SSE = Myy - 2 b1 Mxy + b1^2 Mxx + n (ybar - b0 - b1 xbar)^2, SST = Myy."""
    mxx, mxy, myy = m[0, 0], m[0, 1], m[1, 1]
    bias = mu[1] - b0 - b1 * mu[0]
    sse = myy - 2 * b1 * mxy + b1 * b1 * mxx + n * bias * bias
    return float("nan") if myy == 0 else 1.0 - sse / myy


def rmse_from_moments(n: int, mu: np.ndarray, m: np.ndarray, b0: float, b1: float) -> float:
    """Held-out RMSE of y ~ b0 + b1 * x, from the same moments as ``r2_from_moments``."""
    bias = mu[1] - b0 - b1 * mu[0]
    sse = m[1, 1] - 2 * b1 * m[0, 1] + b1 * b1 * m[0, 0] + n * bias * bias
    return float(np.sqrt(max(sse, 0.0) / n))


@dataclass
class LinearCV:
    features: list[str]
    intercepts: dict[int, float] = field(default_factory=dict)
    coefs: dict[int, np.ndarray] = field(default_factory=dict)
    std_coefs: dict[int, np.ndarray] = field(default_factory=dict)
    fit_seconds: dict[int, float] = field(default_factory=dict)

    def prediction(self, fold: str) -> Column:
        """Held-out prediction: the model of the row's own fold."""
        expr = None
        for f in sorted(self.intercepts):
            p = F.lit(self.intercepts[f])
            for c, b in zip(self.features, self.coefs[f]):
                p = p + F.lit(float(b)) * F.col(c)
            expr = F.when(F.col(fold) == f, p) if expr is None else expr.when(F.col(fold) == f, p)
        return expr


def linear_cv(df: DataFrame, features: Sequence[str], target: str, fold: str,
              standardize: Sequence[str] = ()) -> LinearCV:
    """O-72 + O-79: OLS with intercept for every outer fold, one aggregate job."""
    cols = [*features, target]
    t0 = time.perf_counter()
    mom = fold_moments(df, fold, cols)
    shared = time.perf_counter() - t0
    res = LinearCV(list(features))
    for f in sorted(mom):
        t1 = time.perf_counter()
        n, mu, m = merge_moments([mom[g] for g in sorted(mom) if g != f])
        b0, beta = ols_from_moments(n, mu, m)
        sd = np.sqrt(np.maximum(np.diag(m)[:-1] / n, 0.0))
        scale = np.array([sd[i] if c in set(standardize) else 1.0 for i, c in enumerate(features)])
        res.intercepts[f], res.coefs[f], res.std_coefs[f] = b0, beta, beta * scale
        res.fit_seconds[f] = shared / len(mom) + (time.perf_counter() - t1)
    return res


# ------------------------------------------------------------------ metrics


def regression_metrics(pred: DataFrame, label: str, prediction: str, keys: Sequence[str]) -> DataFrame:
    """O-80: r2, rmse, mae per key group (R2 against the group's own target mean)."""
    e = F.col(label) - F.col(prediction)
    return (pred.groupBy(*keys)
            .agg(F.sum(e * e).alias("_sse"), (F.var_pop(label) * F.count(F.lit(1))).alias("_sst"),
                 F.avg(e * e).alias("_mse"), F.avg(F.abs(e)).alias("mae"))
            .select(*keys, (F.lit(1.0) - F.try_divide(F.col("_sse"), F.col("_sst"))).alias("r2"),
                    F.sqrt("_mse").alias("rmse"), "mae"))


def metrics_long(wide: DataFrame, keys: Sequence[str], target_mean: Column | float | None = None) -> DataFrame:
    """Wide (r2, rmse, mae) to long (metric, value, share_of_target_mean) (O-81, O-97)."""
    long = wide.selectExpr(*keys, "stack(3, 'r2', r2, 'rmse', rmse, 'mae', mae) as (metric, value)")
    if target_mean is None:
        return long
    tm = target_mean if isinstance(target_mean, Column) else F.lit(target_mean)
    return long.withColumn("share_of_target_mean",
                           F.when(F.col("metric") != "r2", F.try_divide(F.col("value"), tm)))


# ------------------------------------------------------------------ trees and forests


def _grid(est, grid: dict) -> list:
    b = ParamGridBuilder()
    for name, values in grid.items():
        b = b.addGrid(est.getParam(name), values)
    return b.build()


def candidate_params(maps: list) -> list[dict[str, str]]:
    return [{p.name: str(v) for p, v in m.items()} for m in maps]


def nested_cv(df: DataFrame, features: Sequence[str], label: str, fold: str, inner: str,
              kind: str = "tree", grid: dict | None = None, parallelism: int = 4,
              max_bins: int = 256, outer_parallelism: int = 4, models: bool = True):
    """O-73..O-78, O-82, O-83, O-89: grid search on inner folds of each outer train
    part, refit on the whole train part (CrossValidator's best model), scored on
    the held-out fold.

    Outer folds are independent, so up to ``outer_parallelism`` of them are
    submitted concurrently (Spark runs jobs from several driver threads); inside
    each, ``parallelism`` candidates are fitted at once.
    Returns (predictions DataFrame with ``prediction``, per-fold dicts, candidates).
    ``inner`` is the array column from ``stratified_folds(..., inner=...)``.

    With ``models=False`` the dicts have no ``model``, and forests over numbers of trees, depths and feature subsets are grown for
    all fits from aggregates of the rows (``forests.nested_forest_search``) where their fits are of bounded size.
    """
    from concurrent.futures import ThreadPoolExecutor

    if kind == "tree":
        est = DecisionTreeRegressor(seed=SEED, maxBins=max_bins, featuresCol="features", labelCol=label)
        grid = grid or TREE_GRID
    elif kind == "forest":
        est = RandomForestRegressor(seed=SEED, maxBins=max_bins, featuresCol="features", labelCol=label)
        grid = grid or {**FOREST_GRID, "featureSubsetStrategy": subset_sizes(FOREST_GRID["featureSubsetStrategy"], len(features))}
    else:
        raise ValueError(kind)
    maps = _grid(est, grid)
    # every fit runs several jobs per tree level over this table: written once
    ensure_checkpoint_dir(df.sparkSession)
    if kind == "forest" and not models and set(grid) == set(FOREST_GRID):
        df = df.checkpoint()
        found = nested_forest_search(df, features, label, fold, inner, candidate_params(maps), max_bins, SEED)
        if found:
            return *found, candidate_params(maps)
    data = assemble(df, features).checkpoint()
    folds = sorted(r[0] for r in data.select(fold).distinct().collect())
    k_inner = len(folds)
    ev = RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName="r2")

    def one(f):
        train = data.filter(F.col(fold) != f).withColumn("_inner", F.col(inner)[f])
        cv = CrossValidator(estimator=est, estimatorParamMaps=maps, evaluator=ev, numFolds=k_inner,
                            foldCol="_inner", parallelism=parallelism, seed=SEED)
        t0 = time.perf_counter()
        model = cv.fit(train)
        elapsed = time.perf_counter() - t0
        best = model.bestModel
        idx = int(np.argmax(model.avgMetrics))
        pred = best.transform(data.filter(F.col(fold) == f)).drop("features")
        return pred, {
            "fold": f, "avg_metrics": list(model.avgMetrics), "best_idx": idx,
            "best_params": candidate_params([maps[idx]])[0],
            "importances": [float(v) for v in best.featureImportances.toArray()],
            "fit_seconds": elapsed, **({"model": best} if models else {}),
        }

    with ThreadPoolExecutor(max_workers=max(1, outer_parallelism)) as pool:
        results = list(pool.map(one, folds))
    preds = results[0][0]
    for p, _ in results[1:]:
        preds = preds.unionByName(p)
    return preds, [r for _, r in results], candidate_params(maps)
