"""Regression study (entry C): datasets with and without outliers, stratified
outer/inner folds, linear / tree / forest models, long result tables."""

from __future__ import annotations

import functools
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import describe as D
from ..operators import features as FE
from ..operators import models as M
from ..operators import sampling as S
from ..operators import trees as TR
from . import inputs as I
from ..functions.frames import literal_frame

WITH, WITHOUT = "with_outliers", "without_outliers"
DATASETS = [WITH, WITHOUT]


@dataclass(frozen=True)
class ModelSpec:
    """Column roles of a modelling table.

    ``numeric`` are the standardised numeric features, ``category`` the ordered
    category one-hot encoded with ``levels`` (the linear model drops the first
    level), ``stratum`` drives the stratified folds, ``key`` orders rows inside
    a stratum (md5 hash order), ``outlier_cols`` define the outlier-free
    dataset, ``single_models`` are the one-feature OLS candidates.
    """
    key: tuple[str, ...] = ("row_key",)
    target: str = "target"
    numeric: tuple[str, ...] = ("x_quantity", "x_tax_ratio")
    category: str = "category"
    levels: tuple[str, ...] = tuple(I.RETURN_FLAGS)
    stratum: str = "stratum"
    outlier_cols: tuple[str, ...] = ("target", "x_quantity", "x_tax_ratio")
    single_models: tuple[tuple[str, str], ...] = (
        ("ols_quantity", "x_quantity"), ("ols_tax_ratio", "x_tax_ratio"), ("ols_tax", "x_tax"))


DEFAULT_SPEC = ModelSpec()
OUTLIER_COLS = list(DEFAULT_SPEC.outlier_cols)
NUMERIC = list(DEFAULT_SPEC.numeric)
SINGLE_MODELS = dict(DEFAULT_SPEC.single_models)
MODEL_ORDER = ["linear", "tree", "forest", *SINGLE_MODELS, "ols_select"]


def datasets_of(base: DataFrame, spec: ModelSpec = DEFAULT_SPEC) -> dict[str, DataFrame]:
    """A modelling table and its outlier-free variant (fences of the full table)."""
    return {WITH: base, WITHOUT: D.drop_outlier_rows(base, list(spec.outlier_cols))}


def datasets(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The driver-table modelling table (see ``inputs.regression_table``) and its variant."""
    return datasets_of(I.regression_table(spark, sf_dir))


def with_folds(df: DataFrame, inner: bool = False, spec: ModelSpec = DEFAULT_SPEC, **kw) -> DataFrame:
    return S.stratified_folds(df, list(spec.key), spec.stratum, inner="inner" if inner else None, **kw)


def single_feature_linear(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """One-feature OLS models on the driver tables, see ``single_feature_linear_of``."""
    return single_feature_linear_of(datasets(spark, sf_dir))


def single_feature_linear_of(dsets: dict[str, DataFrame], spec: ModelSpec = DEFAULT_SPEC
                             ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """One-feature OLS models per dataset: (fold_metrics, importance, target_means).

    One moments job and one metrics job per dataset serve all models and folds.
    """
    metrics, imps, tms = [], [], []
    models = dict(spec.single_models)
    feats = list(dict.fromkeys(models.values()))
    spark = next(iter(dsets.values())).sparkSession
    for ds, df in dsets.items():
        f = with_folds(df, spec=spec).select("fold", F.col(spec.target).alias("target"), *feats).checkpoint()
        mom = M.fold_moments(f, "fold", [*feats, "target"])
        _, mu_all, _ = M.merge_moments(list(mom.values()))
        target_mean = float(mu_all[-1])
        maes, imp_rows, exact = [], [], []
        for model, x in models.items():
            i = feats.index(x)
            sub = {k: (n, mu[[i, -1]], m[np.ix_([i, -1], [i, -1])]) for k, (n, mu, m) in mom.items()}
            expr = None
            for k in sorted(sub):
                n, mu, m = M.merge_moments([sub[g] for g in sorted(sub) if g != k])
                b0, beta = M.ols_from_moments(n, mu, m)
                sd = float(np.sqrt(max(m[0, 0] / n, 0.0)))
                imp_rows.append((ds, model, int(k), x, abs(float(beta[0]) * sd)))
                hn, hmu, hm = sub[k]
                r2 = M.r2_from_moments(hn, hmu, hm, b0, float(beta[0]))
                exact += [(model, int(k), "r2", None if np.isnan(r2) else r2),
                          (model, int(k), "rmse", M.rmse_from_moments(hn, hmu, hm, b0, float(beta[0])))]
                p = F.lit(b0) + F.lit(float(beta[0])) * F.col(x)
                expr = F.when(F.col("fold") == k, p) if expr is None else expr.when(F.col("fold") == k, p)
            maes.append(F.avg(F.abs(F.col("target") - expr)))
        # R2 and RMSE follow from the moments; only the absolute error needs the rows: one column a model
        names = list(models)
        stacked = ", ".join(f"'{m}', _e{i}" for i, m in enumerate(names))
        mae = f.groupBy("fold").agg(*[e.alias(f"_e{i}") for i, e in enumerate(maes)]).selectExpr(
            f"stack({len(names)}, {stacked}) as (model, value)", "cast(fold as int) as fold", "'mae' as metric")
        long = literal_frame(spark, exact, "model string, fold int, metric string, value double").unionByName(mae)
        metrics.append(long.withColumn("share_of_target_mean", F.when(
            F.col("metric") != "r2", F.try_divide(F.col("value"), F.lit(target_mean)))).withColumn("dataset", F.lit(ds)))
        imps.append(literal_frame(spark, imp_rows, "dataset string, model string, fold int, feature string, importance double"))
        tms.append((ds, target_mean))
    fm = functools.reduce(DataFrame.unionByName, metrics)
    im = functools.reduce(DataFrame.unionByName, imps)
    tm = literal_frame(spark, tms, "dataset string, target_mean double")
    return fm, im, tm


def linear_study(df: DataFrame, spec: ModelSpec = DEFAULT_SPEC) -> tuple[DataFrame, DataFrame, M.LinearCV]:
    """Multi-feature OLS: numeric features standardised (coefficients), category as
    dummies minus the reference level; (fold_metrics, importance, fits)."""
    levels, dropped = list(spec.levels), spec.levels[0]
    x = FE.one_hot(df, spec.category, levels, drop_level=dropped)
    feats = [*spec.numeric, *FE.dummy_names(spec.category, levels, dropped)]
    f = with_folds(x, spec=spec).select("fold", F.col(spec.target).alias("target"), *feats).checkpoint()
    fit = M.linear_cv(f, feats, "target", "fold", standardize=list(spec.numeric))
    pred = f.withColumn("prediction", fit.prediction("fold"))
    wide = M.regression_metrics(pred, "target", "prediction", ["fold"]).withColumn("model", F.lit("linear"))
    spark = df.sparkSession
    imp = literal_frame(spark, [("linear", int(k), c, abs(float(b))) for k, bs in fit.std_coefs.items()
                                for c, b in zip(feats, bs)],
                        "model string, fold int, feature string, importance double")
    timing = literal_frame(spark, [("linear", int(k), "fit_seconds", float(v)) for k, v in fit.fit_seconds.items()],
                           "model string, fold int, metric string, value double")
    return M.metrics_long(wide, ["model", "fold"]).unionByName(timing), imp, fit


def tree_study(df: DataFrame, kind: str, grid: dict | None = None, spec: ModelSpec = DEFAULT_SPEC,
               k: int = S.DEFAULT_FOLDS, **cv_options):
    """Nested CV of a tree or forest: (fold_metrics, importance, fold_params, candidate_scores, timing, candidates,
    fitted MLlib models by fold, which trees searched by path evaluation do not have).

    Trees are searched by path evaluation (``trees.nested_tree_search``), forests by ``models.nested_cv``: by MLlib, or with
    ``models=False`` by path evaluation.
    ``candidates`` gives the parameters of each candidate_idx.
    """
    levels = list(spec.levels)
    x = FE.one_hot(df, spec.category, levels)
    feats = [*spec.numeric, *FE.dummy_names(spec.category, levels)]
    spark = df.sparkSession
    if kind == "tree":
        grid = grid or M.TREE_GRID
        f = with_folds(x, spec=spec, k=k, position="fold_pos").select("fold_pos", F.col(spec.target).alias("target"), *feats).checkpoint()
        preds, scored, per_fold, cands, _ = TR.nested_tree_search(
            f, feats, "target", "fold_pos", grid["maxDepth"], grid.get("minInstancesPerNode", [1]), k=k,
            max_bins=cv_options.get("max_bins", 256))
        scores = scored.select(F.lit(kind).alias("model"), "outer_fold", "candidate_idx", "mean_r2")
    else:
        f = with_folds(x, inner=True, spec=spec, k=k).select("fold", "inner", F.col(spec.target).alias("target"), *feats)
        preds, per_fold, cands = M.nested_cv(f, feats, "target", "fold", "inner", kind=kind, grid=grid, **cv_options)
        scores = literal_frame(spark, [(kind, p["fold"], i, float(s)) for p in per_fold for i, s in enumerate(p["avg_metrics"])],
                               "model string, outer_fold int, candidate_idx int, mean_r2 double")
    wide = M.regression_metrics(preds, "target", "prediction", ["fold"]).withColumn("model", F.lit(kind))
    imp = literal_frame(spark, [(kind, p["fold"], c, v) for p in per_fold for c, v in zip(feats, p["importances"])],
                                "model string, fold int, feature string, importance double")
    params = literal_frame(spark, [(kind, p["fold"], n, v) for p in per_fold for n, v in p["best_params"].items()],
                                   "model string, fold int, name string, value string")
    timing = literal_frame(spark, [(kind, p["fold"], "fit_seconds", float(p["fit_seconds"])) for p in per_fold],
                                   "model string, fold int, metric string, value double")
    candidates = literal_frame(spark, [(kind, i, n, str(v)) for i, c in enumerate(cands) for n, v in c.items()],
                               "model string, candidate_idx int, name string, value string")
    models = {p["fold"]: p["model"] for p in per_fold if "model" in p}
    return M.metrics_long(wide, ["model", "fold"]), imp, params, scores, timing, candidates, models


def feature_names(spec: ModelSpec = DEFAULT_SPEC) -> list[str]:
    """Features of the tree models: the numeric ones and a dummy for every level."""
    return [*spec.numeric, *FE.dummy_names(spec.category, list(spec.levels))]


def stump_search_of(dsets: dict[str, DataFrame], spec: ModelSpec = DEFAULT_SPEC, k: int = S.DEFAULT_FOLDS,
                    leaves: Sequence[int] = (1, 1_000, 4_000)):
    """The nested tree search with trees of one split, per dataset: (fold_metrics, fold_params, candidate_scores, candidates)."""
    out = None
    for ds, df in dsets.items():
        fm, _, params, scores, _, cands, _ = tree_study(df, "tree", {"maxDepth": [1], "minInstancesPerNode": list(leaves)}, spec, k)
        mine = [x.withColumn("dataset", F.lit(ds)) for x in (fm, params, scores, cands)]
        out = mine if out is None else [a.unionByName(b) for a, b in zip(out, mine)]
    return tuple(out)


def linear_feature_search(spark: SparkSession, sf_dir: str, k: int = S.DEFAULT_FOLDS):
    """Nested one-feature OLS search on the driver tables, see ``linear_feature_search_of``."""
    return linear_feature_search_of(datasets(spark, sf_dir), k=k)


def linear_feature_search_of(dsets: dict[str, DataFrame], spec: ModelSpec = DEFAULT_SPEC,
                             k: int = S.DEFAULT_FOLDS):
    """Nested CV with a grid search whose hyperparameter is the one feature of an
    OLS model (O-77, O-78, O-83, O-89): inner mean R2 per candidate inside every
    outer train part, best candidate refit on the train part, scored on the
    held-out fold.

    Rows at fold position p = k*a + b fall in the same inner fold for every
    outer fold when they share (b, a mod k), so one aggregate over these k^2
    cells (counts, means, co-moments) is all the inner search needs: fits and
    held-out SSE/SST both come from merged cell moments. One more row pass
    scores the outer folds (MAE needs rows). Returns (candidate_scores,
    fold_params, fold_metrics).
    """
    feats = list(dict.fromkeys(dict(spec.single_models).values()))
    cols = [*feats, "target"]
    spark = next(iter(dsets.values())).sparkSession
    cand_rows, param_rows, outer_preds = [], [], []
    for ds, df in dsets.items():
        f = (with_folds(df, spec=spec, k=k, position="fold_pos")
             .select("fold", "fold_pos", *feats, F.col(spec.target).alias("target")))
        f = f.withColumn("_c", (F.floor(F.col("fold_pos") / k) % k).cast("int")).checkpoint()
        cell = {}
        for (b, c), mom in _group_moments(f, ["fold", "_c"], cols).items():
            cell[(b, c)] = mom
        by_outer: dict[int, list] = {}
        for j in range(k):
            scores = {c_: [] for c_ in range(len(feats))}
            for i in range(k):
                train = [m for (b, c), m in cell.items() if b != j and S.inner_fold_of_cell(b, c, j, k) != i]
                held = [m for (b, c), m in cell.items() if b != j and S.inner_fold_of_cell(b, c, j, k) == i]
                if not train or not held:
                    continue
                tn, tmu, tm = M.merge_moments(train)
                hn, hmu, hm = M.merge_moments(held)
                for ci in range(len(feats)):
                    sub = np.ix_([ci, -1], [ci, -1])
                    b0, beta = M.ols_from_moments(tn, tmu[[ci, -1]], tm[sub])
                    scores[ci].append(M.r2_from_moments(hn, hmu[[ci, -1]], hm[sub], b0, float(beta[0])))
            for ci, vals in scores.items():
                mean = float(np.mean(vals))
                by_outer.setdefault(j, []).append((ci, mean))
                cand_rows.append((ds, "ols_select", j, ci, mean))
        expr = None
        for j, lst in by_outer.items():
            best = sorted(lst, key=lambda t: (-t[1], t[0]))[0][0]
            param_rows.append((ds, "ols_select", j, "feature", feats[best]))
            n, mu, m = M.merge_moments([mm for (b, c), mm in cell.items() if b != j])
            sub = np.ix_([best, -1], [best, -1])
            b0, beta = M.ols_from_moments(n, mu[[best, -1]], m[sub])
            v = F.lit(b0) + F.lit(float(beta[0])) * F.col(feats[best])
            expr = F.when(F.col("fold") == j, v) if expr is None else expr.when(F.col("fold") == j, v)
        outer_preds.append(f.select(F.lit(ds).alias("dataset"), "fold", "target", expr.alias("prediction")))
    cs = literal_frame(spark, cand_rows, "dataset string, model string, outer_fold int, candidate_idx int, mean_r2 double")
    fp = literal_frame(spark, param_rows, "dataset string, model string, fold int, name string, value string")
    op = functools.reduce(DataFrame.unionByName, outer_preds)
    fm = M.metrics_long(M.regression_metrics(op, "target", "prediction", ["dataset", "fold"])
                        .withColumn("model", F.lit("ols_select")), ["dataset", "model", "fold"])
    return cs, fp, fm


def _group_moments(df: DataFrame, keys: list[str], cols: list[str]) -> dict[tuple, tuple]:
    """(n, means, co-moments) of ``cols`` per group of ``keys``: one partial aggregate."""
    p = len(cols)
    aggs = [F.count(F.lit(1)).alias("_n")] + [F.avg(c).alias(f"_m{i}") for i, c in enumerate(cols)]
    aggs += [F.covar_pop(a, b).alias(f"_c{i}_{j}") for i, a in enumerate(cols) for j, b in enumerate(cols) if j >= i]
    out = {}
    for r in df.groupBy(*keys).agg(*aggs).collect():
        n = int(r["_n"])
        mu = np.array([r[f"_m{i}"] for i in range(p)])
        m = np.zeros((p, p))
        for i in range(p):
            for j in range(i, p):
                m[i, j] = m[j, i] = r[f"_c{i}_{j}"] * n
        out[tuple(int(r[kk]) for kk in keys)] = (n, mu, m)
    return out
