"""Nested search over regression trees by path evaluation (O-73, O-75, O-77, O-78, O-82..O-84, O-89).

A greedy tree of depth d is the first d levels of a deeper one, so a single tree per minimum leaf size
answers for every depth of the grid. A fit needs of its rows only, for each different vector of
feature bins, the count and the first two sums of the target: one aggregate over (vector, fold cell) serves
all train and held-out parts of the nested folds, see ``sampling.inner_fold_of_cell``.

Nodes with many vectors are split level by level for all fits together, by grouped
histograms of (fit, node, feature, bin) and one join; a node of bounded size is finished by the task that its
vectors are grouped in. Every row of the results is a sum over nodes, so both parts add up.
"""

from __future__ import annotations

import time
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.frames import literal_frame
from ..session import ensure_checkpoint_dir
from .sampling import inner_fold_of_cell

#: Vectors of a node that one task finishes.
LOCAL_VECTORS = 1_000_000
#: Cells of a histogram held at once inside a task.
HISTOGRAM_CELLS = 4_000_000
#: Answers of this many vectors are sent to the rows.
BROADCAST_ROWS = 500_000
#: A split must lower the squared error by more than this share of it: differences below are of rounding.
LEAST_GAIN = 1e-12

#: Scores equal to so many places are ties.
SCORE_PLACES = 9

FIT = ["outer", "inner"]
SUMS = ["tn", "ts", "hn", "hs", "hq"]
LEVEL_SCHEMA = ("outer int, inner int, leaf int, depth int, sse double, hn double, hs double, hq double, nodes bigint, gains array<double>")


# ------------------------------------------------------------------ bins and fits


def bin_cuts(df: DataFrame, features: Sequence[str], max_bins: int = 256) -> dict[str, list[float]]:
    """Cut points of each feature: the middles between its values, or where it has more than ``max_bins`` of
    them, so many quantiles. A value belongs left of a cut if it is at most the cut."""
    values = small_domains(df, features, max_bins)
    small = [c for c in features if c in values]
    large = [c for c in features if c not in small]
    shares = [i / max_bins for i in range(1, max_bins)]
    found = df.agg(*[F.percentile_approx(F.col(c).cast("double"), shares, 100 * max_bins).alias(c) for c in large]).first() if large else {}
    out = {}
    for c in features:
        if c in small:
            v = values[c]
            out[c] = [m if m < b else a for a, b, m in ((a, b, (a + b) / 2) for a, b in zip(v, v[1:]))]
        else:
            out[c] = sorted(set(found[c] or []))
    return out


def small_domains(df: DataFrame, features: Sequence[str], limit: int) -> dict[str, list[float]]:
    """The sorted values of each feature that has at most ``limit`` of them, nulls aside. One pass: a task holds up to so many values
    of a feature and gives it up beyond that."""
    names = list(features)

    def run(batches):
        held = [np.zeros(0) for _ in names]
        for batch in batches:
            for i, own in enumerate(held):
                if own is not None:
                    column = batch.column(i).drop_null().to_numpy(zero_copy_only=False)
                    held[i] = np.union1d(own, np.unique(column))
                    if len(held[i]) > limit:
                        held[i] = None
        yield pa.RecordBatch.from_arrays([pa.array(range(len(names)), pa.int32()), pa.array(held, pa.list_(pa.float64()))], names=["i", "own"])

    parts = df.select(*[F.col(c).cast("double").alias(c) for c in names]).mapInArrow(run, "i int, own array<double>")
    found = parts.select("i", F.col("own").isNull().alias("many"), F.explode_outer("own").alias("v")).groupBy("i").agg(
        F.bool_or(F.col("many")).alias("many"), F.sort_array(F.collect_set("v")).alias("own"))
    return {names[r["i"]]: r["own"] for r in found.where(~F.col("many") & (F.size("own") <= limit)).collect()}


def bin_names(n_features: int) -> list[str]:
    return [f"bin{i}" for i in range(n_features)]


def with_bins(df: DataFrame, cuts: dict[str, list[float]]) -> DataFrame:
    """Add a column bin0, bin1, ... for each feature: how many of its cuts lie below the value."""
    for name, (c, own) in zip(bin_names(len(cuts)), cuts.items()):
        if own:
            edges = [float("-inf"), *[float(np.nextafter(x, np.inf)) for x in own], float("inf")]
            df = Bucketizer(splits=edges, inputCol=c, outputCol=name, handleInvalid="error").transform(df)
        else:
            df = df.withColumn(name, F.lit(0.0))
    return df.withColumns({n: F.col(n).cast("int") for n in bin_names(len(cuts))})


def fit_vectors(df: DataFrame, target: str, position: str, k: int, n_features: int) -> DataFrame:
    """(outer, inner, bin0.., tn, ts, hn, hs, hq): count and sums of the target over the train rows and
    the held-out rows of every fit, per vector of bins. ``inner`` is -1 for the fit on a whole outer train part.

    ``position`` is the place p of a row in the folds' layout: p % k is its outer fold.
    """
    bins = bin_names(n_features)
    b, c = (F.col(position) % k).cast("int"), (F.floor(F.col(position) / k) % k).cast("int")
    y = F.col(target)
    cells = df.groupBy(*bins, b.alias("b"), c.alias("c")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(y).alias("s"), F.sum(y * y).alias("q"))
    # a vector has at most k * k cells: its sums for all fits are two products with the matrices of what each fit takes
    vectors = cells.groupBy(*bins).agg(F.collect_list(F.struct("b", "c", "n", "s", "q")).alias("cells"))
    train, held = fit_cells(k)
    outer, inner = (np.array(x, np.int32) for x in zip(*((o, i) for o in range(k) for i in range(-1, k))))

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1_000):
                part = batch.slice(at, 1_000)
                lists = part.column(n_features)
                row = np.repeat(np.arange(part.num_rows), np.asarray(lists.value_lengths()))
                b, c, *sums = lists.flatten().flatten()
                table = np.zeros((k * k, part.num_rows, 3))
                table[np.asarray(b) * k + np.asarray(c), row] = np.stack([x.cast(pa.float64()).fill_null(0.0).to_numpy() for x in sums], axis=1)
                t = (train @ table[:, :, :2].reshape(k * k, -1)).reshape(len(outer), -1, 2)
                h = (held @ table.reshape(k * k, -1)).reshape(len(outer), -1, 3)
                fit, vector = np.nonzero(t[:, :, 0] + h[:, :, 0])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(outer[fit]), pa.array(inner[fit])] + [part.column(i).take(pa.array(vector)) for i in range(n_features)]
                    + [pa.array(x[fit, vector, i]) for x, n in ((t, 2), (h, 3)) for i in range(n)], names=[*FIT, *bins, *SUMS])

    schema = ", ".join([f"{x} int" for x in (*FIT, *bins)] + [f"{x} double" for x in SUMS])
    return vectors.mapInArrow(run, schema)


def fit_cells(k: int) -> tuple[np.ndarray, np.ndarray]:
    """0 or 1 for each fit (outer, inner from -1 on) and cell b * k + c: whether its rows are trained on, and whether they are held out."""
    held, train = np.zeros((k, k + 1, k, k)), np.zeros((k, k + 1, k, k))
    for o in range(k):
        held[o, 0, o], train[o, 0] = 1, 1
        train[o, 0, o] = 0
        for b in range(k):
            for c in range(k):
                own = inner_fold_of_cell(b, c, o, k)
                if own is not None:
                    train[o, 1:, b, c] = 1
                    train[o, 1 + own, b, c], held[o, 1 + own, b, c] = 0, 1
    return train.reshape(-1, k * k), held.reshape(-1, k * k)


# ------------------------------------------------------------------ a node of bounded size


def best_splits(node: np.ndarray, bins: np.ndarray, tn: np.ndarray, ts: np.ndarray, m: int, leaf: int,
                allowed: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(feature, bin, gain) of the best split of each of ``m`` nodes; gain 0 where there is none.
    The first feature and the lowest bin win ties. ``node`` is sorted; ``allowed`` (nodes by features) leaves out features of a node."""
    feature, cut, gain = np.zeros(m, np.int64), np.zeros(m, np.int64), np.zeros(m)
    for f in range(bins.shape[1]):
        width = int(bins[:, f].max()) + 1 if len(bins) else 1
        if width < 2:
            continue
        step = max(1, HISTOGRAM_CELLS // width)
        for at in range(0, m, step):
            lo, hi = np.searchsorted(node, [at, min(m, at + step)])
            rows = min(m, at + step) - at
            key = (node[lo:hi] - at) * width + bins[lo:hi, f]
            n = np.bincount(key, weights=tn[lo:hi], minlength=rows * width).reshape(rows, width).cumsum(axis=1)
            s = np.bincount(key, weights=ts[lo:hi], minlength=rows * width).reshape(rows, width).cumsum(axis=1)
            total_n, total_s = n[:, -1:], s[:, -1:]
            n, s = n[:, :-1], s[:, :-1]
            ok = (n >= leaf) & (total_n - n >= leaf)
            with np.errstate(divide="ignore", invalid="ignore"):
                value = np.where(ok, s * s / n + (total_s - s) ** 2 / (total_n - n) - total_s ** 2 / total_n, 0.0)
            at_best = value.argmax(axis=1)
            value = value[np.arange(rows), at_best]
            part = slice(at, at + rows)
            better = value > gain[part] * (1 + 1e-9)
            if allowed is not None:
                better &= allowed[part, f]
            feature[part] = np.where(better, f, feature[part])
            cut[part] = np.where(better, at_best, cut[part])
            gain[part] = np.where(better, value, gain[part])
    return feature, cut, gain


def grow(bins: np.ndarray, sums: np.ndarray, leaf: int, start: int, depths: Sequence[int], floor: float, levels=None, allowed=None):
    """Grow a (sub)tree from depth ``start`` and yield, for each of ``depths`` from there on, what its
    first levels make of the held-out rows: (depth, sse, hn, hs, hq, nodes, gain of each feature).

    ``sums``: columns tn, ts, hn, hs, hq of each vector. ``levels`` (a list) receives, per level, the
    node of each vector (path number: 1, then twice the parent's and one more on the right) and its prediction. ``allowed``
    gives, for path numbers, which features these nodes may be split by.
    """
    tn, ts, hn, hs, hq = sums.T
    n_rows, depth = len(bins), start
    path = np.ones(n_rows, np.int64)
    value = np.full(n_rows, ts.sum() / tn.sum() if tn.sum() else 0.0)
    alive = np.arange(n_rows) if tn.sum() else np.zeros(0, np.int64)
    gains, nodes = np.zeros(bins.shape[1]), 1
    for wanted in [d for d in sorted(depths) if d >= start]:
        while depth < wanted and len(alive):
            number, node = np.unique(path[alive], return_inverse=True)
            order = np.argsort(node, kind="stable")
            alive, node = alive[order], node[order]
            feature, cut, gain = best_splits(node, bins[alive], tn[alive], ts[alive], len(number), leaf,
                                              None if allowed is None else allowed(number))
            split = gain > floor
            rows = alive[split[node]]
            node = node[split[node]]
            right = bins[rows, feature[node]] > cut[node]
            path[rows] = 2 * path[rows] + right
            np.add.at(gains, feature[split], gain[split])
            nodes += 2 * int(split.sum())
            child = 2 * node + right
            n, s = (np.bincount(child, weights=w[rows], minlength=2 * len(number)) for w in (tn, ts))
            with np.errstate(divide="ignore", invalid="ignore"):
                value[rows] = (s / n)[child]
            alive = rows
            depth += 1
            if levels is not None:
                levels.append((path.copy(), value.copy()))
        sse = float((hq - 2 * value * hs + value * value * hn).sum())
        yield wanted, sse, float(hn.sum()), float(hs.sum()), float(hq.sum()), nodes, gains.copy()


def unpack(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    bins = rows[[c for c in rows.columns if c.startswith("bin")]].to_numpy(dtype=np.int64)
    sums = rows[SUMS].to_numpy(dtype=np.float64)
    return bins, sums


# ------------------------------------------------------------------ levels over the cluster


def level_rows(nodes: DataFrame, depth: int, last: int) -> DataFrame:
    """What nodes of one depth, or leaves that end there (up to ``last``), make of their held-out rows."""
    return nodes.select(*FIT, "leaf", F.explode(F.sequence(F.lit(depth), F.lit(last))).alias("depth"),
                        (F.col("hq") - 2 * F.col("v") * F.col("hs") + F.col("v") * F.col("v") * F.col("hn")).alias("sse"),
                        "hn", "hs", "hq")


def split_large_nodes(state: DataFrame, depths: Sequence[int], floors: DataFrame, n_features: int, bound: int):
    """Split nodes of more than ``bound`` vectors, a level of all fits at a time.

    ``state``: vectors with fit, leaf, node, depth. Returns (vectors of the small nodes left, held-out rows of levels and
    of leaves as (fit, leaf, depth, sse, hn, hs, hq), gains as (fit, leaf, depth, feature, gain)).
    """
    key = [*FIT, "leaf", "node"]
    scores, gains, small = [], [], []
    last = max(depths)
    for depth in range(last + 1):
        sizes = state.groupBy(*key).agg(F.count("*").alias("m"), *[F.sum(c).alias(c) for c in SUMS])
        big = sizes.where((F.col("m") > bound) & (F.col("tn") > 0)).withColumn("v", F.col("ts") / F.col("tn")).checkpoint()
        if big.isEmpty():
            break
        small.append(state.join(big.select(*key), key, "left_anti").withColumn("depth", F.lit(depth)))
        large = state.join(big.select(*key), key)
        if depth == last:
            scores.append(level_rows(big, depth, last))
            state = state.limit(0)
            break
        histogram = large.select(*key, "tn", "ts", F.posexplode(F.array(*bin_names(n_features))).alias("feature", "bin")) \
            .groupBy(*key, "feature", "bin").agg(F.sum("tn").alias("n"), F.sum("ts").alias("s"))
        upto = Window.partitionBy(*key, "feature").orderBy("bin")
        cum = histogram.withColumns({"n": F.sum("n").over(upto), "s": F.sum("s").over(upto)})
        cum = cum.join(big.select(*key, F.col("tn").alias("all_n"), F.col("ts").alias("all_s")), key) \
            .where((F.col("n") >= F.col("leaf")) & (F.col("all_n") - F.col("n") >= F.col("leaf")))
        gain = F.col("s") ** 2 / F.col("n") + (F.col("all_s") - F.col("s")) ** 2 / (F.col("all_n") - F.col("n")) - F.col("all_s") ** 2 / F.col("all_n")
        best = cum.withColumn("gain", gain).groupBy(*key).agg(
            F.max(F.struct("gain", (-F.col("feature")).alias("f"), (-F.col("bin")).alias("b"))).alias("best"))
        best = best.select(*key, "best.gain", (-F.col("best.f")).alias("feature"), (-F.col("best.b")).alias("bin")) \
            .join(floors, FIT).where(F.col("gain") > F.col("floor")).drop("floor").checkpoint()
        ended = big.join(best.select(*key), key, "left_anti")
        scores += [level_rows(big.join(best.select(*key), key, "left_semi"), depth, depth), level_rows(ended, depth, last)]
        gains.append(best.select(*FIT, "leaf", F.lit(depth + 1).alias("depth"), "feature", "gain"))
        right = (F.element_at(F.array(*bin_names(n_features)), F.col("feature") + 1) > F.col("bin")).cast("bigint")
        state = large.join(best.drop("gain"), key).withColumn("node", 2 * F.col("node") + right).drop("feature", "bin").checkpoint()
    rest = state.withColumn("depth", F.lit(depth))
    for s in small:
        rest = rest.unionByName(s)
    return rest, scores, gains


def search_levels(fits: DataFrame, leaves: Sequence[int], depths: Sequence[int], n_features: int,
                  bound: int = LOCAL_VECTORS) -> DataFrame:
    """(outer, inner, leaf, depth, r2, nodes, gains): for every fit and candidate the held-out R2 (against the
    held-out rows' own mean) and the gain of each feature. ``fits`` as of ``fit_vectors``; ``nodes`` is null for
    a fit that was split over the cluster."""
    whole = fits.groupBy(*FIT).agg(F.count("*").alias("m"), *[F.sum(c).alias(c) for c in SUMS],
                                   F.sum(F.when(F.col("tn") > 0, F.col("ts") ** 2 / F.col("tn")).otherwise(0.0)).alias("between"))
    # what a split can win at all bounds the size of a gain that is not rounding
    floors = whole.select(*FIT, ((F.col("between") + 1e-300) * LEAST_GAIN).alias("floor"))
    every = list(range(max(depths) + 1))
    sizes = whole.select("m").agg(F.max("m")).first()[0] or 0
    scores, gains = [], []
    state = fits.withColumn("node", F.lit(1).cast("bigint"))
    if sizes > bound:
        state = state.withColumn("leaf", F.explode(F.array(*[F.lit(int(x)) for x in leaves])))
        state, scores, gains = split_large_nodes(state, every, floors, n_features, bound)
    else:  # one task grows the trees of all leaf sizes from the same vectors
        state = state.withColumns({"leaf": F.lit(0), "depth": F.lit(0)})

    def finish(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        bins, sums = unpack(rows)
        outer, inner, own, _, start = (int(x) for x in key)
        wanted = depths if start == 0 else [d for d in every if d >= start]
        out = [(outer, inner, leaf, d, *rest) for leaf in (leaves if own == 0 else [own])
               for d, *rest in grow(bins, sums, int(leaf), start, wanted, float(rows["floor"].iloc[0]))]
        return pd.DataFrame(out, columns=[c.split()[0] for c in LEVEL_SCHEMA.split(", ")])

    local = state.join(floors, FIT).groupBy(*FIT, "leaf", "node", "depth").applyInPandas(finish, LEVEL_SCHEMA)
    keys = [*FIT, "leaf", "depth"]
    rows = local.select(*keys, "sse", "hn", "hs", "hq", "nodes", "gains")
    empty = F.array(*[F.lit(0.0)] * n_features)
    for s in scores:
        rows = rows.unionByName(s.withColumns({"nodes": F.lit(None).cast("bigint"), "gains": empty}))
    for g in gains:  # a split counts for every deeper tree
        one = F.transform(F.sequence(F.lit(0), F.lit(n_features - 1)), lambda i: F.when(i == F.col("feature"), F.col("gain")).otherwise(0.0))
        wide = g.withColumn("gains", one).withColumn("depth", F.explode(F.sequence(F.col("depth"), F.lit(max(depths)))))
        rows = rows.unionByName(wide.select(*keys, *[F.lit(0.0).alias(c) for c in ("sse", "hn", "hs", "hq")],
                                            F.lit(None).cast("bigint").alias("nodes"), "gains"))
    total = rows.where(F.col("depth").isin([int(d) for d in depths])).groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in ("sse", "hn", "hs", "hq", "nodes")],
        F.array(*[F.sum(F.col("gains")[i]) for i in range(n_features)]).alias("gains"))
    sst = F.col("hq") - F.col("hs") ** 2 / F.col("hn")
    return total.select(*keys, (1.0 - F.try_divide("sse", sst)).alias("r2"), "nodes", "gains")


def refit(fits: DataFrame, chosen: DataFrame, n_features: int) -> tuple[DataFrame, DataFrame]:
    """Predictions and nodes of the fit on each whole outer train part, with its chosen candidate.

    ``chosen``: (outer, leaf, max_depth), one row an outer fold. Returns (outer, bin0.., prediction) for the vectors of the held-out
    rows and (outer, node, n, value, seconds), the nodes by path number. These trees are of the size that the search
    has shown to be best; a part beyond ``LOCAL_VECTORS`` vectors raises.
    """
    bins_ = bin_names(n_features)
    schema = "outer int, " + ", ".join(f"{b} int" for b in bins_) + ", prediction double, node bigint, n double, value double, seconds double"

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        if len(rows) > LOCAL_VECTORS:
            raise ValueError(f"a train part of {len(rows)} vectors: use fewer bins")
        t0 = time.perf_counter()
        bins, sums = unpack(rows)
        levels = [(np.ones(len(rows), np.int64), np.full(len(rows), sums[:, 1].sum() / max(sums[:, 0].sum(), 1)))]
        for _ in grow(bins, sums, int(rows["leaf"].iloc[0]), 0, [int(rows["max_depth"].iloc[0])], float(rows["floor"].iloc[0]), levels):
            pass
        took = time.perf_counter() - t0
        outer = int(key[0])
        held = sums[:, 2] > 0
        predicted = pd.DataFrame(bins[held], columns=bins_).assign(prediction=levels[-1][1][held])
        seen: set[int] = set()
        made = []
        for path, value in levels:
            number, first, back = np.unique(path, return_index=True, return_inverse=True)
            n = np.bincount(back, weights=sums[:, 0])
            for p, i, c in zip(number.tolist(), first.tolist(), n.tolist()):
                if p not in seen:
                    seen.add(p)
                    made.append((p, c, float(value[i])))
        out = pd.concat([predicted, pd.DataFrame(made, columns=["node", "n", "value"])], ignore_index=True).assign(outer=outer, seconds=took)
        out = out.astype({**dict.fromkeys(bins_, "Int32"), "node": "Int64"})
        return out[["outer", *bins_, "prediction", "node", "n", "value", "seconds"]]

    parts = fits.where("inner = -1").join(chosen, "outer")
    whole = fits.where("inner = -1").groupBy("outer").agg(
        (F.sum(F.when(F.col("tn") > 0, F.col("ts") ** 2 / F.col("tn")).otherwise(0.0)) * LEAST_GAIN).alias("floor"))
    made = parts.join(whole, "outer").groupBy("outer").applyInPandas(run, schema).checkpoint()
    return (made.where("node is null").select("outer", *bins_, "prediction"),
            made.where("node is not null").select("outer", "node", "n", "value", "seconds"))


def brief(answers: DataFrame) -> DataFrame:
    """Written answers, marked for a broadcast join if they are few; else the rows are dealt out to them."""
    return F.broadcast(answers) if answers.count() <= BROADCAST_ROWS else answers


# ------------------------------------------------------------------ the nested search


def nested_tree_search(df: DataFrame, features: Sequence[str], target: str, position: str, depths: Sequence[int],
                       leaves: Sequence[int], k: int = 10, max_bins: int = 256):
    """Grid search of depth and minimum leaf size on the inner folds of each outer train part, then a refit on
    that part, scored on the outer fold.

    Candidates are numbered as a grid with depth outermost. Returns (rows with ``fold`` and ``prediction``,
    candidate scores (outer_fold, candidate_idx, mean_r2), per-fold dicts with best_idx, best_params, importances, fit_seconds,
    the candidates, the nodes of the refitted trees). Ties go to the first candidate.
    """
    ensure_checkpoint_dir(df.sparkSession)
    cands = [{"maxDepth": int(d), "minInstancesPerNode": int(m)} for d in depths for m in leaves]
    mean = df.agg(F.avg(target)).first()[0] or 0.0   # sums of centred values keep their digits
    cuts = bin_cuts(df, features, max_bins)
    bins = bin_names(len(features))
    binned = with_bins(df, cuts).withColumn("_y", F.col(target) - F.lit(float(mean)))
    fits = fit_vectors(binned, "_y", position, k, len(features)).checkpoint()
    levels = search_levels(fits, leaves, depths, len(features)).checkpoint()
    number = {(c["maxDepth"], c["minInstancesPerNode"]): i for i, c in enumerate(cands)}
    idx = literal_frame(df.sparkSession, [(d, m, i) for (d, m), i in number.items()], "depth int, leaf int, candidate_idx int")
    scored = levels.join(idx, ["depth", "leaf"])
    scores = scored.where("inner >= 0").groupBy(F.col("outer").alias("outer_fold"), "candidate_idx").agg(F.avg("r2").alias("mean_r2"))
    best = {}
    for r in scores.orderBy("outer_fold", F.round("mean_r2", SCORE_PLACES).desc_nulls_last(), "candidate_idx").collect():   # k times the grid
        best.setdefault(r["outer_fold"], r["candidate_idx"])
    chosen = literal_frame(df.sparkSession, [(o, cands[i]["minInstancesPerNode"], cands[i]["maxDepth"]) for o, i in best.items()],
                           "outer int, leaf int, max_depth int")
    predicted, nodes = refit(fits, chosen, len(features))
    gains = {(r["outer"], r["candidate_idx"]): r["gains"] for r in scored.where("inner = -1").select("outer", "candidate_idx", "gains").collect()}
    seconds = {r["outer"]: r["seconds"] for r in nodes.groupBy("outer").agg(F.max("seconds").alias("seconds")).collect()}
    folds = []
    for o, i in sorted(best.items()):
        g = np.array(gains[o, i], dtype=float)
        folds.append({"fold": o, "best_idx": i, "best_params": {n: str(v) for n, v in cands[i].items()},
                      "importances": (g / g.sum() if g.sum() else g).tolist(), "fit_seconds": seconds.get(o, 0.0)})
    answers = predicted.select(F.col("outer").alias("fold"), *bins, (F.col("prediction") + F.lit(float(mean))).alias("prediction"))
    rows = binned.withColumn("fold", (F.col(position) % k).cast("int")).join(brief(answers), ["fold", *bins])
    return rows.drop(*bins, "_y"), scores, folds, cands, nodes.withColumn("value", F.col("value") + F.lit(float(mean)))
