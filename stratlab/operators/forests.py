"""Nested search over random forests by path evaluation (O-74, O-76, O-77, O-78, O-82, O-83, O-89).

Every row is drawn into the bag of every tree as often as a Poisson variable of mean 1 says, as MLlib bags. One aggregate
over (vector of feature bins, folds) counts and sums the bags of some trees; it serves every train and held-out part of the
nested folds. The features that a node may be split by are drawn by a hash of tree and node, so the first trees and the first levels
of a large forest are a smaller one: one growth answers for all numbers of trees and depths of the grid.
A fit is grown by the task that its vectors are grouped in, several trees side by side. A pass takes as many trees as keep the bags
of a fit within ``PASS_NUMBERS``; it leaves sums of their predictions, which add up to the forests of the grid.
"""

from __future__ import annotations

import functools
import itertools
import math
import time
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.frames import literal_frame
from .trees import FIT, LEAST_GAIN, bin_cuts, bin_names, brief, with_bins

#: Vectors of a fit that one task may hold.
FIT_VECTORS = 2_000_000
#: Numbers of the bags that a pass makes of a fit, two a vector and tree: a pass takes so many trees, but one at least.
PASS_NUMBERS = 2_000_000
#: Rows that a task draws bags for; vectors, and numbers of their bags, that a task sums up for the fits.
TASK_ROWS = 50_000
TASK_VECTORS = 2_000
TASK_NUMBERS = 10_000_000
#: (vector, tree) pairs that are grown side by side.
ENTRIES_AT_ONCE = 60_000
#: Passes over the trees at once, so that the last tasks of one leave no core idle.
PASSES_AT_ONCE = 2
#: Passes whose sums are added up at a time.
PASSES_TO_ADD = 8


def subset_count(strategy: str, n_features: int) -> int:
    """How many features a node may be split by, as MLlib reads the strategy."""
    named = {"all": n_features, "sqrt": math.ceil(math.sqrt(n_features)), "onethird": math.ceil(n_features / 3), "auto": math.ceil(n_features / 3),
             "log2": max(1, math.ceil(math.log2(n_features)))}
    if strategy in named:
        return named[strategy]
    return min(n_features, int(strategy)) if strategy.isdigit() else math.ceil(float(strategy) * n_features)


def poisson_steps() -> list[float]:
    """A uniform number that is at least n of these gives n: a Poisson variable of mean 1."""
    steps, p, total = [], math.exp(-1), 0.0
    for n in range(1, 16):
        total += p
        p /= n
        steps.append(total)
    return steps


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def tree_starts(seed: int, first: int, n_trees: int) -> np.ndarray:
    """Where the draws of features of trees ``first``, ``first`` + 1, ... start."""
    return mixed(np.uint64(seed * 1_000_003 + 1) + np.arange(first, first + n_trees).astype(np.uint64))


def drawn_features(start: np.ndarray, number: np.ndarray, n_features: int, size: int) -> np.ndarray:
    """Whether nodes (path number, start of their tree) may be split by a feature: ``size`` of them at random."""
    draw = mixed(mixed(number.astype(np.uint64) + start)[:, None] + np.arange(1, n_features + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return draw.argsort(axis=1).argsort(axis=1) < size


def node_subset(seed: int, tree: int, n_features: int, size: int):
    """Features allowed to nodes of a tree by path number; None if all are."""
    if size >= n_features:
        return None
    start = tree_starts(seed, tree, 1)
    return lambda number: drawn_features(start, number, n_features, size)


# ------------------------------------------------------------------ bags


def dealt_rows(binned: DataFrame, target: str, fold: str, inner: str, n_features: int) -> DataFrame:
    """(bin0.., fold, inner, y), written, with the rows of a vector and fold cell side by side; their layout depends on nothing but the rows."""
    bins = bin_names(n_features)
    key = [*bins, "fold", "inner"]
    rows = binned.select(*bins, F.col(fold).alias("fold"), F.col(inner).alias("inner"), F.col(target).cast("double").alias("y"))
    return rows.repartition(max(1, math.ceil(binned.count() / TASK_ROWS)), *key).sortWithinPartitions(*key, "y").checkpoint()


def drawn_cells(rows: DataFrame, trees: Sequence[int], n_features: int, seed: int) -> DataFrame:
    """(bin0.., fold, inner, n, s, q, bags) of rows as of ``dealt_rows``: count and sums of the target of all rows, and count and sum of the
    rows in the bag of each tree. A cell whose rows come in several batches has several parts. A tree draws by a generator of its own in each partition."""
    steps = poisson_steps()
    trees = list(trees)
    bins = bin_names(n_features)
    schema = T.StructType([*rows.schema.fields[:-1], *[T.StructField(c, T.DoubleType()) for c in "nsq"], T.StructField("bags", T.ArrayType(T.DoubleType()))])

    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        draws = [np.random.default_rng([seed, t, part]) for t in trees]
        for batch in batches:
            m = batch.num_rows
            if not m:
                continue
            fold, inner = batch.column(n_features), batch.column(n_features + 1)
            key = np.stack([batch.column(i).to_numpy() for i in range(n_features)] + [fold.to_numpy()], axis=1)
            within = inner.flatten().fill_null(-1).to_numpy().reshape(m, -1)
            first = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(axis=1) | (within[1:] != within[:-1]).any(axis=1)])
            y = batch.column(n_features + 2).fill_null(0.0).to_numpy()
            bags = np.empty((len(first), 2 * len(trees)))
            for i, rng in enumerate(draws):
                times = np.searchsorted(steps, rng.random(m), side="right").astype(float)
                bags[:, 2 * i] = np.add.reduceat(times, first)
                bags[:, 2 * i + 1] = np.add.reduceat(times * y, first)
            sums = [np.diff(np.r_[first, m]).astype(float), np.add.reduceat(y, first), np.add.reduceat(y * y, first)]
            yield pa.RecordBatch.from_arrays([batch.column(i).take(pa.array(first)) for i in range(n_features + 2)] + [pa.array(x) for x in sums] + [lists(bags)],
                                             names=[*bins, "fold", "inner", "n", "s", "q", "bags"])

    return rows.mapInArrow(run, schema)


def lists(x: np.ndarray) -> pa.Array:
    """The rows of a matrix as lists."""
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(np.ascontiguousarray(x).ravel()))


def matrix(column) -> np.ndarray:
    """Lists of one length as the rows of a matrix."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy().reshape(len(flat), -1)


def bagged_cells(binned: DataFrame, target: str, fold: str, inner: str, n_trees: int, n_features: int, seed: int) -> DataFrame:
    """``drawn_cells`` of the first ``n_trees`` trees."""
    return drawn_cells(dealt_rows(binned, target, fold, inner, n_features), range(n_trees), n_features, seed)


def bagged_fits(cells: DataFrame, folds: Sequence[int], n_features: int, n_parts: int = 1) -> DataFrame:
    """(outer, inner, bin0.., bags, hn, hs, hq) of every fit, per vector: sums of the train rows' bags and of the held-out rows. ``inner`` is -1
    for the fit on a whole outer train part. ``n_parts`` tasks make them."""
    bins = bin_names(n_features)
    vectors = cells.repartition(n_parts, *bins).groupBy(*bins).agg(F.collect_list(F.struct("fold", "inner", "n", "s", "q", "bags")).alias("cells"))
    k = len(folds)
    outer = np.repeat(np.array(folds, np.int32), k + 1)
    within = np.tile(np.arange(-1, k, dtype=np.int32), k)

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 20):
                batch = whole.slice(at, 20)
                column = batch.column(n_features)
                ends = np.cumsum(column.value_lengths().to_numpy())
                fold_, inner_, *sums_, bags_ = column.flatten().flatten()
                folds_, sums, bags = fold_.to_numpy(), np.stack([x.to_numpy() for x in sums_], axis=1), matrix(bags_)
                inners = inner_.flatten().fill_null(-1).to_numpy().reshape(len(folds_), -1)
                away = folds_[None, :] != outer[:, None]
                same = inners[:, outer].T == within[:, None]
                held = np.where(within[:, None] < 0, ~away, away & same).astype(float)
                train = np.where(within[:, None] < 0, away, away & ~same).astype(float)
                made = []
                for j, (lo, hi) in enumerate(zip([0, *ends[:-1]], ends)):
                    fit = np.flatnonzero(held[:, lo:hi].any(axis=1) | train[:, lo:hi].any(axis=1))
                    made.append((np.full(len(fit), j), fit, (held[:, lo:hi] @ sums[lo:hi])[fit], (train[:, lo:hi] @ bags[lo:hi])[fit]))
                vector, fit, h, b = (np.concatenate(x) for x in zip(*made))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(outer[fit]), pa.array(within[fit])] + [batch.column(i).take(pa.array(vector)) for i in range(n_features)]
                    + [lists(b)] + [pa.array(np.ascontiguousarray(h[:, i])) for i in range(3)], names=[*FIT, *bins, "bags", "hn", "hs", "hq"])

    return vectors.mapInArrow(run, ", ".join(f"{x} int" for x in (*FIT, *bins)) + ", bags array<double>, hn double, hs double, hq double")


# ------------------------------------------------------------------ growth


def grow_together(bins: np.ndarray, tn: np.ndarray, ts: np.ndarray, depths: Sequence[int], start: np.ndarray, size: int
                  ) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Grow trees side by side, level by level, and yield at each of ``depths``, in order: (depth, prediction of each vector by each tree, gain of
    each feature in each tree), arrays that later levels go on with.

    ``tn`` and ``ts`` (trees by vectors) are counts and sums of the target in the bags. A node is a run of entries (tree, vector). Features of
    more than two bins keep the entries sorted by node and bin, so that the sums left of a cut are running sums; what is summed are
    differences from the node's mean, which end at 0 with each node. The first feature and the lowest bin win ties.
    """
    n_trees, n_vectors = tn.shape
    n_features = bins.shape[1]
    n_all = n_trees * n_vectors
    flat_n, flat_s = np.ascontiguousarray(tn).ravel(), np.ascontiguousarray(ts).ravel()
    tree_n, tree_s = tn.sum(axis=1), ts.sum(axis=1)
    with np.errstate(divide="ignore", invalid="ignore"):
        value = np.repeat(np.where(tree_n > 0, tree_s / tree_n, 0.0), n_vectors)
        floor = (np.where(tn > 0, ts * ts / tn, 0.0).sum(axis=1) + 1e-300) * LEAST_GAIN
    gains = np.zeros((n_trees, n_features))
    widths = bins.max(axis=0) + 1 if n_vectors else np.ones(n_features, np.int64)
    narrow = [f for f in range(n_features) if widths[f] == 2]
    flat_bins = np.tile(bins.T.astype(np.int16 if widths.max() < 32_000 else np.int32)[:, None, :], (1, n_trees, 1)).ravel()
    # features of two bins are counted a few at a time, by their combinations
    groups = []
    for own in (narrow[i:i + 3] for i in range(0, len(narrow), 3)):
        kinds, kind = np.unique(bins[:, own], axis=0, return_inverse=True)
        groups.append((own, (kinds == 0).astype(float), np.tile(kind.ravel(), n_trees)))
    tree = np.flatnonzero(tree_n > 0) if n_vectors > 1 else np.zeros(0, np.int64)
    orders = {f: (tree[:, None] * n_vectors + bins[:, f].argsort(kind="stable")).ravel() for f in [f for f in range(n_features) if widths[f] > 2] or [0]}
    base = next(iter(orders))
    lens, path = np.full(len(tree), n_vectors), np.ones(len(tree), np.int64)
    n, s = tree_n[tree], tree_s[tree]
    code = np.zeros(n_all, np.int8)
    last = max(depths)
    for depth in range(last + 1):
        if depth in depths:
            yield depth, value.reshape(n_trees, n_vectors), gains
        if depth == last or not len(lens):
            continue
        m = len(lens)
        node = np.repeat(np.arange(m), lens)
        order = orders[base]
        wn, ws = flat_n[order], flat_s[order]
        whole = n.astype(np.int64)
        before = np.repeat(whole.cumsum() - whole, lens)
        means = np.repeat(s / n, lens)
        found = {}
        rest = ws - wn * means
        for own, zero, kind in groups:
            key = node * len(zero) + kind[order]
            left = np.bincount(key, weights=wn, minlength=m * len(zero)).reshape(m, -1) @ zero
            c = np.bincount(key, weights=rest, minlength=m * len(zero)).reshape(m, -1) @ zero
            spread = left * (n[:, None] - left)
            won = np.divide(c * c * n[:, None], spread, out=np.zeros(c.shape), where=spread > 0)
            found.update({f: (won[:, i], 0) for i, f in enumerate(own)})
        for f, own in orders.items():
            if widths[f] < 3:
                continue
            w = flat_n[own]
            c = (flat_s[own] - w * means).cumsum()
            left = w.astype(np.int64).cumsum() - before
            b = flat_bins[f * n_all + own]
            ends = np.flatnonzero(b[1:] != b[:-1])
            left, of = left[ends], node[ends]
            spread = left * (whole[of] - left)
            some = np.flatnonzero(spread > 0)
            if len(some) < len(ends):
                ends, of, spread = ends[some], of[some], spread[some]
            won, at = np.zeros(m), np.zeros(m, np.int64)
            if len(ends):
                c = c[ends]
                each = c * c / spread
                first = np.flatnonzero(of[1:] != of[:-1]) + 1
                runs = np.concatenate([[0], first])
                most = np.maximum.reduceat(each, runs)
                hits = np.flatnonzero(each == np.repeat(most, np.diff(runs, append=len(of))))
                hits = hits[np.searchsorted(hits, runs)]
                won[of[runs]] = most * n[of[runs]]
                at[of[runs]] = b[ends[hits]]
            found[f] = won, at
        gain, feature, cut = np.zeros(m), np.zeros(m, np.int64), np.zeros(m, np.int64)
        allowed = None if size >= n_features else drawn_features(start[tree], path, n_features, size)
        for f in sorted(found):
            won, at = found[f]
            better = won > gain * (1 + 1e-9)
            if allowed is not None:
                better &= allowed[:, f]
            feature[better] = f
            cut = np.where(better, at, cut)
            gain[better] = won[better]
        split = gain > floor[tree]
        np.add.at(gains, (tree[split], feature[split]), gain[split])
        child = 2 * node + (flat_bins[np.repeat(feature * n_all, lens) + order] > np.repeat(cut, lens))
        child_n, child_s = np.bincount(child, weights=wn, minlength=2 * m), np.bincount(child, weights=ws, minlength=2 * m)
        child_len = np.bincount(child, minlength=2 * m)
        divided = np.repeat(split, 2)
        with np.errstate(divide="ignore", invalid="ignore"):
            child_value = child_s / child_n
        of_split = np.flatnonzero(divided[child])
        value[order[of_split]] = child_value[child[of_split]]
        live = divided & (child_len > 1)   # a child of one vector is a leaf
        code[order] = np.where(live, np.tile([0, 1], m), 2).astype(np.int8)[child]
        # left and right children keep their entries' order: each has a place for them
        lens = np.where(live, child_len, 0)
        at = lens.cumsum() - lens
        places = [np.arange(n_.sum()) + np.repeat(at_ - (n_.cumsum() - n_), n_) for n_, at_ in ((lens[x::2], at[x::2]) for x in (0, 1))]
        for f, own in orders.items():
            side = code[own]
            orders[f] = np.empty(lens.sum(), np.int64)
            for x in (0, 1):
                orders[f][places[x]] = own[np.flatnonzero(side == x)]
        lens, n, s = lens[live], child_n[live], child_s[live]
        path, tree = np.stack([2 * path, 2 * path + 1], axis=1).ravel()[live], np.repeat(tree, 2)[live]


def piece_sums(bins: np.ndarray, bags: np.ndarray, first: int, ends: Sequence[int], depths: Sequence[int], size: int, seed: int):
    """Grow trees ``first`` .. max(``ends``) - 1, whose bags are ``bags``, and yield for each piece that ends before one of ``ends``, in order: (end, sums
    over its trees of the predictions (depths by vectors) and of the shares of the features in the gains (depths by features))."""
    depths = sorted(set(depths))
    starts = tree_starts(seed, first, bags.shape[1] // 2)
    step = max(1, ENTRIES_AT_ONCE // max(1, len(bins)))
    lo = first
    for end in sorted(set(ends)):
        total, weight = np.zeros((len(depths), len(bins))), np.zeros((len(depths), bins.shape[1]))
        for at in range(lo, end, step):
            own = slice(at - first, min(end, at + step) - first)
            tn, ts = (np.ascontiguousarray(bags[:, x::2][:, own].T) for x in (0, 1))
            for d, value, gains in grow_together(bins, tn, ts, depths, starts[own], size):
                i = depths.index(d)
                total[i] += value.sum(axis=0)
                all_ = gains.sum(axis=1, keepdims=True)
                weight[i] += np.divide(gains, all_, out=np.zeros_like(gains), where=all_ > 0).sum(axis=0)
        yield end, total, weight
        lo = end


def forest(bins: np.ndarray, bags: np.ndarray, depths: Sequence[int], numbers: Sequence[int], size: int, seed: int):
    """Grow the trees and yield, whenever one of ``numbers`` of them is done: (number, depth, prediction of each vector, feature importances)."""
    depths = sorted(set(depths))
    total, weight = np.zeros((len(depths), len(bins))), np.zeros((len(depths), bins.shape[1]))
    for end, t, w in piece_sums(bins, bags, 0, numbers, depths, size, seed):
        total, weight = total + t, weight + w
        for i, d in enumerate(depths):
            yield end, d, total[i] / end, weight[i] / weight[i].sum() if weight[i].sum() else weight[i].copy()


def passes(numbers: Sequence[int], n_vectors: int) -> list[tuple[tuple[int, ...], list[list[int]]]]:
    """The trees as passes, [first tree, ends of its pieces]: a piece ends where a forest of the grid does, or with the pass. Grouped by the forests
    that their pieces complete, or lead to."""
    step = max(1, PASS_NUMBERS // (2 * max(1, n_vectors)))
    last = max(numbers)
    found = [[at, *sorted({n for n in numbers if at < n < at + step} | {min(last, at + step)})] for at in range(0, last, step)]
    return [(g, list(own)) for g, own in itertools.groupby(found, lambda p: tuple(min(n for n in numbers if n >= end) for end in p[1:]))]


def added(parts: Sequence[DataFrame], n_features: int, n_sums: int, n_notes: int) -> DataFrame:
    """The lines of several passes with the same pieces, added up."""
    bins = bin_names(n_features)
    lines = parts[0]
    for p in parts[1:]:
        lines = lines.unionByName(p)
    whole = [F.when(F.first(F.col(c)).isNotNull(), F.array(*[F.sum(F.get(F.col(c), F.lit(i))) for i in range(n)])).alias(c) for c, n in (("sums", n_sums), ("notes", n_notes))]
    return lines.groupBy(*FIT, "part", *bins).agg(*whole, *[F.max(c).alias(c) for c in ("hn", "hs", "hq")]).checkpoint()


# ------------------------------------------------------------------ the nested search


def in_order(table: pa.Table, n_features: int, *columns: str) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Bins and columns of a table of vectors, and the order they are put in; whatever order these come in, sums over them are the same."""
    bins = np.stack([table.column(b).to_numpy() for b in bin_names(n_features)], axis=1).astype(np.int64)
    order = np.lexsort(bins.T)
    return bins[order], [table.column(c).to_numpy()[order] for c in columns], order


def and_null(x: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.concat_arrays([pa.array(np.ascontiguousarray(x)).cast(kind), pa.nulls(1, kind)])


def nested_forest_search(df: DataFrame, features: Sequence[str], target: str, fold: str, inner: str, cands: Sequence[dict[str, str]],
                         max_bins: int, seed: int):
    """Grid search over ``cands`` (numTrees, maxDepth, featureSubsetStrategy) on the inner folds of each outer train part, and a fit on that
    part with the best of them, scored on the outer fold: (rows with ``prediction``, per-fold dicts). None if a fit is too large for a task.

    The trees of an outer train part are those of the fit on it whichever candidate is best, so they grow in the same passes.
    ``df`` is read several times (a checkpoint).
    """
    spark = df.sparkSession
    t0 = time.perf_counter()
    n_features = len(features)
    sizes = [subset_count(c["featureSubsetStrategy"], n_features) for c in cands]
    trees, depths = [int(c["numTrees"]) for c in cands], [int(c["maxDepth"]) for c in cands]
    all_sizes, all_depths = sorted(set(sizes)), sorted(set(depths))
    at = [(all_sizes.index(s), all_depths.index(d)) for s, d in zip(sizes, depths)]
    folds = sorted(r[0] for r in df.select(fold).distinct().collect())   # k rows
    mean = df.agg(F.avg(target)).first()[0] or 0.0   # sums of centred values keep their digits
    bins = bin_names(n_features)
    binned = with_bins(df, bin_cuts(df, features, max_bins))
    n_vectors = binned.select(*bins).distinct().count()
    if n_vectors > FIT_VECTORS:
        return None
    rows = dealt_rows(binned.withColumn("_y", F.col(target) - F.lit(float(mean))), "_y", fold, inner, n_features)
    planned = passes(trees, n_vectors)
    k = len(folds)
    made_schema = ", ".join(f"{c} int" for c in (*FIT, "part", *bins)) + ", sums array<double>, notes array<double>, hn double, hs double, hq double"

    def grown(part: int, first: int, ends: list[int]) -> DataFrame:
        """A line for each held-out vector of each fit, with sums (sizes, pieces, depths), and one without bins, with notes for each
        size and piece: shares of the features at each depth, and seconds."""
        def run(key, table):
            x, (hn, hs, hq), order = in_order(table, n_features, "hn", "hs", "hq")
            bags = matrix(table.column("bags"))[order]
            held = hn > 0
            sums, notes = [], []
            for size in all_sizes:
                t1 = time.perf_counter()
                for _, total, weight in piece_sums(x, bags, first, ends, all_depths, size, seed):
                    sums.append(total[:, held])
                    notes += [*weight.ravel(), time.perf_counter() - t1]
                    t1 = time.perf_counter()
            m = int(held.sum())
            columns = [pa.array(np.full(m + 1, v, np.int32)) for v in (key[0].as_py(), key[1].as_py(), part)]
            columns += [and_null(x[held, i], pa.int32()) for i in range(n_features)]
            columns += [pa.concat_arrays([lists(np.concatenate(sums).T), pa.nulls(1, pa.list_(pa.float64()))]),
                        pa.concat_arrays([pa.nulls(m, pa.list_(pa.float64())), lists(np.array([notes]))])]
            return pa.Table.from_arrays(columns + [and_null(v[held], pa.float64()) for v in (hn, hs, hq)],
                                        names=[*FIT, "part", *bins, "sums", "notes", "hn", "hs", "hq"])

        n_trees = max(ends) - first
        n_parts = max(math.ceil(n_vectors / TASK_VECTORS), math.ceil(n_vectors * 2 * n_trees * k * k / TASK_NUMBERS))
        fits = bagged_fits(drawn_cells(rows, range(first, max(ends)), n_features, seed), folds, n_features, max(1, n_parts))
        return fits.repartition(k * (k + 1), *FIT).groupBy(*FIT).applyInArrow(run, made_schema).checkpoint()

    def group(part: int) -> DataFrame:
        pieces, own = planned[part]
        n_sums = len(all_sizes) * len(pieces) * len(all_depths)
        lines: list[DataFrame] = []
        for i, (first, *ends) in enumerate(own, 1):
            lines.append(grown(part, first, ends))
            if len(lines) > PASSES_TO_ADD or (i == len(own) and len(lines) > 1):
                lines = [added(lines, n_features, n_sums, n_sums * n_features + len(all_sizes) * len(pieces))]
        return lines[0]

    with ThreadPoolExecutor(PASSES_AT_ONCE) as pool:
        made = functools.reduce(DataFrame.unionByName, pool.map(group, range(len(planned))))

    def forests(table: pa.Table) -> tuple[np.ndarray, list[np.ndarray], dict[int, np.ndarray], dict[int, np.ndarray]]:
        """Bins and held-out sums of a fit's vectors; by number of trees, predictions (vectors, sizes, depths) and notes (sizes, numbers)."""
        lines = table.filter(pc.is_valid(table.column("hn")))
        noted = dict(zip(*(table.filter(pc.is_null(table.column("hn"))).column(c).to_pylist() for c in ("part", "notes"))))
        of = lines.column("part").to_numpy()
        total, note, by_number, notes_by_number = 0.0, 0.0, {}, {}
        for part, (pieces, _) in enumerate(planned):
            own = lines.filter(pa.array(of == part))
            x, held, order = in_order(own, n_features, "hn", "hs", "hq")
            sums = matrix(own.column("sums"))[order].reshape(len(x), len(all_sizes), len(pieces), len(all_depths))
            said = np.array(noted[part]).reshape(len(all_sizes), len(pieces), -1)
            for i, number in enumerate(pieces):   # the last piece of a forest completes it
                total, note = total + sums[:, :, i], note + said[:, i]
                by_number[number], notes_by_number[number] = total / number, note
        return x, held, by_number, notes_by_number

    def search(key, table):
        _, (hn, hs, hq), by_number, _ = forests(table)
        sst = hq.sum() - hs.sum() ** 2 / hn.sum() if hn.sum() else 0.0
        r2 = []
        for number, (s, d) in zip(trees, at):
            v = by_number[number][:, s, d]
            r2.append(float(1.0 - (hq - 2 * v * hs + v * v * hn).sum() / sst) if sst > 0 else float("nan"))
        return pa.table({"outer": pa.array(np.full(len(r2), key[0].as_py(), np.int32)), "candidate": pa.array(range(len(r2)), pa.int32()), "r2": pa.array(r2, pa.float64())})

    scored = made.where("inner >= 0").groupBy(*FIT).applyInArrow(search, "outer int, candidate int, r2 double")
    means = {(r["outer"], r["candidate"]): r["mean"] for r in scored.groupBy("outer", "candidate").agg(F.avg("r2").alias("mean")).collect()}
    average = {o: [means.get((o, i), float("nan")) for i in range(len(cands))] for o in folds}
    best = {o: int(np.argmax(average[o])) for o in folds}
    shared = time.perf_counter() - t0

    def refit(key, table):
        outer = int(key[0].as_py())
        number, (s, d) = trees[best[outer]], at[best[outer]]
        x, _, by_number, notes = forests(table)
        note = notes[number][s]
        importances = note[:-1].reshape(len(all_depths), n_features)[d]
        importances = importances / importances.sum() if importances.sum() else importances
        m = len(x)
        return pa.table({"outer": pa.array(np.full(m + 1, outer, np.int32)), **{b: and_null(x[:, i], pa.int32()) for i, b in enumerate(bins)},
                         "prediction": and_null(by_number[number][:, s, d], pa.float64()),
                         "importances": pa.concat_arrays([pa.nulls(m, pa.list_(pa.float64())), lists(importances[None, :])]),
                         "seconds": pa.concat_arrays([pa.nulls(m, pa.float64()), pa.array([float(note[-1])])])})

    fitted = made.where("inner = -1").groupBy("outer").applyInArrow(
        refit, "outer int, " + ", ".join(f"{b} int" for b in bins) + ", prediction double, importances array<double>, seconds double").checkpoint()
    notes = {r["outer"]: r for r in fitted.where("importances is not null").select("outer", "importances", "seconds").collect()}   # k rows
    answers = fitted.where("importances is null").select(F.col("outer").alias(fold), *bins, (F.col("prediction") + F.lit(float(mean))).alias("prediction"))
    out = binned.join(brief(answers), [fold, *bins]).drop(*bins)
    return out, [{"fold": o, "avg_metrics": average[o], "best_idx": best[o], "best_params": dict(cands[best[o]]),
                  "importances": [float(v) for v in notes[o]["importances"]], "fit_seconds": shared / len(folds) + notes[o]["seconds"]} for o in folds]
