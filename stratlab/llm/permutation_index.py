"""Nearest neighbours by inner product from a permutation index (operator 11).

Every vector is described by the order of its nearest pivots. It is posted in the inverted
files (lists) of its first ``POSTS`` pivots; a query reads the lists of its own nearest pivots,
ranks what it finds by the footrule distance between the two orders, and computes exact inner
products for the front of that ranking. How many lists are read and how far the ranking is
followed is fitted on a bounded sample, for a wanted recall.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratlab.llm.common import Scratch, thin_by_hash

POSTS = 2
ORDER = 64
BLOCK = 4096
SAMPLE = 16_384
SAMPLE_QUERIES = 256
MOST_PIVOTS = 32_768
RESULT = "query_id bigint, rank int, vec_id bigint, score double"


def pivot_count(n: int) -> int:
    """Twice the root of the number of vectors: so many pivots are compared with every vector, and
    lists hold as many vectors on average. At most 32,768 (16 bits an entry; 16 MB at 64 dimensions)."""
    return max(1, min(n, MOST_PIVOTS, max(16, int(2 * math.sqrt(n)))))


class Pivots:
    """Pivots on one sphere: a further coordinate lifts each vector to the largest norm, so that the
    order of distances is that of inner products, whatever the norms are."""

    def __init__(self, pivots: np.ndarray, largest: float):
        self.largest = largest
        self.points = np.ascontiguousarray(self.lift(pivots).T)

    def lift(self, x: np.ndarray) -> np.ndarray:
        x = x / self.largest
        rest = np.sqrt(np.maximum(0.0, 1.0 - np.einsum("ij,ij->i", x, x)))
        return np.concatenate([x, rest[:, None]], axis=1)

    def orders(self, x: np.ndarray, depth: int, query: bool = False) -> np.ndarray:
        """The ``depth`` nearest pivots of each row, nearest first."""
        m = self.points.shape[1]
        depth = min(depth, m)
        out = np.empty((len(x), depth), np.uint16)
        step = max(1, 4_000_000 // m)
        for at in range(0, len(x), step):
            part = x[at:at + step]
            if query:
                near = part / self.largest @ self.points[:-1]
            else:
                near = self.lift(part) @ self.points
            if depth < m:
                first = np.argpartition(-near, depth - 1, axis=1)[:, :depth]
                by = np.argsort(-np.take_along_axis(near, first, 1), axis=1, kind="stable")
                out[at:at + step] = np.take_along_axis(first, by, 1)
            else:
                out[at:at + step] = np.argsort(-near, axis=1, kind="stable")
        return out


def positions(orders: np.ndarray, pivots: int) -> np.ndarray:
    """The place of each pivot (row) in each order (column); the length of the orders where it is absent."""
    n, depth = orders.shape
    place = np.full((pivots, n), depth, np.uint8)
    place[orders.T, np.arange(n)[None, :]] = np.arange(depth, dtype=np.uint8)[:, None]
    return place


def footrule(order: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Spearman's footrule between one order and each column of ``place``; absent pivots stand right
    behind the last place.

    Places of one order sum to the same whether a pivot is in the other or not, so the sum of
    |x - y| over the pivots is twice the sum of max(x, y) over those of one order, less a constant.
    """
    depth = len(order)
    at = place[order.astype(np.int64)]
    np.maximum(at, np.arange(depth, dtype=np.uint8)[:, None], out=at)
    return 2 * at.sum(axis=0, dtype=np.uint16).astype(np.int32) - depth * (depth - 1)


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column of equal lengths as doubles."""
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(n, -1) if n else flat.reshape(0, 0)


def uint16_rows(column: pa.Array) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), "<u2").reshape(len(rows), -1)


def fit_depths(sample: np.ndarray, pivots: Pivots, k: int, recall: float) -> tuple[int, int]:
    """Lists to read and the largest footrule to rerank, each so that the share ``recall`` of the true
    neighbours of sample queries within the sample is found. Neighbours in a sample are farther
    away than in the whole table, so both err towards reading more."""
    m = pivots.points.shape[1]
    depth = min(ORDER, m)
    queries = sample[-SAMPLE_QUERIES:]
    ranks, distances = [], []
    first = len(sample) - len(queries)
    for i, q in enumerate(queries):
        score = sample @ q
        score[first + i] = -np.inf
        k_ = min(k, len(sample) - 1)
        if not k_:
            continue
        near = np.argpartition(-score, k_ - 1)[:k_]
        order = pivots.orders(q[None, :], m, query=True)[0]
        rank = np.empty(m, np.int64)
        rank[order] = np.arange(m)
        theirs = pivots.orders(sample[near], depth)
        ranks.append(rank[theirs[:, :POSTS].astype(np.int64)].min(axis=1))
        distances.append(footrule(order[:depth], positions(theirs, m)))
    if not ranks:
        return m, depth * (depth + 1)
    return (int(np.quantile(np.concatenate(ranks), recall, method="higher")) + 1,
            int(np.quantile(np.concatenate(distances), recall, method="higher")))


def place_lists(sizes: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First block and number of blocks of each list: neighbouring lists share a block of about
    ``BLOCK`` vectors, a longer list is dealt over several."""
    first, parts = np.zeros(len(sizes), np.int64), np.ones(len(sizes), np.int64)
    block, held = 0, 0
    for p in np.argsort(groups, kind="stable"):
        n = int(sizes[p])
        if held and held + n > BLOCK:
            block, held = block + 1, 0
        if n > BLOCK:
            parts[p] = -(-n // BLOCK)
            first[p], block = block, block + int(parts[p])
        else:
            first[p] = block
            held += n
    return first, parts


def usable_vectors(vectors: DataFrame) -> DataFrame:
    """One vector a ``vec_id``, of those that take part, as (vec_id, v)."""
    kind = vectors.schema["embedding"].dataType
    if not isinstance(kind, T.ArrayType):
        raise ValueError(f"embedding must be an array, not {kind.simpleString()}")
    number = "double" if not isinstance(kind.elementType, T.FloatType) else "float"
    v = F.col("embedding").cast(f"array<{number}>")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), v.alias("v")).where(
        "vec_id is not null and v is not null")
    rows = rows.where(finite).where(F.exists("v", lambda x: x != 0))
    return rows.groupBy("vec_id").agg(F.min("v").alias("v"))


def search_neighbours(vectors: DataFrame, k: int = 20, query_step: int = 20, recall: float = 0.965) -> DataFrame:
    """The ``k`` nearest vectors found for every row whose vec_id is divisible by ``query_step``.

    Takes vec_id and ``embedding`` (array of numbers); nearness is the largest inner product in
    double precision, ties go to the smaller vec_id. Returns query_id, rank (from 1), vec_id, score;
    all candidates where there are fewer than ``k``. ``recall`` is asked of each of the two fitted depths
    on a sample of at most 16,384 vectors; the pivots are taken from that sample.

    Vectors that are null, zero, or hold a null or non-finite component, rows of null vec_id and
    vectors of another length than the commonest (ties: the longest) take no part. Repeated rows count
    once; of several vectors under one vec_id the smallest counts. Equal vectors under several ids are
    indexed once, with their ``k`` + 1 smallest ids: no further one can be among the ``k`` nearest. An empty table
    gives no row. Other columns are not read.

    Scale: every vector is compared with ``pivot_count`` pivots and shuffled at most four times; lists are gathered in
    blocks of some 4,096 vectors, queries of a block in groups of as many, so that a hot list or a crowd
    of equal queries is dealt over many tasks. The driver sees the sample and one count a pivot.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "permutation")
    one = scratch.write(usable_vectors(vectors), "vectors")
    length = one.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1).collect()
    if not length:
        return spark.createDataFrame([], RESULT)
    one = one.where(F.size("v") == length[0]["n"])
    order = Window.partitionBy("v").orderBy("vec_id")
    same = one.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k + 1)
    classes = scratch.write(same.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "classes")
    n, largest = classes.agg(F.count("*"), F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") ** 2))).first()
    hashed = thin_by_hash(classes.select(F.xxhash64(F.col("ids")[0]).alias("h"), "v"), "h", n, SAMPLE)
    sample = np.array([r["v"] for r in hashed.orderBy("h").limit(SAMPLE).collect()], dtype=np.float64)
    m = min(pivot_count(n), len(sample))
    pivots = Pivots(sample[:m], math.sqrt(largest))
    lists, limit = fit_depths(sample, pivots, k, recall)
    return read_lists(scratch, one.where(F.col("vec_id") % query_step == 0), classes, pivots, lists, limit, k, sample[:m], sample[:n // 4])


def read_lists(scratch: Scratch, queries: DataFrame, classes: DataFrame, pivots: Pivots, lists: int, limit: int,
               k: int, points: np.ndarray, some: np.ndarray) -> DataFrame:
    """Index ``classes``, read ``lists`` lists for each of ``queries``, rerank up to the footrule ``limit``, and in a
    block at least four times as many as are wanted.

    The score of the k-th best of ``some`` vectors bounds that of the k-th best of all from below, so a block returns
    only what reaches it. Queries left with fewer than ``k`` are read again without that bound."""
    m = len(points)
    depth, posts = min(ORDER, m), min(POSTS, m)
    kind = classes.schema["v"].dataType.simpleString()

    def index(batches):
        for batch in batches:
            if batch.num_rows:
                found = pivots.orders(matrix(batch.column(0)), depth).astype("<u2")
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array([r.tobytes() for r in found], pa.binary())], names=["v", "ids", "pivots"])

    indexed = scratch.write(classes.select("v", "ids").mapInArrow(index, f"v {kind}, ids array<bigint>, pivots binary"), "index")

    def count(batches):
        total = np.zeros(m, np.int64)
        for batch in batches:
            if batch.num_rows:
                total += np.bincount(uint16_rows(batch.column(0))[:, :posts].ravel(), minlength=m)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(total[held], pa.int64())], names=["pivot", "n"])

    sizes = np.zeros(m, np.int64)
    for r in indexed.select("pivots").mapInArrow(count, "pivot bigint, n bigint").groupBy("pivot").agg(F.sum("n").alias("n")).collect():
        sizes[r["pivot"]] = r["n"]
    heads = Pivots(points[:max(1, int(sizes.sum() // BLOCK))], pivots.largest)
    first, parts = place_lists(sizes, heads.orders(points, 1)[:, 0])
    enough, least = posts * (k + 1), 4 * (k + 1)

    def homes(ids: np.ndarray, mine: np.ndarray) -> np.ndarray:
        """The block that holds each posting of each vector."""
        mine = mine[:, :posts].astype(np.int64)
        return first[mine] + (ids[:, None] * 2654435761 % 4294967291) % parts[mine]

    def post(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            at = homes(first_ids(batch.column(1)), uint16_rows(batch.column(2)))
            new = np.ones(at.shape, bool)
            for j in range(1, posts):
                new[:, j] = (at[:, :j] != at[:, j:j + 1]).all(axis=1)
            rows, which = np.nonzero(new)
            yield pa.RecordBatch.from_arrays([pa.array(at[rows, which], pa.int64()), *(c.take(pa.array(rows)) for c in batch.columns)],
                                             names=["block", "v", "ids", "pivots"])

    def lower_bounds(q: np.ndarray) -> np.ndarray:
        if len(some) <= k:
            return np.full(len(q), -np.inf)
        out = np.empty(len(q))
        for at in range(0, len(q), 256):
            score = q[at:at + 256] @ some.T
            out[at:at + 256] = np.partition(score, len(some) - k - 1, axis=1)[:, len(some) - k - 1]
        return out - 1e-9 * pivots.largest * np.sqrt(np.einsum("ij,ij->i", q, q))

    def ask(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            orders = pivots.orders(matrix(batch.column(1)), m, query=True)
            held = np.cumsum(sizes[orders.astype(np.int64)], axis=1)
            rows, blocks, read = [], [], []
            bounds = lower_bounds(matrix(batch.column(1)))
            for i, order_ in enumerate(orders):
                n = min(m, max(lists, depth, int(np.searchsorted(held[i], enough)) + 1))
                own = order_[:n].astype(np.int64)
                to = np.unique(np.concatenate([first[own]] + [first[p] + np.arange(1, parts[p]) for p in own if parts[p] > 1]))
                rows += [i] * len(to)
                blocks.append(to)
                read += [order_[:n].astype("<u2").tobytes()] * len(to)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(blocks), pa.int64()),
                                              *(c.take(pa.array(rows, pa.int64())) for c in batch.columns), pa.array(read, pa.binary()),
                                              pa.array(bounds[np.array(rows, np.int64)], pa.float64())],
                                             names=["block", "query_id", "v", "pivots", "bound"])

    def rank(key, left, right):
        block = key[0].as_py()
        ids = right.column("ids").combine_chunks() if right.num_rows else None
        vectors = matrix(right.column("v").combine_chunks())
        theirs = uint16_rows(right.column("pivots"))
        head = first_ids(ids)
        own_list = np.ascontiguousarray((homes(head, theirs) == block).T)
        posted = np.ascontiguousarray(theirs[:, :posts].T.astype(np.int64))
        ids = ids.to_pylist()
        found: list[tuple[int, int, float]] = []
        asked = list(zip(left.column("query_id").to_pylist(), matrix(left.column("v").combine_chunks()),
                         left.column("pivots").to_pylist(), left.column("bound").to_pylist()))
        best: list[list[tuple[float, int]]] = [[] for _ in asked]
        step = max(1, 16_000_000 // m)
        for at in range(0, len(head), step):
            place = positions(theirs[at:at + step], m)
            for i, (query, q, read, bound) in enumerate(asked):
                order_ = np.frombuffer(read, "<u2")
                reads = np.zeros(m, bool)
                reads[order_] = True
                mine, before = np.zeros(place.shape[1], bool), np.zeros(place.shape[1], bool)
                for j in range(posts):  # a pair counts in the first list of the vector that the query reads
                    hit = reads[posted[j, at:at + step]]
                    mine |= hit & ~before & own_list[j, at:at + step]
                    before |= hit
                mine = np.flatnonzero(mine)
                if not len(mine):
                    continue
                distance = footrule(order_[:depth], place)[mine]
                near = mine[distance <= limit]
                if len(near) < least:
                    near = mine[np.argsort(distance, kind="stable")[:least]]
                near = near + at
                score = np.einsum("ij,j->i", vectors[near], q)
                high = score >= bound
                near, score = near[high], score[high]
                top = np.lexsort((head[near], -score))[:k + 1]
                rows = best[i] + [(-s, d) for s, t in zip(score[top].tolist(), near[top].tolist()) for d in ids[t] if d != query]
                rows.sort()
                best[i] = rows[:k]
        for (query, *_), rows in zip(asked, best):
            found += [(query, d, -s) for s, d in rows]
        return pa.table({"query_id": pa.array([r[0] for r in found], pa.int64()), "vec_id": pa.array([r[1] for r in found], pa.int64()),
                         "score": pa.array([r[2] for r in found], pa.float64())})

    asks = scratch.write(queries.select(F.col("vec_id").alias("query_id"), "v")
                         .mapInArrow(ask, f"block bigint, query_id bigint, v {kind}, pivots binary, bound double"), "asks")
    posted = indexed.mapInArrow(post, f"block bigint, v {kind}, ids array<bigint>, pivots binary")

    def answer(asked: DataFrame) -> DataFrame:
        crowd = asked.groupBy("block").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("groups"))
        left = asked.join(crowd, "block").withColumn("part", F.pmod(F.xxhash64("query_id"), F.col("groups")).cast("int")).drop("groups")
        right = posted.join(crowd, "block").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("groups") - 1))).drop("groups")
        found = left.groupBy("block", "part").cogroup(right.groupBy("block", "part")).applyInArrow(
            rank, "query_id bigint, vec_id bigint, score double")
        by = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        ranked = found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)
        return scratch.write(ranked.select("query_id", "rank", "vec_id", "score"), "found")

    found = answer(asks)
    full = found.where(F.col("rank") == k).select("query_id")
    short = asks.where("bound > double('-infinity')").join(full, "query_id", "left_anti")
    if short.isEmpty():
        return found
    again = answer(short.withColumn("bound", F.lit(float("-inf"))))
    return found.join(again.select("query_id").distinct(), "query_id", "left_anti").unionByName(again)


def first_ids(ids: pa.Array) -> np.ndarray:
    """The smallest id of each class."""
    at = ids.offsets.to_numpy()[:-1]
    return ids.values.to_numpy(zero_copy_only=False)[at]
