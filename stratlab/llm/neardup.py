"""Near copies by ProbMinHash over weighted word shingles (operator 3).

The shingles of a text arrive as Poisson processes, each with its weight as rate;
every arrival falls on one of the registers at random, and a register keeps the
shingle that arrives first. Two texts agree in a register with the probability Jaccard
similarity of their weights. A shingle is followed only until its arrivals come later
than everything that the registers hold. Bands of registers give candidates, which
are verified exactly on the whole texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratlab.llm.common import SLICE_ROWS, Scratch, worker_cache
from stratlab.llm.components import components
from stratlab.llm.shingles import MULTIPLY, WordHashes, mix, probability_jaccard, shingle_hashes, weighted, words_of

SIMILARITY = 0.8
BANDS = 32
#: Registers of a band. At similarity 0.8 a pair shares one of 32 bands with probability 0.99994.
ROWS = 6
#: Bits of the sketch that bounds how many shingles two texts do not share.
ODD_BITS = 2_048
#: So many times as many centres a bucket in each round.
MORE_CENTRES = 32


def registers(sets: list[tuple[np.ndarray, np.ndarray]], m: int) -> np.ndarray:
    """ProbMinHash signatures (one row a weighted set, ``m`` registers); zeros for an empty set."""
    owner = np.repeat(np.arange(len(sets)), [len(k) for k, _ in sets])
    keys = np.concatenate([k for k, _ in sets]) if sets else np.zeros(0, np.uint64)
    rate = np.concatenate([w for _, w in sets]).astype(np.float64) if sets else np.zeros(0)
    first = np.full(len(sets) * m, np.inf)
    held = np.zeros(len(sets) * m, np.uint64)
    state, time = mix(keys + MULTIPLY), np.zeros(len(keys))
    while len(keys):
        state = state + MULTIPLY
        draw = mix(state)
        time = time - np.log(((draw >> np.uint64(11)).astype(np.float64) + 1) / 2.0 ** 53) / rate
        at = owner * m + (mix(draw) % np.uint64(m)).astype(np.int64)
        early = np.flatnonzero(time < first[at])
        np.minimum.at(first, at[early], time[early])
        won = early[time[early] == first[at[early]]]
        held[at[won]] = keys[won]
        latest = first.reshape(-1, m).max(axis=1)
        alive = time < latest[owner]
        owner, keys, rate, state, time = owner[alive], keys[alive], rate[alive], state[alive], time[alive]
    return held.reshape(-1, m)


def band_hashes(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    acc = np.tile(np.arange(1, bands + 1, dtype=np.uint64), (len(signatures), 1))
    parts = signatures.reshape(len(signatures), bands, rows)
    for k in range(rows):
        acc = mix(acc * MULTIPLY + parts[:, :, k])
    return acc.view(np.int64)


def sketches(signatures: np.ndarray) -> np.ndarray:
    """Four bits of every register, sixteen registers to a 64-bit number."""
    bits = (mix(signatures) & np.uint64(15)).reshape(len(signatures), -1, 16)
    return (bits << (np.arange(16, dtype=np.uint64) * np.uint64(4))).sum(axis=2, dtype=np.uint64).view(np.int64)


def agreement(a: str, b: str, numbers: int) -> Column:
    """How many registers of two sketches agree, by the bits of their numbers."""
    out = F.lit(16 * numbers)
    for i in range(numbers):
        x = F.col(a)[i].bitwiseXOR(F.col(b)[i])
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        out = out - F.bit_count(x.bitwiseAND(F.lit(0x1111111111111111)))
    return out


def least_agreement(similarity: float, registers_: int) -> float:
    """Agreeing registers that a pair of this similarity has fewer of but once in some millions (five standard
    deviations). Four bits of two different registers agree by chance once in sixteen."""
    p = similarity + (1 - similarity) / 16
    return registers_ * p - 5 * (registers_ * p * (1 - p)) ** 0.5


def text_key() -> Column:
    return F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary")))


def sign(docs: DataFrame, bands: int, rows: int) -> DataFrame:
    """(key, doc_id, bands, sketch) per row; ``bands`` is empty for a text without words."""
    def run(batches):
        hashes = worker_cache("near_duplicates", "word_hashes", WordHashes)
        for batch in batches:
            texts = batch.column(2).to_pylist()
            at = 0
            while at < len(texts):
                sets, size, start = [], 0, at
                while at < len(texts) and size < 400_000 and len(sets) < 2_000:
                    sets.append(weighted(shingle_hashes(hashes.of(words_of(texts[at])))))
                    size += len(sets[-1][0])
                    at += 1
                signatures = registers(sets, bands * rows)
                made, small = band_hashes(signatures, bands, rows), sketches(signatures)
                filled = np.array([len(k) > 0 for k, _ in sets])
                offsets = np.concatenate([[0], np.cumsum(filled * bands)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(made[filled].ravel()))
                part = batch.slice(start, at - start)
                width = small.shape[1]
                brief = pa.ListArray.from_arrays(pa.array(np.arange(len(small) + 1, dtype=np.int32) * width), pa.array(small.ravel()))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), lists, brief], names=["key", "doc_id", "bands", "sketch"])

    rows_ = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows_.select(text_key().alias("key"), "doc_id", "text").mapInArrow(
        run, "key binary, doc_id bigint, bands array<bigint>, sketch array<bigint>")


def verify(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """(a, b), the components of those pairs (x, y, a, b) whose texts x, y have at least this probability Jaccard similarity, exactly."""
    left = texts.select(F.col("rid").alias("x"), F.col("text").alias("tx"))
    right = texts.select(F.col("rid").alias("y"), F.col("text").alias("ty"))

    def run(batches):
        hashes = worker_cache("near_duplicates", "word_hashes", WordHashes)
        known: dict[int, tuple] = {}   # shingles of the texts of this task, up to a bound
        held = 0

        def bag(rid, texts_, i):
            nonlocal held
            if rid not in known:
                if held > 2_000_000:
                    known.clear()
                    held = 0
                known[rid] = weighted(shingle_hashes(hashes.of(words_of(texts_[i].as_py()))))
                held += len(known[rid][0])
            return known[rid]

        for batch in batches:
            x, y = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            found = [probability_jaccard(bag(x[i], batch.column(4), i), bag(y[i], batch.column(5), i)) >= similarity
                     for i in range(batch.num_rows)]
            yield batch.select([0, 1]).filter(pa.array(found, pa.bool_()))

    # a centre y may have very many pairs: Spark splits that join, and the tasks of the last are those of x
    return pairs.join(right, "y").join(left, "x").select("a", "b", "x", "y", "tx", "ty").mapInArrow(run, "a bigint, b bigint")


def rare_prefixes(texts: DataFrame, similarity: float) -> DataFrame:
    """(rid, prefix): the rarest shingles of each text, as far as they hold more than 1 - ``similarity`` of its weight.

    The probability Jaccard similarity is at most the sum of the smaller normalised weights, so two texts that reach it share shingles
    holding at least that much of either; the rarest shared one then stands in both prefixes. Rarity is counted over
    these texts, ties go by the shingle: one order for all.
    """
    def run(batches):
        hashes = worker_cache("near_duplicates", "word_hashes", WordHashes)
        for batch in batches:
            for rid, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                keys, weights = weighted(shingle_hashes(hashes.of(words_of(text))))
                for at in range(0, len(keys), 100_000):
                    part = slice(at, at + 100_000)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(keys[part]), rid), pa.int64()), pa.array(keys[part].view(np.int64)), pa.array(weights[part] / weights.sum())],
                        names=["rid", "s", "w"])

    shingles = texts.select("rid", "text").mapInArrow(run, "rid bigint, s bigint, w double")
    counted = shingles.join(shingles.groupBy("s").agg(F.count("*").alias("n")).withColumnRenamed("s", "t"), F.col("s") == F.col("t"))
    before = Window.partitionBy("rid").orderBy("n", "s").rowsBetween(Window.unboundedPreceding, -1)
    kept = counted.withColumn("held", F.coalesce(F.sum("w").over(before), F.lit(0.0))).where(F.col("held") <= 1 - similarity + 1e-9)
    return kept.groupBy("rid").agg(F.collect_list("s").alias("prefix"))


def odd_bits(keys: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Each occurrence of a shingle flips one of ``ODD_BITS`` bits, as 64-bit numbers. Two such sketches differ in at most as many bits
    as there are occurrences that only one of both texts has."""
    turn = np.arange(int(weights.sum())) - np.repeat(np.cumsum(weights) - weights, weights)
    at = mix(np.repeat(keys, weights) + MULTIPLY * (turn + 1).astype(np.uint64)) % np.uint64(ODD_BITS)
    odd = (np.bincount(at.astype(np.int64), minlength=ODD_BITS) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view("<u8").view(np.int64)


def odd_sketches(texts: DataFrame) -> DataFrame:
    """(rid, size, plain, odd): the shingles of each text, whether each occurs once, and their odd bits."""
    def run(batches):
        hashes = worker_cache("near_duplicates", "word_hashes", WordHashes)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                bags = [weighted(shingle_hashes(hashes.of(words_of(t)))) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([int(w.sum()) for _, w in bags], pa.int64()), pa.array([bool((w == 1).all()) for _, w in bags], pa.bool_()),
                     pa.array([odd_bits(*b) for b in bags], pa.list_(pa.int64()))], names=["rid", "size", "plain", "odd"])

    return texts.select("rid", "text").mapInArrow(run, "rid bigint, size bigint, plain boolean, odd array<bigint>")


def few_differences(a: str, b: str, similarity: float) -> Column:
    """Whether two odd sketches differ in no more bits than texts of this similarity can: an exact test.

    Where every shingle occurs once the similarity s is the Jaccard similarity, so of N and M shingles (1 - s) / (1 + s) (N + M) are
    not shared at most. Else the smaller normalised weights add up to s at least, so N + M - 2 s min(N, M) are not.
    """
    n, m = F.col(f"{a}.size"), F.col(f"{b}.size")
    most = F.when(F.col(f"{a}.plain") & F.col(f"{b}.plain"), (n + m) * ((1 - similarity) / (1 + similarity))) \
        .otherwise(n + m - 2 * similarity * F.least(n, m))
    bits = F.zip_with(f"{a}.odd", f"{b}.odd", lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.aggregate(bits, F.lit(0), lambda total, k: total + k) <= most + 1e-6


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Classes of equal and near-equal texts; one row per input row: doc_id, text_key
    (MD5 of the text), class_id, class_size, text_rank.

    Near copies: probability Jaccard similarity of 0.8 or more of shingles of five words (lower
    case, split at white space), weighted by how often they occur. Classes are the connected
    components of the pairs that share a band and pass the exact check. ``class_id`` is the smallest doc_id of the
    class (null if it has none), ``class_size`` its rows, ``text_rank`` 1 for one row of the class (smallest id, then smallest text key; equal
    rows share it). Null text: as empty. Texts without words are equal only to themselves (copies of the same text). Null doc_id: the row takes part.
    Other columns are not read. An empty table gives no row.

    Equal texts become one node first. In a bucket of a band, centres are compared with the members
    that are not yet in their component: at first one centre a bucket, then 32 times as many each round, until each bucket is
    one component or all of its members have been centres. So a large group of near copies costs as many comparisons
    as it has members. No pair is skipped but those already connected, and those whose sketches (four bits of each register)
    agree five standard deviations less than 0.8 would have it, or which after the first round share none of their rarest shingles or have
    too many that they do not share (exact tests, see ``rare_prefixes`` and ``few_differences``; the second rejects little where texts have many
    more shingles than ``ODD_BITS``): these tests are conditions of the join, so such pairs make no rows.
    """
    scratch = Scratch(docs.sparkSession, "near-duplicates")
    if bands * rows % 16:
        raise ValueError("bands times rows must be a multiple of 16")
    signed = scratch.write(sign(docs, bands, rows), "signatures")
    # equal texts are one node before their text is looked up
    nodes = scratch.write(signed.groupBy("key").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("copies"), F.any_value("bands").alias("bands"), F.any_value("sketch").alias("sketch"))
                          .withColumn("rid", F.monotonically_increasing_id()), "nodes")
    members = nodes.select(F.explode("bands").alias("band"), "rid")
    shared = members.groupBy("band").agg(F.count("*").alias("n")).where("n > 1").select("band")
    buckets = scratch.write(members.join(shared, "band"), "buckets")
    wanted = nodes.select("rid", "key").join(buckets.select("rid").distinct(), "rid", "left_semi")
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text")).groupBy(text_key().alias("key")).agg(F.any_value("text").alias("text"))
    texts = scratch.write(texts.join(wanted, "key").select("rid", "text"), "texts")

    brief = nodes.select("rid", "sketch")
    enough = agreement("m.sketch", "c.sketch", bands * rows // 16) >= least_agreement(similarity, bands * rows)
    labels, prefixes = None, None
    centres = 1
    while not buckets.isEmpty():
        if labels is None:  # each node is a component of its own, so no bucket is one
            open_ = buckets.withColumn("comp", F.col("rid")).join(brief, "rid")
        else:
            placed = buckets.join(labels.withColumnRenamed("node", "rid"), "rid", "left").withColumn("comp", F.coalesce("comp", "rid"))
            mixed = placed.groupBy("band").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("band")
            open_ = placed.join(mixed, "band").join(brief, "rid")
        may_be_near = enough
        if centres > 1:
            if prefixes is None:  # of the texts still open; later rounds have no others
                still = scratch.write(texts.join(buckets.select("rid").distinct(), "rid", "left_semi"), "still")
                prefixes = scratch.write(rare_prefixes(still, similarity).join(odd_sketches(still), "rid"), "prefixes")
                scratch.drop(still)
            open_ = open_.join(prefixes, "rid")
            may_be_near = enough & few_differences("m", "c", similarity) & F.arrays_overlap("m.prefix", "c.prefix")
        else:  # the first round has one centre a bucket
            none = F.array().cast("array<bigint>")
            open_ = open_.withColumns({"prefix": none, "size": F.lit(0).cast("bigint"), "plain": F.lit(True), "odd": none})
        own_bands = F.collect_list("band").over(Window.partitionBy("rid"))
        open_ = scratch.write(open_.withColumn("own", own_bands).withColumn("turn", F.xxhash64("rid")), "open")
        rank = F.row_number().over(Window.partitionBy("band").orderBy("turn", "rid"))
        chosen = open_.withColumn("rank", rank).where(F.col("rank") <= centres)
        chosen = scratch.write(chosen.withColumn("own", own_bands).repartition("band")
                               .select("band", "turn", "rid", "comp", "own", "sketch", "prefix", "size", "plain", "odd"), "centres")
        # a pair meets in the buckets where one is open and the other a centre; the first of them gives its row
        here = F.array_min(F.array_intersect("m.own", "c.own")) == F.col("m.band")
        pairs = open_.alias("m").join(chosen.alias("c"), (F.col("m.band") == F.col("c.band")) & (F.col("m.comp") != F.col("c.comp")) & may_be_near & here) \
            .select(F.col("m.rid").alias("x"), F.col("c.rid").alias("y"), F.col("m.comp").alias("a"), F.col("c.comp").alias("b"))
        links = scratch.write(verify(pairs, texts, similarity), "links")
        # the members after the last centre, where two at least are left
        last = chosen.groupBy("band").agg(F.max(F.struct("turn", "rid")).alias("last"), F.count("*").alias("taken"))
        left = last.join(open_.groupBy("band").agg(F.count("*").alias("n")), "band").where("n - taken > 1").select("band", "last")
        new_buckets = scratch.write_narrow(open_.join(left, "band").where(F.struct("turn", "rid") > F.col("last")).select("band", "rid"), "buckets")
        new_labels = labels
        if not links.isEmpty():
            found = components(links, scratch)
            if labels is not None:
                moved = labels.alias("l").join(found.alias("f"), F.col("l.comp") == F.col("f.node"), "left") \
                    .select("l.node", F.coalesce("f.comp", "l.comp").alias("comp"))
                found = moved.union(found.join(labels.select("node"), "node", "left_anti").select("node", "comp"))
            new_labels = scratch.write_narrow(found, "labels")
            scratch.drop(labels)
        for df in (buckets, open_, chosen, links):
            scratch.drop(df)
        buckets, labels = new_buckets, new_labels
        centres *= MORE_CENTRES
    scratch.drop(texts)
    classes = nodes.select("key", "rid", "first_id", "copies")
    classes = classes.withColumn("comp", F.col("rid")) if labels is None else \
        classes.join(labels.withColumnRenamed("node", "rid"), "rid", "left").withColumn("comp", F.coalesce("comp", "rid"))
    classes = scratch.write(classes, "classes")
    whole = classes.groupBy("comp").agg(
        F.min("first_id").alias("class_id"), F.sum("copies").alias("class_size"),
        F.min(F.struct(F.col("first_id").isNull(), "first_id", "key")).alias("best"))
    tied = classes.join(whole, "comp").select("key", "class_id", "class_size", (F.col("best.key") == F.col("key")).alias("is_best"), "first_id")
    return signed.select("key", "doc_id").join(tied, "key").select(
        "doc_id", F.col("key").alias("text_key"), "class_id", "class_size",
        F.when(F.col("is_best") & F.col("doc_id").eqNullSafe(F.col("first_id")), 1).otherwise(2).alias("text_rank"))
