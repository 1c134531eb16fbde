"""Toxicity by subword-bag embeddings averaged into a linear softmax (operator 4).

A word is the bag of its character n-grams (and itself); n-grams share hashed
embeddings, so a misspelling never seen still shares most of its vectors with the
word meant. Embeddings and softmax are trained jointly in numpy. A text is scored by
windows of a few words, as one insult in a long text would vanish in the mean of the
whole; the most toxic window speaks for the text, in training as in scoring.
"""

from __future__ import annotations

import re
import uuid
import zlib
from array import array
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratlab.llm.common import SLICE_ROWS, thin_by_hash, worker_cache

WORD = re.compile(r"\w+")
BUCKETS = 1 << 17
DIM = 8
WINDOW = 6
NGRAMS = (3, 4, 5)
#: Bounds of the training sample: documents of each class, code points of one (longer texts are cut) and of all of a class.
MAX_PER_CLASS = 1_500
MAX_TRAIN_CHARS = 50_000
MAX_CLASS_CHARS = 12_000_000
EPOCHS = 60
#: Words, or places of words, that training takes at once: the driver holds no wide copies of all.
TRAIN_SLICE = 1 << 14


def subwords(word: str) -> list[int]:
    """Buckets of a word's character n-grams, with marks for its ends, and of the word itself."""
    marked = f"<{word}>"
    grams = [marked[i:i + n] for n in NGRAMS for i in range(len(marked) - n + 1)]
    return [zlib.crc32(g.encode("utf-8")) % BUCKETS for g in (*grams, marked)]


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def sum_at(at: np.ndarray, values: np.ndarray, of: np.ndarray, size: int) -> np.ndarray:
    """The sums of ``values[of]`` by ``at``, a slice at a time (numpy would make whole copies with wider numbers)."""
    out = np.zeros(size)
    for k in range(0, len(at), TRAIN_SLICE):
        np.add.at(out, at[k:k + TRAIN_SLICE].astype(np.intp), values[of[k:k + TRAIN_SLICE]].astype(np.float64))
    return out


class Bags:
    """Training texts as numbers: distinct words as bags of buckets, windows as lists of words."""

    def log_odds(self, y: np.ndarray) -> np.ndarray:
        """Log odds of each bucket in toxic against other texts, each word counted once a text, smoothed."""
        counts = np.zeros((2, len(self.sizes)))
        for k, (at, end) in enumerate(zip(self.ends, self.ends[1:])):
            counts[int(y[k] != 1), np.unique(self.flat[at:end])] += 1
        rates = []
        for c in counts:
            n = self.by_bucket(c) + SMOOTH
            rates.append(np.log(n / n.sum()))
        return rates[0] - rates[1]

    def word_slices(self):
        """(words, their buckets), a slice at a time."""
        for at in range(0, len(self.sizes), TRAIN_SLICE):
            words = slice(at, at + TRAIN_SLICE)
            first = self.starts[at]
            last = self.starts[at + TRAIN_SLICE] if at + TRAIN_SLICE < len(self.starts) else len(self.buckets)
            yield words, self.buckets[first:last]

    def by_bucket(self, of_word: np.ndarray) -> np.ndarray:
        """The sum of what the words of each bucket have."""
        out = np.zeros(BUCKETS)
        for words, buckets in self.word_slices():
            np.add.at(out, buckets.astype(np.intp), np.repeat(of_word[words], self.sizes[words].astype(np.intp)))
        return out

    def of_words(self, gain: np.ndarray) -> np.ndarray:
        """The mean of the buckets of each word."""
        parts = [np.add.reduceat(gain[buckets], self.starts[words] - self.starts[words.start]) for words, buckets in self.word_slices()]
        return np.concatenate(parts) / self.sizes if parts else np.zeros(0)

    def __init__(self, texts: list[str]):
        known: dict[str, int] = {}
        buckets, sizes = array("i"), array("i")
        flat, window, owner, windows = [], [], [], 0
        for d, text in enumerate(texts):
            ids = array("i")
            for w in words_of(text):
                k = known.setdefault(w, len(known))
                if k == len(sizes):
                    bag = subwords(w)
                    buckets.extend(bag)
                    sizes.append(len(bag))
                ids.append(k)
            n = max(1, -(-len(ids) // WINDOW))
            flat.append(np.frombuffer(ids, np.int32) if ids else np.zeros(0, np.int32))
            window.append(windows + np.arange(len(ids), dtype=np.int32) // WINDOW)
            owner.append(np.full(n, d, np.int32))
            windows += n
        self.sizes = np.array(sizes, dtype=np.float32)
        self.starts = np.cumsum([0, *sizes])[:-1]
        self.buckets = np.array(buckets, dtype=np.int32)
        self.ends = np.cumsum([0, *map(len, flat)])
        none = [np.zeros(0, np.int32)]
        self.flat, self.window, self.owner = np.concatenate(flat or none), np.concatenate(window or none), np.concatenate(owner or none)
        self.windows, self.texts = windows, len(texts)


def train(texts: list[str], labels: list[int], epochs: int = EPOCHS, seed: int = 7) -> tuple[np.ndarray, float]:
    """Embeddings and softmax trained jointly, from a start where each bucket has its log odds; returns the share of each bucket in the
    log odds (its embedding times the difference of the softmax weights) and the bias.

    A toxic text gives its most toxic windows (all at first, in the end one), another text all of its
    windows and once more its most toxic. Steps go over the whole sample.
    """
    y = np.array(labels)
    b = Bags(texts)
    rng = np.random.default_rng(seed)
    out = rng.normal(0, 0.5, (DIM, 2))
    diff = out[:, 1] - out[:, 0]
    start = np.outer(b.log_odds(y), diff / (diff @ diff)) + rng.normal(0, 0.01, (BUCKETS, DIM))
    params = [start.astype(np.float32), out.astype(np.float32), np.array([1.0, -1.0], np.float32)]
    moments = [{"m": np.zeros_like(p), "v": 0.0} for p in params]
    positive = y[b.owner] == 1
    per_text = np.bincount(b.owner, minlength=b.texts)
    first = np.concatenate([[0], np.cumsum(per_text)[:-1]])
    for epoch in range(1, epochs + 1):
        emb, out, bias = params
        diff = out[:, 1] - out[:, 0]
        gain = emb @ diff
        logit = sum_at(b.window, b.of_words(gain), b.flat, b.windows) / WINDOW * SCALE + bias[1] - bias[0]
        prob = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        order = np.lexsort((-logit, b.owner))
        rank = np.empty(b.windows, np.int64)
        rank[order] = np.arange(b.windows) - np.repeat(first, per_text)
        share = max(0.0, 0.3 - epoch / epochs)
        chosen = np.maximum(1, np.ceil(share * per_text))[b.owner]
        weight = np.where(positive, (rank < chosen) / chosen, 0.5 / per_text[b.owner] + 0.5 * (rank == 0))
        weight /= np.where(positive, max(1, (y == 1).sum()), max(1, (y == 0).sum()))
        error = weight * (prob - positive)
        by_word = sum_at(b.flat, error, b.window, len(b.sizes)) / WINDOW * SCALE / b.sizes
        by_bucket = b.by_bucket(by_word).astype(np.float32)
        side = (by_bucket @ emb).astype(np.float32)
        total = np.float32(error.sum())
        grads = [np.outer(by_bucket, diff), np.stack([-side, side], axis=1), np.array([-total, total], np.float32)]
        for p, g, moment in zip(params, grads, moments):
            # one step size a tensor: what many texts share moves far, what one text has alone hardly
            moment["m"] += 0.1 * (g - moment["m"])
            moment["v"] += 0.05 * (float((g * g).sum()) - moment["v"])
            scale = RATE * (1.05 - epoch / epochs) * np.sqrt(p.shape[-1]) / (np.sqrt(moment["v"] / (1 - 0.95 ** epoch)) + 1e-8) / (1 - 0.9 ** epoch)
            p -= np.float32(scale) * moment["m"]
    emb, out, bias = params
    return (emb @ (out[:, 1] - out[:, 0])).astype(np.float32), float(bias[1] - bias[0])


#: Length of a step, and a fixed factor on the mean of a window, so that one word of a window can decide.
RATE = 0.4
SMOOTH = 3.0
SCALE = 6.0


class Scorer:
    """Scores texts; the share of each word is remembered (bounded)."""

    def __init__(self, gain: np.ndarray, bias: float, limit: int = 200_000):
        self.gain, self.bias, self.limit = gain, bias, limit
        self.known: dict[str, float] = {}

    def share(self, word: str) -> float:
        return float(self.gain[subwords(word)].mean())

    def score(self, text: str | None) -> float:
        words = words_of(text)
        known = self.known
        if len(known) > self.limit:
            known.clear()
        for w in set(words).difference(known):
            known[w] = self.share(w)
        n = -(-len(words) // WINDOW) * WINDOW or WINDOW
        shares = np.zeros(n)
        shares[:len(words)] = [known[w] for w in words]
        logit = shares.reshape(-1, WINDOW).sum(axis=1).max() / WINDOW * SCALE + self.bias
        return float(1 / (1 + np.exp(-np.clip(logit, -30, 30))))


def training_sample(docs: DataFrame, labels: DataFrame, max_per_class: int = MAX_PER_CLASS) -> tuple[list[str], list[int]]:
    """At most ``max_per_class`` texts of each class, chosen by a hash of the id among the labelled documents that
    have a text, the first 50,000 code points of each; of a class some 12 million code points at most, in that order.

    Rows held out (crc32 of the id as text divisible by 5) are never taken. A document labelled twice
    counts as toxic if one label says so.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").where("text is not null")
    usable = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")) \
        .where("doc_id is not null and toxic is not null and crc32(cast(doc_id as string)) % 5 <> 0") \
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    usable = usable.join(rows.select("doc_id"), "doc_id", "left_semi").withColumn("h", F.xxhash64("doc_id"))
    sizes = {r["toxic"]: r["n"] for r in usable.groupBy("toxic").agg(F.count("*").alias("n")).where("toxic in (0, 1)").collect()}
    picked = [thin_by_hash(usable.where(F.col("toxic") == k), "h", sizes.get(k, 0), max_per_class)
              .orderBy("h", "doc_id").limit(max_per_class).select("doc_id", "toxic", "h") for k in (0, 1)]
    found = rows.join(F.broadcast(picked[0].unionByName(picked[1])), "doc_id") \
        .groupBy("doc_id", "toxic", "h").agg(F.min(F.substring("text", 1, MAX_TRAIN_CHARS)).alias("text")).collect()
    held, texts = Counter(), []
    for r in sorted(found, key=lambda r: (r["h"], r["doc_id"])):
        held[r["toxic"]] += len(r["text"])
        if held[r["toxic"]] <= MAX_CLASS_CHARS:
            texts.append((r["doc_id"], r["text"], r["toxic"]))
    texts.sort()
    return [t for _, t, _ in texts], [y for _, _, y in texts]


def score_toxicity(docs: DataFrame, labels: DataFrame, max_per_class: int = MAX_PER_CLASS,
                   carry: tuple[str, ...] = ()) -> DataFrame:
    """Train on a bounded labelled sample, then score every whole text; one row per input row: doc_id,
    the columns of ``carry``, score.

    ``labels`` has doc_id, toxic (0 or 1); only ``text`` goes into a score. Without labels of both classes
    every score is the share of toxic labels (0 without any). Null text: as empty, which
    gets the score of a window without words. Null doc_id: kept null. Repeated rows: one row each.
    Other columns are not read. Scoring shuffles nothing; the model (131,072 numbers) is
    sent to the executors.
    """
    texts, y = training_sample(docs, labels, max_per_class)
    spark = docs.sparkSession
    if len(set(y)) == 2:
        made = train(texts, y)
        texts = []
        model = spark.sparkContext.broadcast(made)
    else:
        model = None
    model_key = uuid.uuid4().hex
    base = float(np.mean(y)) if y else 0.0

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), *[c for c in carry if c not in ("doc_id", "text")],
                       F.col("text").alias("text"))
    keeps_text = "text" in carry

    def run(batches):
        scorer = worker_cache(f"toxicity:{model_key}", "scorer", lambda: Scorer(*model.value)) if model else None
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                scores = [scorer.score(t) if scorer else base for t in part.column(part.num_columns - 1).to_pylist()]
                kept = part.columns if keeps_text else part.columns[:-1]
                names = part.schema.names if keeps_text else part.schema.names[:-1]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(scores, pa.float64())], names=[*names, "score"])

    fields = rows.schema.fields if keeps_text else rows.schema.fields[:-1]
    return rows.mapInArrow(run, T.StructType([*fields, T.StructField("score", T.DoubleType())]))
