"""Quality by an interpolated modified Kneser-Ney model of trusted text (operator 1).

The model is over characters, up to five in a row, within a word (with marks for its ends) or across the spaces between
words (``across_words``), where the order of the words counts as well: such n-grams stay few even for words never met
before, in any language. Counts come from the whole of the trusted
text. Everything about n-grams is a table, joined and aggregated by n-gram: adjusted counts, contexts,
discounts and, from the shortest order up, interpolated probabilities. Documents are dealt to
blocks; a block asks for the probabilities of its distinct n-grams and scores its texts with them.
"""

from __future__ import annotations

import functools
import itertools
import sys
import zlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratlab.llm.common import Scratch, free_worker_cache

ORDER = 5
PAD, BEGIN, END = "\x00", "\x02", "\x03"
LEAD = PAD * (ORDER - 2) + BEGIN
#: Bits of a character in the number of an n-gram, characters counted or scored at once, and n-grams of pieces counted together.
BITS = 12
PIECE = 1 << 18
MERGE = 1 << 19
BLOCK_BYTES = 24_000_000
#: Texts and their n-grams are shuffled for scoring in so many parts, one after the other, so that the disk holds one part.
PASSES = 2
#: N-grams turned into strings, or from strings, at once.
SLICE = 100_000
#: Texts that are Python strings at once.
TEXTS = 64
#: Bytes of an Arrow batch between the JVM and a worker; a batch of a whole block would take its size several times in either.
BATCH_BYTES = "2m"
#: A document is kept up to this quantile of the perplexities of the trusted documents in its language, each under the counts of the
#: fold that it is not in; a language with under ``LEAST_ROWS`` (five beyond the quantile) takes the quantile of all languages.
QUANTILE = 0.98
LEAST_ROWS = 250
QUANTILE_ACCURACY = 10_000


def grams_of(word: str) -> list[str]:
    """For each character of the word and its end, the n-gram that ends there."""
    return ends_of(BEGIN + clean(word) + END)


def clean(text: str) -> str:
    return text.replace(PAD, " ").replace(BEGIN, " ").replace(END, " ")


def ends_of(s: str) -> list[str]:
    return [s[max(0, i - ORDER + 1):i + 1] for i in range(1, len(s))]


def text_grams(text: str | None) -> list[str]:
    """For each character of the text, words parted by one space and with a space at the end, the n-gram that ends there."""
    words = (text or "").split()
    return ends_of(BEGIN + clean(" ".join(words)) + " ") if words else []


def stream(text: str | None, across: bool) -> str:
    """The text with marks, such that the n-grams are the runs of ORDER characters (without PAD) that end in neither PAD nor BEGIN."""
    words = (text or "").split()
    if across:
        return LEAD + clean(" ".join(words)) + " " if words else ""
    return "".join([LEAD + clean(w) + END for w in words])


class Coder:
    """The n-grams of streams as numbers, ``BITS`` bits a character; one alphabet of at most 2 ** BITS - 1 characters."""

    def __init__(self, points: np.ndarray):
        self.points = points  # sorted, PAD first
        self.ids = np.zeros(int(points[-1]) + 1, np.uint16)
        self.ids[points] = np.arange(len(points))

    def codes(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(where, code) of each n-gram in a run of code points."""
        ids = np.concatenate([np.zeros(ORDER - 1, np.uint64), self.ids[symbols].astype(np.uint64)])
        code = np.zeros(len(symbols), np.uint64)
        for k in range(ORDER):
            code = code << np.uint64(BITS) | ids[k:k + len(symbols)]
        where = np.flatnonzero((symbols != ord(PAD)) & (symbols != ord(BEGIN)))
        return where, code[where]

    def strings(self, codes: np.ndarray) -> list[str]:
        shifts = np.arange(ORDER - 1, -1, -1, dtype=np.uint64) * np.uint64(BITS)
        ids = (codes[:, None] >> shifts[None, :] & np.uint64((1 << BITS) - 1)).astype(np.int64)
        flat = self.points[ids[ids > 0]].astype("<u4").tobytes().decode("utf-32-le")
        ends = np.cumsum((ids > 0).sum(axis=1)).tolist()
        return [flat[i:j] for i, j in zip([0, *ends], ends)]

    def numbers(self, grams: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(index, code) of those n-grams whose characters are all in the alphabet."""
        parts = [(k, *self.numbers_of(grams.slice(k, SLICE))) for k in range(0, max(1, len(grams)), SLICE)]
        return np.concatenate([k + good for k, good, _ in parts]), np.concatenate([code for *_, code in parts])

    def numbers_of(self, grams: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        symbols = code_points("".join(grams.to_pylist()))
        size = np.asarray(pc.utf8_length(grams)).astype(np.int64)
        ids = np.minimum(np.searchsorted(self.points, symbols), len(self.points) - 1)
        known = self.points[ids] == symbols
        owner = np.repeat(np.arange(len(size)), size)
        place = np.repeat(np.cumsum(size), size) - 1 - np.arange(len(symbols))
        code = np.zeros(len(size), np.uint64)
        for k in range(ORDER):
            at = place == k
            code[owner[at]] |= ids[at].astype(np.uint64) << np.uint64(BITS * k)
        good = np.flatnonzero(np.bincount(owner[~known], minlength=len(size)) == 0)
        return good, code[good]


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), dtype="<u4")


def distinct(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct codes, in any order, and the place of each code among them; hashed, as sorting takes longer."""
    found = pa.array(codes, pa.uint64()).dictionary_encode()
    return found.dictionary.to_numpy(), found.indices.to_numpy()


def used_points(*symbols: np.ndarray) -> np.ndarray:
    """The distinct code points, sorted."""
    used = np.zeros(sys.maxunicode + 1, np.bool_)
    for part in symbols:
        used[part] = True
    return np.flatnonzero(used).astype("<u4")


class Parts(list):
    """Pieces as ((texts, how many symbols of each), symbols, context); the text of each symbol is written out when a piece is read."""

    def __iter__(self):
        for (texts, sizes), symbols, lead in super().__iter__():
            yield np.repeat(texts, sizes), symbols, lead


def texts_of(column: pa.ChunkedArray):
    """The texts of a column, few of them as Python strings at once."""
    for chunk in column.chunks:
        for at in range(0, len(chunk), TEXTS):
            yield from chunk.slice(at, TEXTS).to_pylist()


def pieces(texts: Iterable[str | None], across: bool):
    """(coder, [(text of each symbol, symbols, how many of them are context only)]): streams in pieces of bounded size, under one
    alphabet as long as it fits, else under several. A text longer than a piece is cut with the characters before the cut as context."""
    found = Parts()
    alphabet: np.ndarray = np.array([ord(PAD)], dtype="<u4")
    group: list[str] = []
    size, owners = 0, []
    last = object()
    for k, text in enumerate(itertools.chain(texts, [last])):
        s = stream(text, across) if text is not last else ""
        if group and (text is last or size + len(s) > PIECE):
            symbols = code_points("".join(group))
            starts = np.cumsum([0, *[len(g) for g in group]])
            step = PIECE
            at = 0
            while at < len(symbols):
                # the first ORDER - 1 symbols of a later piece are context only
                lead = min(at, ORDER - 1)
                part = symbols[at - lead:at + step]
                new = used_points(alphabet, part)
                if len(new) >= 1 << BITS:
                    if len(alphabet) > 1:
                        if found:
                            yield Coder(alphabet), found
                        found, alphabet = Parts(), np.array([ord(PAD)], dtype="<u4")
                    else:
                        step //= 2
                    continue
                alphabet = new
                narrow = part.astype(np.min_scalar_type(part.max()))  # all pieces of a block are held
                found.append(((np.array(owners), np.diff(np.clip(starts, at - lead, at + step))), narrow, lead))
                at += step
                step = PIECE
            group, owners, size = [], [], 0
        if s:
            group.append(s)
            owners.append(k)
            size += len(s)
    if found:
        yield Coder(alphabet), found


def with_block(docs: DataFrame, key: list[Column], blocks: int) -> DataFrame:
    return docs.withColumn("_block", F.pmod(F.xxhash64(*key), F.lit(blocks)).cast("int"))


def folds(doc_ids: list[int | None], trusted: set) -> np.ndarray:
    """0 or 1 for a trusted document, by a hash of its id, else -1."""
    return np.array([zlib.crc32(str(d).encode()) & 1 if d in trusted else -1 for d in doc_ids], dtype=np.int64)


def gather(docs: DataFrame, trusted: DataFrame, across: bool) -> DataFrame:
    """(block, gram, n0, n1): the distinct n-grams of each block and their counts in its trusted texts of either fold."""
    def counted(left: pa.Table, ids: set):
        """(coder, codes, counts by fold) of each alphabet."""
        fold = folds(left.column("doc_id").to_pylist(), ids)
        for coder, parts in pieces(texts_of(left.column("text")), across):
            codes, counts, waiting, size = np.zeros(0, np.uint64), np.zeros((2, 0)), [], 0
            for k, (owner, symbols, lead) in enumerate(parts):
                where, code = coder.codes(symbols)
                where, code = where[where >= lead], code[where >= lead]
                new, back = distinct(code)
                of = fold[owner[where]]
                waiting.append((new, np.stack([np.bincount(back[of == f], minlength=len(new)) for f in (0, 1)])))
                size += len(new)
                if size < max(MERGE, len(codes)) and k + 1 < len(parts):  # merged when they are as many as those before
                    continue
                waiting, size, held = [], 0, [(codes, counts), *waiting]
                codes, back = np.unique(np.concatenate([c for c, _ in held]), return_inverse=True)
                counts = np.stack([np.bincount(back, weights=np.concatenate([n[f] for _, n in held]), minlength=len(codes)) for f in (0, 1)])
            yield coder, codes, counts.astype(np.int64)

    def table(block: int, grams: pa.Array, n0: np.ndarray, n1: np.ndarray) -> pa.Table:
        return pa.table({"block": pa.array(np.full(len(grams), block, np.int32)), "gram": grams, "n0": pa.array(n0), "n1": pa.array(n1)})

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        free_worker_cache("quality")
        block = left.column("_block")[0].as_py() if left.num_rows else 0
        found = list(counted(left, set(right.column("doc_id").to_pylist())))
        parts = [pa.concat_tables([table(block, pa.array(coder.strings(codes[k:k + SLICE]), pa.string()), *counts[:, k:k + SLICE])
                                   for k in range(0, len(codes), SLICE)]) for coder, codes, counts in found if len(codes)]
        if not parts:
            return table(block, pa.array([], pa.string()), *np.zeros((2, 0), np.int64))
        if len(parts) == 1:  # one alphabet has each n-gram once
            return parts[0]
        whole = pa.concat_tables(parts).group_by(["block", "gram"]).aggregate([("n0", "sum"), ("n1", "sum")])
        return whole.select(["block", "gram", "n0_sum", "n1_sum"]).rename_columns(["block", "gram", "n0", "n1"])

    return docs.select("_block", "doc_id", "text").groupBy("_block").cogroup(trusted.groupBy("_block")) \
        .applyInArrow(run, "block int, gram string, n0 bigint, n1 bigint")


def discounts(table: DataFrame) -> tuple[float, float, float]:
    """The three discounts from the numbers of n-grams with counts 1 to 4; where these do not give
    proper ones (tiny or odd tables) 0.5, 1 and 1.5."""
    n = {r["c"]: r["n"] for r in table.where("c <= 4").groupBy("c").agg(F.count("*").alias("n")).collect()}
    n1, n2, n3, n4 = (n.get(k, 0) for k in (1, 2, 3, 4))
    if min(n1, n2, n3, n4) == 0:
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    found = 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3
    return found if all(0 < d <= k for d, k in zip(found, (1, 2, 3))) else (0.5, 1.0, 1.5)


def probabilities(asked: DataFrame, counts: DataFrame, scratch: Scratch) -> tuple[DataFrame, list[DataFrame]]:
    """(gram, p): interpolated modified Kneser-Ney probability of the last character of each gram asked for; and the written
    tables that it is read from, to be dropped after use.

    ``asked``: distinct grams; ``counts``: (gram, c) of the trusted text. The longest n-grams and those at the
    beginning of a word have their own counts, shorter ones the number of different characters before them.
    """
    tables, wanted = {}, {}
    for k in range(ORDER, 0, -1):
        own = counts.where(F.char_length("gram") == k)
        asked_k = asked.where(F.char_length("gram") == k)
        if k < ORDER:
            own = own.unionByName(tables[k + 1].groupBy(F.expr("substring(gram, 2)").alias("gram")).agg(F.count("*").alias("c")))
            asked_k = asked_k.union(wanted[k + 1].select(F.expr("substring(gram, 2)").alias("gram"))).distinct()
        tables[k], wanted[k] = scratch.write(own, f"counts-{k}"), scratch.write(asked_k, f"asked-{k}")
    lower, made = None, []
    for k in range(1, ORDER + 1):
        d1, d2, d3 = discounts(tables[k])
        kept = F.col("c") - F.when(F.col("c") == 1, d1).when(F.col("c") == 2, d2).otherwise(d3)
        held = F.when(F.col("c") == 1, d1).when(F.col("c") == 2, d2).otherwise(d3)
        context = [F.sum("c").alias("total"), (F.sum(held) / F.sum("c")).alias("back")]
        rows = wanted[k].join(tables[k], "gram", "left")
        direct = F.when(F.col("c").isNull(), F.lit(0.0)).otherwise(kept / F.col("total"))
        if k == 1:
            whole = tables[1].agg(*context, F.count("*").alias("v")).first()
            if not whole["total"]:
                found = rows.select("gram", F.lit(1.0).alias("p"))
            else:
                flat = whole["back"] / (whole["v"] + 1)
                found = rows.withColumn("total", F.lit(float(whole["total"]))).select("gram", (direct + flat).alias("p"))
        else:
            head = tables[k].groupBy(F.expr(f"substring(gram, 1, {k - 1})").alias("head")).agg(*context)
            found = rows.withColumn("head", F.expr(f"substring(gram, 1, {k - 1})")).withColumn("tail", F.expr("substring(gram, 2)")) \
                .join(head, "head", "left").join(lower.select(F.col("gram").alias("tail"), F.col("p").alias("q")), "tail") \
                .select("gram", F.when(F.col("total").isNull(), F.col("q")).otherwise(direct + F.col("back") * F.col("q")).alias("p"))
        lower = scratch.write(found, f"p-{k}")
        scratch.drop(tables[k])
        scratch.drop(wanted[k])
        made.append(lower)
    return functools.reduce(DataFrame.union, made), made


def score(docs: DataFrame, answers: DataFrame, carry: list[str], across: bool) -> DataFrame:
    """Each document with n_symbols, log_prob, left_out (trusted documents: the same by the counts of the other fold) and trusted;
    ``answers`` holds, by block, n-grams with log probabilities and the ids of trusted documents."""
    fields = [docs.schema[c] for c in carry]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", n_symbols bigint, log_prob double, left_out double, trusted boolean"

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        free_worker_cache("quality")
        is_gram = right.column("gram").is_valid()
        grams = right.column("gram").filter(is_gram).combine_chunks()
        log_p = np.stack([pc.fill_null(right.column(c).filter(is_gram), 0.0).to_numpy() for c in ("log_p", "log_p0", "log_p1")])
        ids = set(right.column("doc_id").to_pylist()) - {None}
        fold = folds(left.column("doc_id").to_pylist(), ids)
        symbols, logs, others = np.zeros(left.num_rows, np.int64), np.zeros(left.num_rows), np.zeros(left.num_rows)
        for coder, parts in pieces(texts_of(left.column("text")), across):
            at, known = coder.numbers(grams)
            order = np.argsort(known)
            known, value = known[order], log_p[:, at[order]]
            for owner, part, lead in parts:
                where, code = coder.codes(part)
                where, code = where[where >= lead], code[where >= lead]
                row = owner[where]
                symbols += np.bincount(row, minlength=left.num_rows)
                new, back = distinct(code)
                found = value[:, np.searchsorted(known, new)]
                logs += np.bincount(row, weights=found[0][back], minlength=left.num_rows)
                in_fold = fold[row] >= 0
                row, back = row[in_fold], back[in_fold]
                others += np.bincount(row, weights=found[1 + fold[row], back], minlength=left.num_rows)
        columns = [left.column(c) for c in carry]
        return pa.table([*columns, pa.array(symbols, pa.int64()), pa.array(logs, pa.float64()),
                         pa.array(others, pa.float64()), pa.array(fold >= 0, pa.bool_())],
                        names=[*carry, "n_symbols", "log_prob", "left_out", "trusted"])

    return docs.groupBy("_block").cogroup(answers.groupBy("block")).applyInArrow(run, schema)


def classify_quality(docs: DataFrame, trusted: DataFrame, carry: tuple[str, ...] = (), quantile: float = QUANTILE,
                     across_words: bool = False) -> DataFrame:
    """Perplexity and verdict of every document; one row per input row.

    With ``across_words`` n-grams run over the spaces between words (white space counts as one space); without, a text's perplexity
    is the same in any order of its words.
    ``trusted`` has the doc_id of trusted documents. Returns doc_id, lang, the columns of ``carry``, n_symbols, perplexity (per character and word end),
    trusted, threshold, kept. ``kept``: the perplexity is at most the 0.98 quantile of the trusted documents of
    the same language, each scored for it by the counts of the other one of two folds (by a hash of the id), as new texts are; a language with
    under 250 trusted documents takes the quantile of all. About one clean row in fifty is lost. A text without words has no
    perplexity and is not kept. Null text: as empty. Null lang: a language of its own. Null doc_id: scored, never trusted. Repeated rows: one
    row each. Without trusted text everything with words is kept. Other columns are not read.

    The texts are shuffled twice (to count; to score, in two parts), by a hash of the id; a block holds about 24 MB of text.
    What a block gathers is its distinct n-grams, so the gathered tables grow with the input.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "quality")
    carry = list(dict.fromkeys(["doc_id", "lang", *carry]))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "lang", *[c for c in carry if c not in ("doc_id", "lang", "text")], "text")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-int(size) // BLOCK_BYTES))
    # rows of an id that cannot be trusted (null) are dealt by their text
    key = [F.coalesce("doc_id", F.xxhash64("text"))]
    rows = with_block(rows, key, blocks)
    ids = with_block(trusted.select(F.col("doc_id").cast("bigint").alias("doc_id")).where("doc_id is not null").distinct(), [F.col("doc_id")], blocks)
    old = {CLEANUP: spark.conf.get(CLEANUP, "false"), ARROW_BYTES: spark.conf.get(ARROW_BYTES)}
    spark.conf.set(CLEANUP, "true")  # what a written table was shuffled from goes before the next
    spark.conf.set(ARROW_BYTES, BATCH_BYTES)
    try:
        asked = scratch.write(gather(rows, ids, across_words), "asked")
        counts = scratch.write(asked.where("n0 + n1 > 0").groupBy("gram").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")), "counts")
        model, spent = probabilities(asked.select("gram").distinct(), counts.select("gram", F.expr("n0 + n1").alias("c")), scratch)
        model = model.select("gram", F.log("p").cast("float").alias("log_p"))
        text = counts.agg(F.max("n0").alias("n0"), F.max("n1").alias("n1")).first()
        halves = bool(text["n0"] and text["n1"])  # without text in both folds every document is scored by all
        for fold in (0, 1) if halves else ():
            left_out, more = probabilities(counts.where(f"n{fold} > 0").select("gram"),
                                           counts.where(f"n{1 - fold} > 0").select("gram", F.col(f"n{1 - fold}").alias("c")), scratch)
            spent += more
            model = model.join(left_out.select("gram", F.log("p").cast("float").alias(f"log_p{fold}")), "gram", "left")
        if halves:
            model = scratch.write(model, "model")
            for t in (*spent, counts):
                scratch.drop(t)
            spent = [model]
        answered = scratch.write(asked.join(model, "gram").select("block", "gram", "log_p", *[
            F.when(F.col(f"n{f}") > 0, F.col(f"log_p{f}" if halves else "log_p")).alias(f"log_p{f}") for f in (0, 1)]), "answers")
        for t in (asked, *spent):
            scratch.drop(t)
        answers = answered.withColumn("doc_id", F.lit(None).cast("bigint")).unionByName(
            ids.select(F.col("_block").alias("block"), "doc_id"), allowMissingColumns=True)
        of_symbols = lambda c: F.when(F.col("n_symbols") > 0, F.exp(-F.col(c) / F.col("n_symbols")))
        passes = min(PASSES, blocks)
        parts = []
        for k in range(passes):
            part = score(rows.where(F.col("_block") % passes == k), answers.where(F.col("block") % passes == k), carry, across_words)
            parts.append(scratch.write(part.withColumn("perplexity", of_symbols("log_prob"))
                                       .withColumn("_left_out", F.when(F.col("trusted"), of_symbols("left_out"))), "scored"))
        scored = functools.reduce(DataFrame.union, parts)
        scratch.drop(answered)
    finally:
        for name, value in old.items():
            spark.conf.set(name, value)
    level = F.percentile_approx("_left_out", F.lit(quantile), F.lit(QUANTILE_ACCURACY))
    held = scored.where("_left_out is not null")
    limits = scratch.write(held.groupBy(F.coalesce("lang", F.lit("")).alias("_lang"))
                           .agg(level.alias("own"), F.count("*").alias("n")).where(F.col("n") >= LEAST_ROWS).drop("n"), "limits")
    every = held.agg(level.alias("all")).first()["all"]
    threshold = F.coalesce("own", F.lit(every).cast("double"))
    return scored.withColumn("_lang", F.coalesce("lang", F.lit(""))).join(limits, "_lang", "left") \
        .withColumn("threshold", threshold) \
        .withColumn("kept", F.col("perplexity").isNotNull() & (F.col("threshold").isNull() | (F.col("perplexity") <= F.col("threshold")))) \
        .select(*carry, "n_symbols", "perplexity", "trusted", "threshold", "kept")


ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
