"""Chat formatting of reply trees (operator 10).

Messages form trees by parent id. Root-to-leaf paths are found by iterative
self-joins that double the distance of a jump pointer each time, so their
number follows the logarithm of the depth. Each leaf gets the score of its branch;
the best branches of a root are formatted as one conversation each.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratlab.llm.common import Scratch

START, END = "<|im_start|>", "<|im_end|>"
#: Control strings of common chat templates; all start with "<" or "[".
CONTROL = ("<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
TAILS = "|".join(re.escape(c[1:]) for c in CONTROL)
#: A control string, perhaps escaped before: one more backslash goes after its first character.
ESCAPE = re.compile(r"([<\[])(\\*)(?=" + TAILS + ")")
UNESCAPE = re.compile(r"([<\[])\\(\\*)(?=" + TAILS + ")")
TURN = re.compile(re.escape(START) + r"([^\n]*)\n(.*?)" + re.escape(END) + "\n", re.DOTALL)

FORMATTED = ("conv_id bigint, branch bigint, score double, n_turns bigint, formatted string, "
             "loss_spans array<struct<start:bigint,length:bigint>>")
DIGEST = ("conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
          "formatted_chars bigint")


def escape(text: str) -> str:
    return ESCAPE.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return UNESCAPE.sub(r"\1\2", text)


def escape_role(role: str) -> str:
    """A role on one line: backslashes and line feeds as two characters, control strings escaped."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def format_turns(turns: list[tuple[str, str]]) -> tuple[str, list[dict]]:
    """The formatted conversation and the spans (code points) that bear loss: assistant texts."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        before, body = f"{START}{escape_role(role)}\n", escape(text)
        if role == "assistant":
            spans.append({"start": at + len(before), "length": len(body)})
        parts += [before, body, END + "\n"]
        at += len(before) + len(body) + len(END) + 1
    return "".join(parts), spans


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation, as they were."""
    out, at = [], 0
    while at < len(formatted):
        m = TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at code point {at}")
        out.append((unescape_role(m[1]), unescape(m[2])))
        at = m.end()
    return out


def jump_tables(scratch: Scratch, nodes: DataFrame) -> list[DataFrame]:
    """Pointers (tree, node, anc, gain) to the ancestor 1, 2, 4, ... steps up, and the score
    passed on the way. The self-joins end when no node has an ancestor so far up.

    A cycle of parents would never end: when every pointer of a level is still
    there after more doublings than the number of nodes allows, ValueError is raised.
    """
    level = scratch.write(
        nodes.alias("c").join(nodes.alias("p"), (F.col("c.tree") == F.col("p.tree")) & (F.col("c.parent") == F.col("p.node")))
        .select("c.tree", "c.node", F.col("p.node").alias("anc"), F.col("c.score").alias("gain")), "jump")
    total = nodes.count()
    out = []
    while True:
        if level.isEmpty():
            scratch.drop(level)
            return out
        out.append(level)
        if 2 ** len(out) > 2 * total:
            raise ValueError("messages answer each other in a circle")
        a, b = level.alias("a"), level.alias("b")
        level = scratch.write(
            a.join(b, (F.col("a.tree") == F.col("b.tree")) & (F.col("a.anc") == F.col("b.node")))
            .select("a.tree", "a.node", "b.anc", (F.col("a.gain") + F.col("b.gain")).alias("gain")), "jump")


def best_paths(messages: DataFrame, branches: int = 1) -> DataFrame:
    """Rows (tree, branch, branch_score, pos, node) of the ``branches`` best root-to-leaf paths of each root.

    ``messages``: tree, node (unique in a tree), parent (null for a root), score (null: 0).
    A message whose parent is missing counts as a root. A path's score is the sum over its messages;
    ties go to the smaller leaf. ``pos`` counts from 0 at the root.
    """
    spark = messages.sparkSession
    scratch = Scratch(spark, "reply-trees")
    m = messages.select("tree", "node", "parent", F.coalesce(F.col("score"), F.lit(0.0)).cast("double").alias("score"))
    nodes = scratch.write(m.alias("m").join(
        m.select(F.col("tree").alias("t"), F.col("node").alias("n")),
        (F.col("tree") == F.col("t")) & (F.col("parent") == F.col("n")), "left")
        .select("tree", "node", F.when(F.col("n").isNotNull(), F.col("parent")).alias("parent"), "score"), "nodes")
    jumps = jump_tables(scratch, nodes)
    # climb from each leaf with the longest jumps first: each ancestor is met once
    leaves = nodes.join(nodes.select("tree", F.col("parent").alias("node")).where("node is not null").distinct(),
                        ["tree", "node"], "left_anti")
    tops = leaves.select("tree", F.col("node").alias("leaf"), F.col("node").alias("at"), F.lit(0.0).alias("gained"),
                         F.lit(0).cast("bigint").alias("depth"))
    for k in reversed(range(len(jumps))):
        tops = tops.alias("l").join(jumps[k].alias("j"), (F.col("l.tree") == F.col("j.tree")) & (F.col("l.at") == F.col("j.node")), "left") \
            .select("l.tree", "leaf", F.coalesce("j.anc", "l.at").alias("at"),
                    (F.col("gained") + F.coalesce("j.gain", F.lit(0.0))).alias("gained"),
                    (F.col("depth") + F.when(F.col("j.anc").isNotNull(), 2 ** k).otherwise(0)).alias("depth"))
    scored = tops.alias("l").join(nodes.alias("r"), (F.col("l.tree") == F.col("r.tree")) & (F.col("l.at") == F.col("r.node"))) \
        .select("l.tree", "leaf", F.col("at").alias("root"), "depth", (F.col("gained") + F.col("r.score")).alias("branch_score"))
    if branches == 1:  # the best only: an aggregate that combines before the shuffle
        best = F.min(F.struct((-F.col("branch_score")).alias("s"), "leaf", "depth")).alias("b")
        chosen = scored.groupBy("tree", "root").agg(best).select(
            "tree", F.col("b.leaf").alias("leaf"), F.col("b.depth").alias("depth"), (-F.col("b.s")).alias("branch_score"),
            F.lit(1).cast("bigint").alias("branch"))
    else:
        rank = F.row_number().over(Window.partitionBy("tree", "root").orderBy(F.desc("branch_score"), "leaf"))
        chosen = scored.withColumn("branch", rank.cast("bigint")).where(F.col("branch") <= branches).drop("root")
    path = scratch.write(chosen.select("tree", "branch", "leaf", "branch_score", F.col("leaf").alias("node"), F.col("depth").alias("pos")), "path")
    for k in reversed(range(len(jumps))):
        up = path.alias("l").join(jumps[k].alias("j"), (F.col("l.tree") == F.col("j.tree")) & (F.col("l.node") == F.col("j.node"))) \
            .select("l.tree", "branch", "leaf", "branch_score", F.col("j.anc").alias("node"), (F.col("pos") - 2 ** k).alias("pos"))
        whole = scratch.write(path.unionByName(up), "path")
        scratch.drop(path)
        path = whole
    out = path.select("tree", "branch", "leaf", "branch_score", "pos", "node")
    for df in (nodes, *jumps):
        scratch.drop(df)
    return out


def format_conversations(messages: DataFrame, branches: int = 1) -> DataFrame:
    """Format the best branches of reply trees; one row per chosen path.

    ``messages``: conv_id, message_id, parent_id, score, role, text. Null role or
    text: as empty. Messages with null conv_id form one tree. Rows that repeat a message id
    within a conversation are an error of the caller's: number them first (``as_chain``). Other columns are
    not read. An empty table gives no row. Turns reach one task per conversation as a sorted stream, so a
    task holds one conversation at a time.

    Template: ``<|im_start|>role\\ntext<|im_end|>\\n``. A control string inside a text gets a backslash
    after its first character (one more where backslashes stand there already), which
    ``unescape`` takes away. Returns conv_id, branch (rank by score), score, n_turns, formatted,
    loss_spans.
    """
    m = messages.select(F.col("conv_id").cast("bigint").alias("tree"), F.col("message_id").alias("node"),
                        F.col("parent_id").alias("parent"), F.col("score").cast("double").alias("score"),
                        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    tagged = m.withColumn("none", F.col("tree").isNull()).withColumn("tree", F.struct(F.col("none"), F.coalesce("tree", F.lit(0)).alias("id")))
    paths = best_paths(tagged, branches)
    turns = paths.alias("p").join(tagged.alias("m"), (F.col("p.tree") == F.col("m.tree")) & (F.col("p.node") == F.col("m.node"))) \
        .select(F.when(~F.col("p.tree.none"), F.col("p.tree.id")).alias("conv_id"), "branch", "leaf", "branch_score", "pos", "role", "text")
    keys = ["conv_id", "leaf"]

    def run(batches):
        names = ["conv_id", "branch", "score", "n_turns", "formatted", "loss_spans"]
        span = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
        kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.string(), span]

        def emit(done):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names=names)

        key, meta, held, done, size = None, None, [], [], 0

        def close():
            nonlocal size
            formatted, spans = format_turns(held)
            size += len(formatted)
            done.append((*meta, len(held), formatted, spans))
            held.clear()

        for batch in batches:
            for conv, branch, leaf, score, _, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                if key != (conv, leaf):
                    if held:
                        close()
                    key, meta = (conv, leaf), (conv, branch, score)
                    if size > 8_000_000:
                        yield emit(done)
                        done, size = [], 0
                held.append((role, text))
        if held:
            close()
        if done:
            yield emit(done)

    return turns.repartition(*keys).sortWithinPartitions(*keys, "pos").mapInArrow(run, FORMATTED)


def as_chain(conversations: DataFrame) -> DataFrame:
    """Linear conversations (conv_id, turn, role, text) as reply trees of one branch each.

    Messages are numbered by turn; rows of equal turn by role, then text, so repeated
    rows stay and the order is defined.
    """
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    return conversations.select("conv_id", "turn", "role", "text").select(
        "conv_id", F.row_number().over(order).cast("bigint").alias("message_id"),
        (F.row_number().over(order) - 1).cast("bigint").alias("parent_id"), F.lit(0.0).alias("score"), "role", "text")


def digest_formatted(formatted: DataFrame) -> DataFrame:
    """Digests of formatted conversations, read back from the formatted text and its loss spans."""
    def run(batches):
        names = [c.split()[0] for c in DIGEST.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        for batch in batches:
            rows = []
            for conv, text, spans in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "formatted", "loss_spans"))):
                turns = read_turns(text)
                every, loss, chars = hashlib.sha256(), hashlib.sha256(), 0
                for role, body in turns:
                    every.update(f"{role}\n{body}\n".encode("utf-8"))
                for s in spans:
                    body = unescape(text[s["start"]:s["start"] + s["length"]])
                    loss.update(body.encode("utf-8"))
                    chars += len(body)
                rows.append((conv, len(turns), every.hexdigest(), chars, loss.hexdigest(), len(text)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 6, kinds)], names=names)

    return formatted.select("conv_id", "formatted", "loss_spans").mapInArrow(run, DIGEST)
