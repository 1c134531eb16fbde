"""Connected components by contraction, as joins and aggregates on written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratlab.llm.common import Scratch


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, comp) for every node of ``edges`` (a, b); comp is the smallest node of its component.

    Each round a node points to its smallest neighbour if that is smaller; pointers are
    followed to their roots by doubling, and the edges between roots go to the next round. At least half of
    the nodes of each component drop out in a round. A node with very many edges is combined
    before the shuffle (minimum) or split by adaptive execution (joins).
    """
    edges = scratch.write_narrow(edges.select("a", "b").where("a <> b").distinct(), "edges")
    total = None
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        pointers = scratch.write_narrow(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("comp")).where("comp < node"), "pointers")
        while True:
            up = pointers.select(F.col("node").alias("comp"), F.col("comp").alias("next"))
            jumped = scratch.write_narrow(pointers.join(up, "comp", "left").select(
                "node", F.coalesce("next", "comp").alias("comp"), F.col("next").isNotNull().alias("moved")), "pointers")
            scratch.drop(pointers)
            pointers = jumped
            if pointers.where("moved").isEmpty():
                break
        pointers_only = pointers.select("node", "comp")
        if total is None:
            total, spent = pointers, [edges]
        else:
            moved = total.select("node", F.col("comp").alias("root")).join(
                pointers_only.select(F.col("node").alias("root"), "comp"), "root", "left") \
                .select("node", F.coalesce("comp", "root").alias("comp"))
            new = scratch.write_narrow(moved.union(pointers_only.join(total.select("node"), "node", "left_anti")), "roots")
            spent, total = [edges, total, pointers], new
        a = pointers_only.select(F.col("node").alias("a"), F.col("comp").alias("ra"))
        b = pointers_only.select(F.col("node").alias("b"), F.col("comp").alias("rb"))
        next_edges = scratch.write_narrow(edges.join(a, "a", "left").join(b, "b", "left").select(
            F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b")).where("a <> b").distinct(), "edges")
        for df in spent:
            scratch.drop(df)
        edges = next_edges
    if total is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("comp"))
    return total.select("node", "comp").union(
        total.select(F.col("comp").alias("node"), "comp").distinct())
