"""Connected components by alternating large-star and small-star steps, each
step a partial aggregate and a join over a table in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from selfmend.llm.common import materialised


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step over ``(u, v)``: the larger (or the smaller and own) neighbours
    of each node are linked to the least of its neighbourhood."""
    if large:
        around = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        around = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    # the least neighbour of each node, written so that a node with very many edges can be split in the join
    least = materialised(around.groupBy("u").agg(F.min("v").alias("m"))
                         .select("u", F.least("u", "m").alias("m")), "star")
    joined = around.join(least.hint("merge"), "u")
    if large:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .unionByName(least.select("u", F.col("m").alias("v")))
    return materialised(out.where("u != v").distinct(), "edges")


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of the links ``(a, b)``: the root is the
    least node that can be reached."""
    edges = materialised(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                         .where("u != v").distinct(), "edges")
    seen = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_000_007)).first()
        if state == seen or not state[0]:
            break
        seen = state
        edges = _star(_star(edges, large=True), large=False)
    # every edge now leads to a root
    roots = edges.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return materialised(edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots), "roots")
