"""Connected components by alternating large-star and small-star steps.

Each step is a minimum per node (combined before the shuffle) and a join back to the edges, so no
neighbourhood is ever gathered in one place; a hot node is a skewed join, which Spark splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrina.llm.tables import Scratch


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Edges (v, w), v > w, moved to the least neighbour of v (large: of either end)."""
    both = edges.select(F.col("v").alias("u"), F.col("w").alias("n"))
    if large:
        both = both.unionByName(edges.select(F.col("w").alias("u"), F.col("v").alias("n")))
    least = both.groupBy("u").agg(F.min("n").alias("m")).select("u", F.least("u", "m").alias("m"))
    moved = both.join(least, "u")
    if large:
        out = moved.filter("n > u").select(F.col("n").alias("v"), F.col("m").alias("w"))
    else:
        out = moved.select(F.col("n").alias("v"), F.col("m").alias("w")).unionByName(least.select(F.col("u").alias("v"), F.col("m").alias("w")))
    return out.filter("v <> w").select(F.greatest("v", "w").alias("v"), F.least("v", "w").alias("w")).distinct()


def connected_components(edges: DataFrame, a: str, b: str, rows: int | None = None) -> DataFrame:
    """Columns node and component (the least node of its component) for every node with an edge to another.

    ``rows`` is about the number of edges, if known. Self-loops, nulls and repeated edges add nothing; an empty
    table gives an empty result. Nodes are of any type that has an order.
    """
    start = edges.select(F.greatest(a, b).alias("v"), F.least(a, b).alias("w")).filter(f"{a} is not null and {b} is not null and v <> w").distinct()
    now = Scratch(start, rows)
    seen = None
    while True:
        mark = now.df.agg(F.count("*"), F.bit_xor(F.xxhash64("v", "w"))).first()
        if mark == seen or mark[0] == 0:
            break
        seen = mark
        step = Scratch(_stars(_stars(now.df, True), False), mark[0])
        now.drop()
        now = step
    # Every edge now leads from a node to the least of its component; that one is not a node of the left side.
    return now.df.select(F.col("v").alias("node"), F.col("w").alias("component")).unionByName(now.df.select(F.col("w").alias("node"), F.col("w").alias("component")).distinct())
