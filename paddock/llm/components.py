"""Connected components of an edge table by alternating large-star and small-star
rounds (Kiveris et al., 2014). Every round is a few joins and partially aggregated
minima over the edges, written to the shared folder; nothing is collected but counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paddock.llm._common import discard, staged


def _contracted(edges: DataFrame, name: str) -> DataFrame:
    """Both stars over stored edges (u, v) with v < u: large, then small; stored."""
    # large: at its smaller end v, an edge moves to the least neighbour of v. The minima
    # are stored so that the join has plain shuffles on both sides: a node with very many
    # neighbours is then split over tasks by adaptive execution.
    least = staged(edges.groupBy("u").agg(F.min("v").alias("m")), name)
    large = (edges.join(least.select(F.col("u").alias("v"), "m"), "v", "left")
             .select("u", F.coalesce("m", "v").alias("v")).distinct())
    # small: at its larger end, all smaller neighbours meet at the least
    lower = large.groupBy("u").agg(F.min("v").alias("m"))
    moved = (large.join(lower, "u").filter("v <> m")
             .select(F.col("v").alias("u"), F.col("m").alias("v")))
    out = staged(moved.unionByName(lower.select("u", F.col("m").alias("v"))).distinct(), name)
    discard(least)
    return out


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root): the smallest node reachable, for every node of ``edges`` (u, v)
    longs. Self-loops and repeated edges are allowed; nulls are not."""
    nodes = edges.select(F.col("u").alias("node")).unionByName(edges.select(F.col("v").alias("node")))
    now = staged(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"),
                                               F.least("u", "v").alias("v")).distinct(), name)
    mark = None
    while True:
        last, now = now, _contracted(now, name)
        discard(last)
        # a star forest maps to itself: compare order-free summaries of the edge sets
        new = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")),
                      F.countDistinct("u")).first()
        if new[0] == new[2] and tuple(new) == mark:
            break
        mark = tuple(new)
    return (nodes.distinct().join(now.select(F.col("u").alias("node"), F.col("v").alias("root")),
                                  "node", "left")
            .select("node", F.coalesce("root", "node").alias("root")))
