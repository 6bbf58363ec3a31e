"""Connected components of a table of links, by alternating star contractions.

Nothing is collected: every round is a grouped minimum and a join of stored tables, so a
node with very many links is pre-aggregated before the shuffle and split by the join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadweave.llm.common import stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every node of ``links``; root is the smallest node reachable."""
    edges = stored(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(),
        "links",
    )
    seen = None
    while True:
        state = edges.select(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            break
        seen = state
        edges = _small_star(_large_star(edges))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node is linked to the least of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = stored(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
    return stored(
        both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(),
        "large-star",
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and all its smaller neighbours are linked to the least of them."""
    least = stored(edges.groupBy("u").agg(F.min("v").alias("m")), "least")
    near = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    return stored(near.unionByName(own).distinct(), "small-star")
