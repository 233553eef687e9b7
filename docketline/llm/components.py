"""Connected components by contraction, all in DataFrame operations.

Each round points every node at its least neighbour, follows two pointers and
replaces the edges by those between the nodes pointed at; a star, a chain of
stars or a clique shrinks to a point in a round or two. Rounds are cut by
written tables. Minima are taken before the shuffle, so a hub costs one row a
task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketline.llm.common import materialize


def components(edges: DataFrame) -> DataFrame:
    """edges (a, b) -> (node, root): one root for all connected nodes. Nodes
    without an edge to another node don't appear."""
    e = edges.where(F.col("a") != F.col("b"))
    e = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select("b", "a")).distinct()
    e = materialize(e, "edges")
    found = None
    while not e.isEmpty():
        near = e.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("p"))
        for _ in range(2):
            up = near.select(F.col("u").alias("w"), F.col("p").alias("q"))
            near = near.join(up, F.col("p") == F.col("w")).select("u", F.col("q").alias("p"))
        near = materialize(near, "parents")
        if found is None:
            found = near.select(F.col("u").alias("node"), F.col("p").alias("root"))
        else:
            found = (found.join(near, F.col("root") == F.col("u"), "left")
                     .select("node", F.coalesce("p", "root").alias("root")))
        found = materialize(found, "roots")
        left = near.select("u", F.col("p").alias("pu"))
        right = near.select(F.col("u").alias("w"), F.col("p").alias("pv"))
        e = (e.join(left, "u").join(right, F.col("v") == F.col("w")).where(F.col("pu") != F.col("pv"))
             .select(F.col("pu").alias("u"), F.col("pv").alias("v")).distinct())
        e = materialize(e, "edges")
    if found is None:
        return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return found
