"""Connected components of an edge table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilog.session import materialize


def _toward_minimum(edges: DataFrame, larger: bool) -> DataFrame:
    """One star step: neighbours of each node are tied to the least of them instead.

    ``larger`` moves the neighbours above the node, else those below it (and the node).
    A node's neighbours never meet in one place: the minimum is a sum by key, then a join.
    """
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    near = both if larger else both.where("v < u")
    least = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = near.join(least, "u")
    if larger:
        moved = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return moved.where("u > v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v): the least node it is connected with.

    Steps repeat until each node hangs on its root directly; their number grows with the
    logarithm of the nodes. Each round is written to the shared folder. Loops and repeated
    edges change nothing; no edges give no rows; a null end of an edge is left out.
    """
    now = materialize(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges"
    )
    state = None
    while True:
        now = materialize(_toward_minimum(_toward_minimum(now, larger=True), larger=False), "edges")
        after = now.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long")), F.sum(F.xxhash64("v", "u") % 1_000_003)).first()
        if after == state:
            break
        state = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select("v", "v").distinct())
