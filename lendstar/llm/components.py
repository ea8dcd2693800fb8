"""Connected components of an undirected edge list, by repeated contraction.

Every node picks the smallest id among itself and its neighbours; edges are
rewritten to the picked ids and the rounds go on until none is left.  A round
takes one minimum per node (pre-aggregated before the shuffle, so a hub costs
no more than another node) and two joins that can be split when they're
skewed.  The rounds grow with the logarithm of the longest path; each one's
result is a table in the shared folder, and only counts reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendstar.llm.common import stored


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): every node of ``edges`` with the smallest id that it
    reaches.  Null ends and loops are ignored; no edges give no rows."""
    e = edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).filter("a < b").distinct()
    e = stored(e, "cc-edges")
    labels = None
    while not e.isEmpty():
        both = e.select(F.col("a").alias("node"), F.col("a").alias("other")).unionByName(
            e.select(F.col("b").alias("node"), F.col("a").alias("other")))
        up = stored(both.groupBy("node").agg(F.min("other").alias("up")), "cc-up")
        if labels is None:
            labels = up.select("node", F.col("up").alias("component"))
        else:
            move = up.select(F.col("node").alias("component"), "up")
            labels = stored(labels.join(move, "component", "left").select(
                "node", F.coalesce("up", "component").alias("component")), "cc-labels")
        ua = up.select(F.col("node").alias("a"), F.col("up").alias("ua"))
        ub = up.select(F.col("node").alias("b"), F.col("up").alias("ub"))
        e = e.join(ua, "a").join(ub, "b").select(F.least("ua", "ub").alias("a"), F.greatest("ua", "ub").alias("b"))
        e = stored(e.filter("a < b").distinct(), "cc-edges")
    if labels is None:
        return e.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels
