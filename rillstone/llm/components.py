"""Connected components of a graph held in tables, without gathering it anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillstone.llm.common import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of (u, v) edges; a component is named by its least node.

    Each round gives a node the least label among its own, its neighbours' and its label's label,
    until no label changes. Rounds are stored in the shared folder. Joins read stored tables on
    both sides, so Spark can split a node with many edges over tasks.
    """
    both = stored(edges.select("u", "v").union(edges.select("v", "u")).where("u <> v").distinct(), "edges")
    labels = stored(both.groupBy("u").agg(F.min("v").alias("v")).select(F.col("u").alias("node"), F.least("u", "v").alias("component")), "labels")
    total = labels.agg(F.sum(F.col("component").cast("decimal(38,0)"))).first()[0]
    while total is not None:
        near = both.join(labels, both.v == labels.node).groupBy("u").agg(F.min("component").alias("component"))
        own = labels.union(near.select(F.col("u").alias("node"), "component"))
        hooked = stored(own.groupBy("node").agg(F.min("component").alias("component")), "labels")
        up = hooked.select(F.col("node").alias("component"), F.col("component").alias("above"))
        labels = stored(hooked.join(up, "component").select("node", F.col("above").alias("component")), "labels")
        before, total = total, labels.agg(F.sum(F.col("component").cast("decimal(38,0)"))).first()[0]
        if total == before:
            break
    return labels
