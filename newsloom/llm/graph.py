"""Connected components of a stored edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from newsloom.llm.tables import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of the nodes of edges (a, b); the component is the smallest node that can
    be reached. Labels move along edges and then along labels, so that a chain of n nodes takes
    about log n rounds. Each round is written to the shared folder."""
    both = stored(
        edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
        "edges",
    )
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.min("a")).alias("component")), "labels")
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("b"), "component"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("_near"))
        )
        lower = labels.join(near, "node", "left").select(
            "node", F.col("component").alias("_old"), F.least("component", F.coalesce("_near", "component")).alias("_mid")
        )
        jump = labels.select(F.col("node").alias("_mid"), F.col("component").alias("_far"))
        moved = stored(
            lower.join(jump, "_mid", "left").select(
                "node", "_old", F.least("_mid", F.coalesce("_far", "_mid")).alias("component")
            ),
            "labels",
        )
        labels = moved.select("node", "component")
        if moved.filter(F.col("_old") != F.col("component")).isEmpty():
            return labels
