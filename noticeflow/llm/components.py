"""Connected components as DataFrame rounds (no driver-side graph).

Each round lets every node take its smallest neighbour (an aggregate with
map-side combine, so a hub with many links is no hot key), follows these
choices to their roots, and contracts the links to links between roots.
The number of nodes with links at least halves per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def _roots(parent: DataFrame) -> DataFrame:
    """(node, root) of a forest (node, up) in which up < node."""
    table = materialise(parent, "forest")
    while True:
        up = table.select(F.col("node").alias("_n"), F.col("up").alias("_up"))
        table = materialise(
            table.join(up, table["up"] == up["_n"], "left").select(
                "node", F.coalesce("_up", "up").alias("up"), F.col("_up").isNotNull().alias("moved")
            ),
            "forest",
        )
        moved = table.filter("moved").limit(1).count()
        table = table.select("node", "up")
        if not moved:
            return table.withColumnRenamed("up", "root")


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links(a, b)``; the component is
    its smallest node. Self-links and null ends are ignored."""
    live = materialise(links.select("a", "b").filter("a <> b"), "links")
    labels = None
    while live.limit(1).count():
        both = live.union(live.select("b", "a")).toDF("node", "other")
        smallest = both.groupBy("node").agg(F.min("other").alias("other"))
        up = smallest.filter("other < node").select("node", F.col("other").alias("up"))
        roots = _roots(up)
        if labels is None:
            nodes = smallest.select("node")
            first = roots.withColumnRenamed("node", "_n")
            labels = nodes.join(first, nodes["node"] == first["_n"], "left").select(
                "node", F.coalesce("root", "node").alias("component")
            )
        else:
            step = roots.withColumnRenamed("node", "_n")
            labels = labels.join(step, labels["component"] == step["_n"], "left").select(
                "node", F.coalesce("root", "component").alias("component")
            )
        labels = materialise(labels, "labels")
        ra = roots.select(F.col("node").alias("_a"), F.col("root").alias("_ra"))
        rb = roots.select(F.col("node").alias("_b"), F.col("root").alias("_rb"))
        live = live.join(ra, live["a"] == ra["_a"], "left").join(rb, live["b"] == rb["_b"], "left").select(
            F.coalesce("_ra", "a").alias("a"), F.coalesce("_rb", "b").alias("b")
        )
        live = materialise(live.filter("a <> b").distinct(), "links")
    if labels is None:
        return live.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels
