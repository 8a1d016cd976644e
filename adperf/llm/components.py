"""Connected components of a link table, by hooking and contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adperf.sources.staging import stage


def components(links: DataFrame) -> DataFrame:
    """node, root for every end of a link (columns a, b); root is the smallest node reachable.

    Each round lets every node hook to its smallest neighbour if that is smaller,
    follows the hooks to their ends, and keeps the links between different ends.
    Rounds grow with the logarithm of the longest chain.  Everything is a join or a
    minimum by key; no component is gathered anywhere.
    """
    both = links.select("a", "b").filter("a <> b")
    edges = stage(both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    ends = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    labels = stage(ends.select("node", F.col("node").alias("root")), "labels")
    while not edges.isEmpty():
        hooks = (
            edges.select(F.col("b").alias("node"), F.col("a").alias("to"))
            .groupBy("node").agg(F.min("to").alias("to"))
        )
        hooks = stage(hooks, "hooks")
        while True:  # the ends of the hooks, twice as far each time
            further = hooks.alias("x").join(hooks.alias("y"), F.col("x.to") == F.col("y.node"), "left").select(
                "x.node", F.coalesce("y.to", "x.to").alias("to"), F.col("y.to").isNotNull().alias("moved"))
            further = stage(further, "hooks")
            hooks = further.select("node", "to")
            if further.filter("moved").isEmpty():
                break
        labels = stage(
            labels.join(hooks, labels["root"] == hooks["node"], "left")
            .select(labels["node"], F.coalesce("to", "root").alias("root")),
            "labels",
        )
        a = edges.join(hooks, edges["a"] == hooks["node"], "left").select(F.coalesce("to", "a").alias("a"), "b")
        ab = a.join(hooks, a["b"] == hooks["node"], "left").select("a", F.coalesce("to", "b").alias("b"))
        edges = stage(
            ab.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
            "links",
        )
    return labels


def extended(labels: DataFrame, links: DataFrame) -> DataFrame:
    """`labels` (node, root) after further links (a, b), whose ends may be new nodes.

    Only the links between roots go through `components`, so the work follows what the
    links join and not the nodes there are.
    """
    x = labels.select(F.col("node").alias("a"), F.col("root").alias("_ra"))
    y = labels.select(F.col("node").alias("b"), F.col("root").alias("_rb"))
    among = components(links.select("a", "b").join(x, "a", "left").join(y, "b", "left").select(
        F.coalesce("_ra", "a").alias("a"), F.coalesce("_rb", "b").alias("b")))
    ends = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
    known = labels.select("node", "root").unionByName(
        ends.join(labels, "node", "left_anti").select("node", F.col("node").alias("root")))
    moved = among.select(F.col("node").alias("root"), F.col("root").alias("_to"))
    return stage(
        known.join(moved, "root", "left").select("node", F.coalesce("_to", "root").alias("root")), "labels")
