"""Connected components of a graph that is given by its links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from telemetra.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``links (a, b)``; a component is named by one of its nodes.

    Each round hooks every node to its smallest neighbour, follows the hooks twice and contracts the
    links; it ends when none is left. Minima are partial aggregations, so a node with very many links
    costs no task more than others. An empty table gives no rows.
    """
    links = written(links.where("a <> b").distinct(), "links")
    labels = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
    labels = labels.withColumn("component", F.col("node"))
    while not links.isEmpty():
        both = links.union(links.select("b", "a"))
        hooks = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("up"))
        upper = hooks.select(F.col("a").alias("up"), F.col("up").alias("upper"))
        hooks = written(
            hooks.join(upper, "up", "left").select("a", F.coalesce("upper", "up").alias("up")), "hooks"
        )
        labels = written(
            labels.join(hooks, labels["component"] == hooks["a"], "left").select(
                "node", F.coalesce("up", "component").alias("component")
            ),
            "labels",
        )
        to_a, to_b = hooks.select("a", F.col("up").alias("x")), hooks.select(F.col("a").alias("b"), F.col("up").alias("y"))
        links = written(
            links.join(to_a, "a").join(to_b, "b").where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(),
            "links",
        )
    return labels
