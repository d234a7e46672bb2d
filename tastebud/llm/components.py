"""Connected components of a link table, as Spark joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastebud.llm.scratch import written


def components(links: DataFrame, src: str = "a", dst: str = "b", max_rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every node of ``links``; component is the smallest node reachable.

    Each round hooks every node's parent to the smallest parent among its
    neighbours and then halves the paths to the roots, so the number of rounds
    is about the logarithm of a component's diameter.  Links inside a settled
    component drop out of later rounds: after each round both ends are replaced
    by their parents and equal or repeated links go.  Grouped minima combine
    before their shuffle, so a node with very many links sends one row a task.
    Nodes that are null link nothing.
    """
    edges = (
        links.select(F.col(src).alias("a"), F.col(dst).alias("b"))
        .filter("a is not null and b is not null")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    edges = written(edges, "links")
    labels = written(
        edges.select(F.col("a").alias("node")).union(edges.select(F.col("b").alias("node"))).distinct().withColumn("component", F.col("node")),
        "labels",
    )
    live = edges.filter("a <> b")
    for _ in range(max_rounds):
        if live.isEmpty():
            return labels
        # hook: each end takes the smallest of itself and its neighbours; a's are the larger ends
        low = live.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("up"))
        up = written(low, "hooks")
        # follow hooks of hooks until they stand still: node -> root among the live nodes
        root = up
        while True:
            nxt = root.alias("r").join(root.select(F.col("node").alias("n2"), F.col("up").alias("up2")).alias("s"), F.col("up") == F.col("n2"), "left")
            jumped = written(nxt.select("node", F.coalesce("up2", "up").alias("up"), (F.col("up2").isNotNull() & (F.col("up2") != F.col("up"))).alias("moved")), "jump")
            root = jumped.select("node", "up")
            if jumped.filter("moved").isEmpty():
                break
        labels = written(
            labels.join(root.select(F.col("node").alias("component"), "up"), "component", "left").select("node", F.coalesce("up", "component").alias("component")),
            "labels",
        )
        ra = root.select(F.col("node").alias("a"), F.col("up").alias("ua"))
        rb = root.select(F.col("node").alias("b"), F.col("up").alias("ub"))
        live = written(
            live.join(ra, "a", "left")
            .join(rb, "b", "left")
            .select(F.coalesce("ua", "a").alias("x"), F.coalesce("ub", "b").alias("y"))
            .filter("x <> y")
            .select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b"))
            .distinct(),
            "links",
        )
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
