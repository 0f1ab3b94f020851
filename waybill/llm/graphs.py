"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.llm.sizes import few
from waybill.session import scratch_path

#: Nodes whose labels may be broadcast.
BROADCAST_LABELS = 250_000


def written(df: DataFrame) -> DataFrame:
    """The table from files. A checkpoint would keep the estimated size of its plan, a product over all joins so far: its
    digits triple with each round, and soon planning takes minutes."""
    path = scratch_path(df.sparkSession, "labels")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ends(hooks: DataFrame, rows: int) -> DataFrame:
    """node, up: hooks, no more than so many, followed to where none leads on, by doubling."""
    hooks, small = written(few(hooks, rows)), rows <= BROADCAST_LABELS
    while True:
        onward = hooks.select(F.col("node").alias("up"), F.col("up").alias("beyond"))
        after = hooks.join(F.broadcast(onward) if small else onward, "up", "left")
        after = written(few(after.select("node", F.coalesce("beyond", "up").alias("up"), F.col("beyond").isNotNull().alias("moved")), rows))
        hooks = after.select("node", "up")
        if after.where("moved").isEmpty():
            return hooks


def components(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """node, component: the smallest node that links reach, for each node of a link between two nodes.

    Each round hooks a node to its least neighbour, if that is smaller, and follows hooks to their ends. Links are then
    drawn between ends, and those inside one component fall away, so most links are joined in the first round only. Two
    rounds leave at most half of the nodes. Partial aggregates keep a node with many links from meeting in one task.
    """
    rows = total = links.count()
    low, high = F.least(left, right).alias("a"), F.greatest(left, right).alias("b")
    edges = written(few(links.where(F.col(left) != F.col(right)).select(low, high).distinct(), rows))
    nodes = edges.select(F.col("a").alias("node")).union(edges.select(F.col("b").alias("node"))).distinct()
    labels = few(nodes.withColumn("component", F.col("node")), 2 * total)
    while rows := edges.count():
        hooks = ends(edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("up")), rows)
        named = [hooks.select(F.col("node").alias(name), F.col("up").alias(f"{name}_up")) for name in ("a", "b", "component")]
        a, b, component = [F.broadcast(x) if rows <= BROADCAST_LABELS else x for x in named]
        labels = labels.join(component, "component", "left").select("node", F.coalesce("component_up", "component").alias("component"))
        labels = written(few(labels, 2 * total))
        drawn = edges.join(a, "a", "left").join(b, "b").select(F.coalesce("a_up", "a").alias("a"), F.col("b_up").alias("b"))
        drawn = drawn.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        edges = written(few(drawn, rows))
    return labels
