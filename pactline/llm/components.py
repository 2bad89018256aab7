"""Connected components of edge tables by hooking and pointer jumping, kept up as edges come in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pactline.llm.common import drop_stage, stage


def hooked(spark: SparkSession, edges: DataFrame, jumps: int = 2) -> DataFrame:
    """``edges(a, b)`` to (node, root): each node points at its least neighbour, or itself, and ``jumps`` times at its target's target."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    now = stage(spark, both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b")).select("node", F.least("node", "b").alias("root")), "hooks")
    for _ in range(jumps):
        target = now.select(F.col("node").alias("root"), F.col("root").alias("next"))
        jumped = stage(spark, now.join(target, "root").select("node", F.col("next").alias("root")), "hooks")
        drop_stage(spark, now)
        now = jumped
    return now


def between(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """``edges`` as distinct edges between the roots of their ends; ends without a label stand for themselves."""
    own = lambda c: labels.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}"))
    ends = edges.join(own("a"), "a", "left").join(own("b"), "b", "left").select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b"))
    return ends.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def extend_components(spark: SparkSession, labels: DataFrame | None, edges: DataFrame) -> DataFrame | None:
    """``labels(node, root)`` of components, None for none, with ``edges(a long, b long)`` added.

    The root is a component's least node; nodes without an edge to another node are left out.
    Each round works on the edges between roots alone and writes them to the shared folder; a
    node's neighbours are never gathered in one row, so a component that holds
    a third of all nodes is spread like any other.
    """
    none = spark.createDataFrame([], "node long, root long")
    open_ = stage(spark, between(edges, none if labels is None else labels), "cc")
    moves = None
    while not open_.isEmpty():
        hooks = hooked(spark, open_)
        rest = stage(spark, between(open_, hooks), "cc")
        if moves is None:
            moves = hooks
        else:
            target = hooks.select(F.col("node").alias("root"), F.col("root").alias("next"))
            moved = stage(spark, moves.join(target, "root", "left").select("node", F.coalesce("next", "root").alias("root")), "moves")
            drop_stage(spark, moves)
            drop_stage(spark, hooks)
            moves = moved
        drop_stage(spark, open_)
        open_ = rest
    drop_stage(spark, open_)
    if labels is None or moves is None:
        return moves if labels is None else labels
    target = moves.select(F.col("node").alias("root"), F.col("root").alias("next"))
    old = labels.join(target, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
    out = stage(spark, old.unionByName(moves.join(labels, "node", "left_anti")), "labels")
    drop_stage(spark, moves)
    drop_stage(spark, labels)
    return out


def connected_components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """``edges(a long, b long)`` to ``(node, root)``: the least node of each component; nodes without edges are left out."""
    found = extend_components(spark, None, edges)
    return spark.createDataFrame([], "node long, root long") if found is None else found
