"""Connected components by contraction, with DataFrame joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from helixspan.session import hand_over


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node of an edge; the component is its smallest node.

    Every node points to its smallest neighbour, pointers are followed to their roots by
    doubling, and the edges are contracted to the roots. Each pass at least halves the
    nodes that are left in a component, and a star is gone after one. Hot nodes meet only
    in a minimum that is pre-aggregated and in joins that AQE can split. Edges with a null
    end and loops are ignored.
    """
    pair = edges.select(F.col(a).alias("a"), F.col(b).alias("b"))
    live = hand_over(ordered(pair), "edges")
    labels = None
    while not live.isEmpty():
        both = live.unionByName(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("other"))
        roots = to_roots(least.select("node", F.least("node", "other").alias("parent")))
        if labels is None:
            labels = roots.select("node", F.col("parent").alias("component"))
        else:
            labels = hand_over(follow(labels, "component", roots), "labels")
        live = hand_over(ordered(follow(follow(live, "a", roots), "b", roots)), "edges")
    if labels is None:
        kind = pair.schema["a"].dataType
        return pair.select(F.col("a").alias("node"), F.col("a").cast(kind).alias("component")).limit(0)
    return labels


def ordered(pair: DataFrame) -> DataFrame:
    return (
        pair.where(F.col("a") != F.col("b"))
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )


def follow(df: DataFrame, column: str, pointers: DataFrame) -> DataFrame:
    """``column`` replaced by what it points to; stays where there is no pointer."""
    to = pointers.select(F.col("node").alias("_node"), F.col("parent").alias("_parent"))
    joined = df.join(to, F.col(column) == F.col("_node"), "left")
    return joined.select(
        *[
            F.coalesce("_parent", column).alias(column) if c == column else F.col(c)
            for c in df.columns
        ]
    )


def to_roots(pointers: DataFrame) -> DataFrame:
    """Pointers (node, parent) followed until nothing changes; parents never exceed nodes."""
    now = hand_over(pointers, "pointers")
    while True:
        to = now.select(F.col("node").alias("_node"), F.col("parent").alias("_parent"))
        jumped = now.join(to, F.col("parent") == F.col("_node"), "left").select(
            "node",
            F.coalesce("_parent", "parent").alias("parent"),
            (F.col("_parent") != F.col("parent")).alias("moved"),
        )
        now = hand_over(jumped, "pointers")
        if now.where("moved").isEmpty():
            return now.select("node", "parent")
