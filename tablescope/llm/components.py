"""Connected components of an edge table, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablescope.session import materialize, materialize_observed


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges`` (columns ``a``,
    ``b``); the component is the smallest node reachable.

    Each round lets every node hook to its smallest neighbour, follows the
    hooks to their ends, and contracts the edges; nodes left with an edge at
    least halve. Every round's tables are written to the checkpoint folder,
    so no lineage grows and a lost executor costs one task. A frequent node
    costs one partial row per task in the aggregation.
    """
    e = materialize(edges.select("a", "b").where(F.col("a") != F.col("b")).distinct())
    label = None
    while True:
        both = e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = materialize(both.groupBy(F.col("a").alias("node"))
                           .agg(F.least(F.min("b"), F.col("a")).alias("to")))
        while True:  # follow hooks: their length halves each time
            far = hook.select(F.col("node").alias("to"), F.col("to").alias("far"))
            step = hook.join(far, "to", "left").select("node", F.coalesce("far", "to").alias("to"),
                                                       (F.coalesce("far", "to") != F.col("to")).alias("moved"))
            step, seen = materialize_observed(step, moved=F.coalesce(F.count_if("moved"), F.lit(0)))
            hook = step.select("node", "to")
            if not seen["moved"]:
                break
        if label is None:
            label = hook.select("node", F.col("to").alias("component"))
        else:
            to = hook.select(F.col("node").alias("component"), "to")
            label = materialize(label.join(to, "component", "left")
                                .select("node", F.coalesce("to", "component").alias("component")))
        ends = [hook.select(F.col("node").alias(c), F.col("to").alias("to_" + c)) for c in "ab"]
        rest = (e.join(ends[0], "a").join(ends[1], "b")
                .where(F.col("to_a") != F.col("to_b"))
                .select(F.col("to_a").alias("a"), F.col("to_b").alias("b")).distinct())
        e, left = materialize_observed(rest, n=F.count(F.lit(1)))
        if not left["n"]:
            return label
