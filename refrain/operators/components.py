"""Connected components of a graph given as an edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refrain.session import cut_lineage


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node of the edges (a, b) is connected to.

    Every round takes the smallest root among the neighbours and then follows that root to its own
    root of the round before, which shortens long chains by more than one step per round. A root
    shared by very many nodes is a hot key of that second join; its rows are narrow, and the join
    is an inner one that adaptive execution may split. The labels are cut to reliable storage each
    round, so plans stay short and a lost executor costs one round only. It stops when no label
    moves; there is no limit on rounds.
    """
    # each edge is turned where it is found; a union with the turned edges would find all of them twice
    turned = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    both = cut_lineage(edges.select(F.inline(turned)))
    labels = cut_lineage(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select(
            "node", F.least("node", "low").alias("root")
        )
    )
    while True:
        seen = both.join(labels.select(F.col("node").alias("b"), "root"), "b")
        nearest = seen.groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        hooked = labels.join(nearest, "node").select(
            "node", F.col("root").alias("was"), F.least("root", "near").alias("hook")
        )
        jumped = cut_lineage(
            hooked.join(labels.toDF("hook", "up"), "hook").select("node", "was", F.col("up").alias("root"))
        )
        moved = jumped.filter(F.col("was") != F.col("root")).limit(1).count()
        labels = jumped.select("node", "root")
        if moved == 0:
            return labels
