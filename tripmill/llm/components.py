"""Connected components of an edge table, by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``label``, the smallest node that it reaches, for every node of (a, b) edges.

    Rounds take the smallest label among neighbours, counted before the shuffle, hand it to the node of
    the old label and then take the label's own label, so long paths shrink geometrically. Each round is
    written: no lineage grows.
    """
    both = written(
        edges.where("a <> b").select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e"))
        .select("e.*").distinct(),
        "edges",
    )
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        lower = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        # What a node has found goes to the node that it is labelled with, so whole trees move at once.
        hook = lower.groupBy(F.col("old").alias("node")).agg(F.min("label").alias("hook"))
        lower = lower.join(hook, "node", "left").select("node", "old", F.least("label", F.coalesce("hook", "label")).alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        after = written(
            lower.join(jump, "label", "left").select(
                "node", F.least("label", F.coalesce("further", "label")).alias("label"), "old"
            ),
            "labels",
        )
        labels = after.select("node", "label")
        if after.where(F.col("label") < F.col("old")).isEmpty():
            return labels
