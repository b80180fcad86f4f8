"""Connected components of a graph that is a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.session import stage


def components(links: DataFrame) -> DataFrame:
    """``(node, label)`` for every node of ``links (a, b)``: the label is the least node of its component.

    Each round every node takes the least label among itself and its neighbours, hands it to the node it was labelled
    with before, and then follows its label once; the number of rounds grows with the logarithm of the longest path.
    Every round is written to the shared folder. Links may repeat, in either direction; no links give no rows.
    """
    both = links.select(F.col("a").alias("node"), F.col("b").alias("near"))
    both = stage(both.union(both.select("near", "node")).distinct(), "links")
    first = both.groupBy("node").agg(F.min("near").alias("least"))
    labels = stage(first.select("node", F.least("node", "least").alias("label"), F.col("node").alias("before")), "labels")
    while labels.where("label <> before").head(1):
        known = labels.select("node", "label")
        near = both.join(known.select(F.col("node").alias("near"), "label"), "near").select("node", "label")
        least = near.groupBy("node").agg(F.min("label").alias("least"))
        told = known.join(least, "node").select("node", "label", F.least("label", "least").alias("least"))
        # What a node learnt also goes to the node that stood for it.
        own = told.select("node", F.col("least").alias("new"), F.col("label").alias("before"))
        roots = told.select(F.col("label").alias("node"), F.col("least").alias("new"), F.lit(None).cast("bigint").alias("before"))
        hooked = stage(own.union(roots).groupBy("node").agg(F.min("new").alias("label"), F.max("before").alias("before")), "hooked")
        jump = hooked.select(F.col("node").alias("label"), F.col("label").alias("further"))
        jumped = hooked.join(jump, "label", "left")
        labels = stage(jumped.select("node", F.coalesce("further", "label").alias("label"), "before"), "labels")
    return labels.select("node", "label")
