"""Connected components of an edge table, by least labels and pointer jumping."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def least_labels(edges: DataFrame, cut: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(v, label) for every end of an edge (a, b): the least node that can be reached. cut: writes a table and reads it again.

    A round takes the least label of the neighbours, then the label's label; labels only fall, and paths halve, so the rounds
    grow with the logarithm of the longest shortest path in practice. Joins are merged: labels are small as files, so they would be sent to the driver in each round.
    """
    ends = cut(edges.select(F.col("a").alias("v"), F.col("b").alias("w")).union(edges.select("b", "a")).filter("v <> w").distinct())
    labels = cut(ends.groupBy("v").agg(F.least(F.col("v"), F.min("w")).alias("label")))
    while True:  # labels only fall, so this ends
        near = ends.join(labels.withColumnRenamed("v", "w").hint("merge"), "w").groupBy("v").agg(F.min("label").alias("near"))
        lower = labels.join(near.hint("merge"), "v").select("v", "label", F.least("label", "near").alias("l"))
        jump = labels.select(F.col("v").alias("l"), F.col("label").alias("to"))
        after = cut(lower.join(jump.hint("merge"), "l", "left").select("v", F.least("l", "to").alias("label"), (F.least("l", "to") < F.col("label")).alias("fell")))
        labels = after.select("v", "label")
        if not after.filter("fell").head(1):
            return labels
