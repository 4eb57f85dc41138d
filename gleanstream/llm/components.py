"""Connected components by min-label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanstream.llm import tables


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of the links (a, b); label is the smallest node reachable.

    Each step takes the smallest label among a node's neighbours, then the label of that
    label, so a chain of n nodes needs about log n steps. Labels live in a stored table;
    the driver sees only how many changed.
    """
    both = tables.stored(
        edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        .filter("a <> b").distinct(), "links")
    labels = tables.stored(both.groupBy(F.col("a").alias("node")).agg(
        F.least(F.col("node"), F.min("b")).alias("label")), "labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(
            F.min("label").alias("near"))
        lower = labels.join(near, F.col("node") == F.col("a")).select(
            "node", F.col("label").alias("was"), F.least("label", "near").alias("label"))
        beyond = labels.select(F.col("node").alias("label"), F.col("label").alias("beyond"))
        moved = tables.stored(lower.join(beyond, "label", "left").select(
            "node", F.least("label", "beyond").alias("label"),
            (F.least("label", "beyond") < F.col("was")).alias("changed")), "labels")
        labels = moved.select("node", "label")
        if moved.filter("changed").isEmpty():
            return labels
