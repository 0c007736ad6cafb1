"""Connected components of links between documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daedap.session import materialize


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every end of ``links(a, b)``; the smallest node names it.

    Labels travel along all links and then to the label's own label, until none
    changes. Each round is written to the shared folder. Minima are combined before
    they are shuffled, so a node with very many links is no hot spot.
    """
    both = links.select("a", "b").union(links.select(F.col("b"), F.col("a")))
    edges = materialize(both.filter("a != b").distinct())
    labels = materialize(
        edges.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("component"))
    )
    while True:
        known = labels.select(F.col("node").alias("b"), "component")
        near = (
            edges.join(known, "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("near"))
        )
        hooked = labels.join(near, "node").select(
            "node", F.col("component").alias("old"), F.least("component", "near").alias("hooked")
        )
        above = labels.select(F.col("node").alias("hooked"), F.col("component").alias("above"))
        after = materialize(
            hooked.join(above, "hooked", "left").select(
                "node", "old", F.least("hooked", "above").alias("component")
            )
        )
        labels = after.select("node", "component")
        if after.filter("old != component").isEmpty():
            return labels
