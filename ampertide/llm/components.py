"""Connected components of a graph of links, as joins and groupings over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ampertide.session import materialise


def components(links: DataFrame) -> DataFrame:
    """``id, label``: for every end of a link ``a, b`` the smallest id that it reaches.

    Every round points each node at its smallest neighbour, follows these pointers
    twice, and draws the links anew between the nodes pointed at, until none is left.
    Stars collapse in one round, chains to an eighth. A hub is one row per task after
    map-side grouping. Nothing but the count of links comes to the driver.
    """
    links = links.where("a <> b").select(F.col("a").cast("long"), F.col("b").cast("long"))
    edges = materialise(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = None
    while not edges.isEmpty():
        near = materialise(edges.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("to")), "near")
        for _ in range(2):
            onward = near.select(F.col("id").alias("_id"), F.col("to").alias("_to"))
            near = materialise(near.join(onward, F.col("to") == F.col("_id")).select("id", F.col("_to").alias("to")), "near")
        if labels is None:
            labels = near.select("id", F.col("to").alias("label"))
        else:
            moved = labels.join(near.select(F.col("id").alias("_id"), "to"), F.col("label") == F.col("_id"), "left")
            labels = materialise(moved.select("id", F.coalesce("to", "label").alias("label")), "labels")
        ends = edges.join(near.select(F.col("id").alias("a"), F.col("to").alias("_a")), "a").join(
            near.select(F.col("id").alias("b"), F.col("to").alias("_b")), "b"
        )
        edges = materialise(ends.where("_a <> _b").select(F.col("_a").alias("a"), F.col("_b").alias("b")).distinct(), "edges")
    return labels if labels is not None else edges.select(F.col("a").alias("id"), F.col("b").alias("label"))
