"""Connected components by contraction, in Spark tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeline.runtime import materialize


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for links ``(a, b)``: the smallest node reachable from each.

    A round points every node at its smallest neighbour, follows the pointers to
    their ends by doubling, and renames the links by those ends. At least half
    of the nodes go in a round, so the rounds are logarithmic in the nodes.
    Tables are written between the steps: that cuts the lineage, and joins then
    read both sides from a shuffle, where AQE splits a hub's rows. Links with a
    null end are left out; nodes without a link to another node have no row.
    """
    edges = materialize(
        links.where("a <> b").select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct(), "links"
    )
    labels = None
    while not edges.isEmpty():
        both = edges.select(F.col("u").alias("node"), F.col("v").alias("to")).unionByName(
            edges.select(F.col("v").alias("node"), F.col("u").alias("to"))
        )
        ends = materialize(both.groupBy("node").agg(F.least("node", F.min("to")).alias("end")), "parents")
        while True:
            ahead = ends.select(F.col("node").alias("end"), F.col("end").alias("next"))
            jumped = materialize(
                ends.join(ahead, "end").select("node", F.col("next").alias("end"), (F.col("next") < F.col("end")).alias("moved")),
                "parents",
            )
            ends = jumped.drop("moved")
            if jumped.where("moved").isEmpty():
                break
        if labels is None:
            labels = ends
        else:
            renamed = ends.select(F.col("node").alias("end"), F.col("end").alias("later"))
            labels = materialize(
                labels.join(renamed, "end", "left").select("node", F.coalesce("later", "end").alias("end")), "labels"
            )
        left = ends.select(F.col("node").alias("u"), F.col("end").alias("p"))
        right = ends.select(F.col("node").alias("v"), F.col("end").alias("q"))
        edges = materialize(
            edges.join(left, "u").join(right, "v").where("p <> q").select(F.least("p", "q").alias("u"), F.greatest("p", "q").alias("v")).distinct(),
            "links",
        )
    if labels is None:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return labels.select("node", F.col("end").alias("component"))
