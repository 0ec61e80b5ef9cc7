"""Connected components by least neighbours and pointer jumping, each round a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxseries.llm.common import Stages


def components(stages: Stages, edges: DataFrame) -> DataFrame:
    """(node, label) of every node of `edges` (x, y): the smallest node it can reach. The driver sees one count a round.

    A round takes the least label among neighbours, then the label of that label; chains halve, stars take two rounds.
    """
    both = stages.write(edges.select("x", "y").union(edges.select(F.col("y"), F.col("x"))), "edges")
    labels = stages.write(both.groupBy("x").agg(F.least(F.col("x"), F.min("y")).alias("label"))
                          .withColumnRenamed("x", "node"), "labels")
    while True:
        around = both.join(labels, both["y"] == labels["node"]).groupBy("x").agg(F.min("label").alias("near"))
        nearer = stages.write(labels.join(around, labels["node"] == around["x"]).select(
            "node", "label", F.least("label", "near").alias("next")), "nearer")
        target = nearer.select(F.col("node").alias("at"), F.col("next").alias("jump"))
        moved = stages.write(nearer.join(target, nearer["next"] == target["at"]).select(
            "node", F.col("jump").alias("label"), (F.col("jump") != F.col("label")).alias("changed")), "moved")
        stages.drop(labels, nearer)
        if not moved.filter("changed").limit(1).count():
            stages.drop(both)
            return moved.select("node", "label")
        labels = stages.write(moved.select("node", "label"), "labels")
        stages.drop(moved)
