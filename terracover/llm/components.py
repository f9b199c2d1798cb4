"""Connected components of an edge table by least labels and label jumping.

Every round a node takes the least label among itself and its neighbours and then that
label's own label, so paths shrink by more than half; rounds are staged tables in the
shared folder, nothing but a count reaches the driver. Hot nodes are combined map-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terracover.sources.staging import stage


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, label) for the nodes of ``edges`` (a, b); the label is the least node of the component."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stage(both.where("a <> b").distinct(), f"{name}-edges")
    labels = stage(both.groupBy("a").agg(F.min("b").alias("least")).select(
        F.col("a").alias("node"), F.least("a", "least").alias("label")
    ), f"{name}-0")
    turn = 0
    while True:
        turn += 1
        near = (
            both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("least"))
        )
        taken = labels.join(near, F.col("node") == F.col("a"), "left").select(
            "node", "label", F.least("label", F.coalesce("least", "label")).alias("next")
        )
        jump = labels.select(F.col("node").alias("at"), F.col("label").alias("further"))
        moved = stage(taken.join(jump, F.col("next") == F.col("at"), "left").select(
            "node", F.least("next", F.coalesce("further", "next")).alias("label"),
            (F.col("label") != F.least("next", F.coalesce("further", "next"))).alias("moved"),
        ), f"{name}-{turn}")
        labels = moved.select("node", "label")
        if moved.where("moved").isEmpty():
            return labels
