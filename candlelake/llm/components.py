"""Connected components of a graph given by its links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlelake.llm.stages import drop, stage


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (``a, b`` of any orderable type); root is the least node reachable.

    Each round every node takes the least label among its neighbours', then the
    label of its label; rounds end when no label changes. All joins are by
    key, minima combine before they are shuffled, and each round is stored. Links to
    oneself and repeated links do no harm; an empty table gives no rows.
    """
    both = links.select("a", "b").union(links.select("b", "a"))
    arcs = stage(both.where("a is not null and b is not null").distinct().toDF("node", "to"), "arcs", small=True)
    labels = stage(
        arcs.groupBy("node").agg(F.min("to").alias("least")).select("node", F.least("node", "least").alias("label")),
        "labels",
        small=True,
    )
    while True:
        near = arcs.join(labels.select(F.col("node").alias("to"), "label"), "to").groupBy("node").agg(F.min("label").alias("near"))
        lowered = labels.join(near, "node", "left").select(
            "node", F.col("label").alias("old"), F.least("label", F.coalesce("near", "label")).alias("label")
        )
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("beyond"))
        moved = stage(
            lowered.join(jump, "label", "left").select(
                "node", "old", F.least("label", F.coalesce("beyond", "label")).alias("label")
            ),
            "labels",
            small=True,
        )
        done = moved.where("old <> label").isEmpty()
        drop(labels)
        labels = moved.select("node", "label")
        if done:
            drop(arcs)
            return labels.select("node", F.col("label").alias("root"))
