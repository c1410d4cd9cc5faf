"""Connected components of an edge table, by passing the smallest label on and jumping along labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapwright.llm.common import staged


def connected(edges: DataFrame, rounds: int = 64) -> DataFrame:
    """node and its component's smallest node, for every node of ``edges`` (a, b).

    A round gives every node the smallest label among its neighbours and then the label of that label, so chains
    shorten at least by half. Labels are aggregated before they are shuffled; a hub costs no more than its edges. Every
    round is stored in the shared folder, which cuts its lineage. It stops when no label changes.
    """
    both = edges.filter("a <> b")
    both = staged(both.select("a", "b").union(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = staged(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near")).select("node", F.least("node", "near").alias("label")), "labels-0")
    for turn in range(1, rounds + 1):
        told = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near"))
        moved = labels.join(told, labels["node"] == told["a"]).select("node", "label", F.least("label", "near").alias("fresh"))
        jump = labels.select(F.col("node").alias("at"), F.col("label").alias("further"))
        moved = moved.join(jump, moved["fresh"] == jump["at"], "left")
        moved = moved.select("node", F.least("fresh", F.coalesce("further", "fresh")).alias("label"), (F.least("fresh", F.coalesce("further", "fresh")) < F.col("label")).alias("changed"))
        moved = staged(moved, f"labels-{turn}")
        labels = moved.select("node", "label")
        if moved.filter("changed").isEmpty():
            return labels
    raise RuntimeError("components did not settle")
