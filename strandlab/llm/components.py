"""Connected components of a links table by least labels and label jumps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage, unstage


def connected_components(links: DataFrame) -> DataFrame:
    """Staged (id, component, and more) of all ids in ``links`` (a, b); the component is its smallest id.

    Each round takes the least label among neighbours, then the label of that label, so long chains shorten by half.
    Rounds go on until no label changes; every round is a written table, so lost executors cost one round at most."""
    edges = stage(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = stage(edges.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("component")).withColumnRenamed("a", "id"), "labels")
    while True:
        near = edges.join(labels.select(F.col("id").alias("b"), "component"), "b").groupBy("a").agg(F.min("component").alias("near"))
        lower = labels.join(near, labels["id"] == near["a"]).select("id", F.col("component").alias("was"), F.least("component", "near").alias("component"))
        jump = lower.select(F.col("id").alias("component"), F.col("component").alias("further"))
        before, labels = labels, stage(lower.join(jump, "component").select("id", "was", F.least("component", "further").alias("component")), "labels")
        unstage(before)
        if labels.where("was <> component").limit(1).count() == 0:
            unstage(edges)
            return labels
