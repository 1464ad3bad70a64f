"""Connected components of an edge table, by smallest labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partflow.llm.common import discard
from partflow.session import materialize


def smallest_reachable(edges: DataFrame) -> DataFrame:
    """(id, label) for every end of an edge (a, b): the smallest id it is linked with.

    A round gives every node the smallest label around it and then the label of
    that label, so the rounds are few even on long chains. Every round is a
    table and replaces the one before; nothing is collected but one count.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b").distinct()
    both = materialize(both, "component-edges")
    labels = materialize(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.col("id")).alias("label")), "component-labels")
    while True:
        around = both.join(labels, both["b"] == labels["id"]).groupBy("a").agg(F.min("label").alias("near"))
        near = labels.join(around, labels["id"] == around["a"]).select("id", F.col("label").alias("was"), F.least("label", "near").alias("near"))
        up = labels.select(F.col("id").alias("near"), F.col("label").alias("above"))
        before, labels = labels, materialize(near.join(up, "near").select("id", "was", F.least("near", "above").alias("label")), "component-labels")
        discard(before)
        if not labels.filter(F.col("label") < F.col("was")).limit(1).count():
            discard(both)
            return labels.select("id", "label")
        labels = labels.select("id", "label")
