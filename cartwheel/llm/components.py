"""Connected components of a link table, by rounds of joins (nothing is collected)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import discard, written

MOST_ROUNDS = 200


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node in ``edges`` (a, b): the smallest node that links reach.

    Every round each node takes the smallest label among its neighbours, hands
    it to the node its own label names, and then jumps to its label's label.
    Nulls and self links are left out. Labels of a hub's neighbours meet in
    partial minima first, and the joins read plain written tables, so adaptive
    execution can split a hub.
    """
    clean = edges.where("a is not null and b is not null and a <> b")
    both = written(clean.select("a", "b").union(clean.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = written(both.groupBy("a").agg(F.min("b").alias("least")).select(
        F.col("a").alias("node"), F.least("a", "least").alias("label")), "labels")
    for _ in range(MOST_ROUNDS):
        near = (both.join(labels.select(F.col("node").alias("b"), "label"), "b")
                .groupBy("a").agg(F.min("label").alias("near")))
        told = (labels.join(near, labels["node"] == near["a"])
                .select(F.explode(F.array(F.col("node"), F.col("label"))).alias("to"), "near")
                .groupBy("to").agg(F.min("near").alias("offer")))
        hooked = written(labels.join(told, labels["node"] == told["to"], "left").select(
            "node", F.col("label").alias("old"), F.least("label", "offer").alias("label")), "hooked")
        up = hooked.select(F.col("node").alias("up"), F.col("label").alias("up_label"))
        jumped = written(hooked.join(up, hooked["label"] == up["up"], "left").select(
            "node", "old", F.least("label", "up_label").alias("label")), "labels")
        discard(hooked)
        discard(labels)
        changed = jumped.where("label <> old").limit(1).count()
        kept = jumped.select("node", "label")
        kept._written_at = jumped._written_at
        labels = kept
        if not changed:
            discard(both)
            return labels.select("node", F.col("label").alias("component"))
    raise RuntimeError("the components didn't settle")
