"""Connected components of links, by minimum labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from blotter.llm.common import salted_join, settle


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, label) of every node in ``links``; equal labels: one component.

    Each round takes the least label of a node's neighbours, then that label's
    own label, which halves long paths. Rounds are checkpointed, so nothing is
    recomputed from the start when an executor is lost. A hub's edges and a
    giant component's nodes are spread over salts, so neither meets one task.
    """
    edges = settle(links.select(F.explode(F.array(F.struct(F.col(a).alias("node"), F.col(b).alias("other")),
                                                  F.struct(F.col(b).alias("node"), F.col(a).alias("other")))).alias("e"))
                   .select("e.*").filter("node <> other").distinct())
    labels = settle(edges.groupBy("node").agg(F.least(F.min("other"), F.first("node")).alias("label")))
    while True:
        near = (salted_join(edges, labels.select(F.col("node").alias("other"), "label"), ["other"], F.xxhash64("node"))
                .groupBy("node").agg(F.min("label").alias("near")))
        step = labels.join(near, "node").select("node", F.least("label", "near").alias("label"), F.col("label").alias("was"))
        up = step.select(F.col("node").alias("label"), F.col("label").alias("up"))
        new = settle(salted_join(step, up, ["label"], F.xxhash64("node"), "left").select("node", F.least("label", F.coalesce("up", "label")).alias("label"), "was"))
        if new.filter("label <> was").isEmpty():
            return new.select("node", "label")
        labels = new.select("node", "label")
