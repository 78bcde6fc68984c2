"""Connected components by label propagation with shortcuts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textspark.plans.lineage import durable
from textspark.plans.skew import heavy_keys, lookup_join
from textspark.plans.union import union_rows


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, component) where component is the smallest node number reachable over `edges(a, b)`.

    Each round takes the smallest label around every node and then jumps to that label's own label, so chains
    shrink by half and more. Labels only ever get smaller, so the rounds end at the fixed point. A label shared by very many nodes is looked up from a broadcast slice.
    """
    both = durable(
        union_rows(edges.select("a", "b"), edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    )
    labels = durable(nodes.select("node", F.col("node").alias("component")))
    while True:
        around = (
            both.join(labels.toDF("b", "_near"), "b").groupBy("a").agg(F.min("_near").alias("_near")).withColumnRenamed("a", "node")
        )
        stepped = labels.join(around, "node", "left").select(
            "node", F.least("component", F.coalesce("_near", "component")).alias("_to"), "component"
        )
        stepped = durable(stepped)
        heavy = heavy_keys(stepped.groupBy("_to").agg(F.count("*").alias("_n")), ["_to"], "_n")
        jump = stepped.select(F.col("node").alias("_to"), F.col("_to").alias("_next"))
        moved = durable(
            lookup_join(stepped, jump, ["_to"], heavy).select(
                "node", F.col("_next").alias("_new"), "component"
            )
        )
        labels = moved.select("node", F.col("_new").alias("component"))
        if moved.filter(F.col("_new") != F.col("component")).isEmpty():
            return labels
