"""Connected components of a graph given as a table of edges."""
from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from lifecorpus.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the component's smallest node.

    Each round takes the smallest label among a node's neighbours and then the label
    of that label, which halves long chains. Every step is a join or an aggregation
    that combines on the map side, so a node with very many edges is no single task.
    Each round is written as a table, once; only a count of changes, observed while
    the round is written, comes to the driver."""
    ways = F.array(F.struct(F.col("a"), F.col("b")), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stored(edges.select(F.inline(ways)).distinct(), "edges")  # the edges' own plan runs once
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.min("a")).alias("root")), "labels")
    while True:
        sent = both.join(labels, both["b"] == labels["node"]).select(F.col("a").alias("node"), "root", F.lit(None).alias("old"))
        met = (sent.unionByName(labels.select("node", "root", F.col("root").alias("old")))
               .groupBy("node").agg(F.min("root").alias("root"), F.max("old").alias("old")))
        up = labels.select(F.col("node").alias("up"), F.col("root").alias("top"))
        changes = Observation()
        new = (met.join(up, met["root"] == up["up"]).select("node", "old", F.least("root", "top").alias("root"))
               .observe(changes, F.count_if(F.col("root") != F.col("old")).alias("n")))
        labels = stored(new, "labels").select("node", "root")
        if not changes.get["n"]:
            return labels
