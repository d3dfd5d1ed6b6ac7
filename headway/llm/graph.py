"""Connected components of undirected links by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.common import written


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every linked node; the component is its least node.

    Each round takes the least label of all neighbours and then the label of that label, so
    chains shorten by half and more; every round's labels are a written table.
    """
    ends = links.select(F.col(a).alias("node"), F.col(b).alias("other"))
    both = written(ends.unionByName(links.select(F.col(b).alias("node"), F.col(a).alias("other"))).distinct(), "links", slim=True)
    labels = written(both.groupBy("node").agg(F.least("node", F.min("other")).alias("component")), "labels", slim=True)
    while True:
        seen = labels.select(F.col("node").alias("other"), F.col("component").alias("near"))
        near = both.join(seen, "other").groupBy("node").agg(F.min("near").alias("near"))
        closer = labels.join(near, "node").select("node", F.least("component", "near").alias("next"), F.col("component").alias("old"))
        onward = labels.select(F.col("node").alias("next"), F.col("component").alias("further"))
        moved = closer.join(onward, "next").select("node", F.least("next", "further").alias("component"), (F.least("next", "further") != F.col("old")).alias("moved"))
        moved = written(moved, "labels", slim=True)
        labels = moved.select("node", "component")
        if moved.where("moved").isEmpty():
            return labels
