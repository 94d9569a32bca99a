"""Connected components of a graph given as links, by smallest labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """``id, component`` of every end of the links ``a, b``; the component is its smallest id.

    Each round a node takes the smallest label around it, then the label of its label, and the
    labels are written out, which cuts the lineage. Paths shrink by more than half a round. Links of
    a node are never gathered, only their minimum is, and the driver learns only whether anything
    changed. Null ends link nothing.
    """
    ends = links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    both = F.explode(
        F.array(
            F.struct(F.col("a").alias("x"), F.col("b").alias("y")),
            F.struct(F.col("b").alias("x"), F.col("a").alias("y")),
        )
    ).alias("e")
    near = stored(ends.select(both).select("e.x", "e.y").distinct(), "links")
    labels = near.groupBy(F.col("x").alias("id")).agg(F.min("y").alias("least"))
    labels = stored(labels.select("id", F.least("id", "least").alias("label")), "labels")
    while True:
        around = near.join(
            labels.select(F.col("id").alias("y"), F.col("label").alias("seen")), "y"
        ).groupBy(F.col("x").alias("id")).agg(F.min("seen").alias("seen"))
        lower = labels.join(around, "id").select(
            "id", F.col("label").alias("old"), F.least("label", "seen").alias("label")
        )
        above = labels.select(F.col("id").alias("label"), F.col("label").alias("top"))
        labels = stored(
            lower.join(above, "label").select("id", "old", F.least("label", "top").alias("label")),
            "labels",
        )
        if labels.where("label <> old").isEmpty():
            return labels.select("id", F.col("label").alias("component"))
        labels = labels.select("id", "label")
