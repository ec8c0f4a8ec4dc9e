"""Connected components of an edge table, without bringing edges to the driver."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..session import stored


def components(edges: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable from each id in ``edges``
    (columns a, b).

    Each round takes the smallest label among the neighbours, then the label
    of the label (pointer jumping), so long chains shrink geometrically.
    Labels are written after every round; the same pass counts those that
    changed.
    """
    both = stored(edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "cc-edges")
    labels = stored(both.groupBy("a").agg(F.min("b").alias("m"))
                        .select(F.col("a").alias("id"), F.least("a", "m").alias("component")), "cc-labels")
    while True:
        near = (both.join(labels.withColumnRenamed("id", "b"), "b")
                    .groupBy(F.col("a").alias("id")).agg(F.min("component").alias("m")))
        hooked = (labels.join(near, "id", "left")
                        .select("id", F.col("component").alias("old"), F.least("component", "m").alias("component")))
        jump = labels.select(F.col("id").alias("component"), F.col("component").alias("j"))
        moved = Observation(f"moved-{uuid.uuid4().hex}")
        stepped = (hooked.join(jump, "component", "left").select("id", "old", F.least("component", "j").alias("component"))
                         .observe(moved, F.count_if(F.col("component") != F.col("old")).alias("n")))
        labels = stored(stepped.select("id", "component"), "cc-labels")
        if not moved.get["n"]:
            return labels
