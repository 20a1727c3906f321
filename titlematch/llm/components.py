"""Connected components of links too many for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titlematch.llm.base import staged


def smallest_reachable(edges: DataFrame, repeated: bool = True) -> DataFrame:
    """``edges`` (``a, b``: long) -> ``node, label``: the smallest node each node
    reaches.  Labels go along the edges and then jump to their label's label, so
    the rounds grow with the logarithm of the longest chain.  Neighbours are
    only ever reduced to a minimum (with map-side combine), never gathered.
    Staged edges of which few are repeated (``repeated`` false) are used as they are."""
    both = edges.filter("a <> b").select("a", "b").union(edges.filter("a <> b").select("b", "a")).toDF("node", "other")
    if repeated:
        both = staged(both.distinct(), "links")
    labels = staged(
        both.groupBy("node").agg(F.min("other").alias("_m")).select("node", F.least("node", "_m").alias("label")), "labels"
    )
    while True:
        seen = labels.select(F.col("node").alias("other"), F.col("label").alias("_l"))
        offered = both.join(seen, "other").groupBy("node").agg(F.min("_l").alias("_l"))
        hooked = staged(
            labels.join(offered, "node").select("node", F.least("label", "_l").alias("next"), (F.col("_l") < F.col("label")).alias("moved")),
            "labels",
        )
        if not hooked.filter("moved").limit(1).count():
            return labels
        roots = hooked.select(F.col("node").alias("next"), F.col("next").alias("_r"))
        labels = staged(hooked.join(roots, "next").select("node", F.least("next", "_r").alias("label")), "labels")
