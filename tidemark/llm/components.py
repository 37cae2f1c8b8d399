"""Connected components of an edge table, without a driver-side graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import staged


def components(edges: DataFrame) -> DataFrame:
    """(v, c): for each end v of an edge (a, b) the smallest vertex c that it reaches.

    Each round takes the smallest label among neighbours for the vertex and for the vertex that is its label (so
    whole trees of labels are hooked to smaller ones, in any order of ids), and then that label's own label (pointer
    jumping). Rounds go on until no label changes: labels only fall, so they end, and then neighbours have one label.
    Labels are written to the shared folder each round. An empty edge table gives an empty one.
    """
    pairs = edges.select("a", "b").filter("a <> b")
    rows = 2 * pairs.count()
    both = staged(pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges", rows)
    labels = staged(both.groupBy(F.col("a").alias("v")).agg(F.least(F.col("v"), F.min("b")).alias("c")), "labels", rows)
    while True:
        near = both.join(labels.select(F.col("v").alias("b"), "c"), "b").groupBy(F.col("a").alias("v")).agg(F.min("c").alias("m"))
        own = F.struct("v", F.least("c", "m").alias("least"), F.col("c").alias("was"))
        root = F.struct(F.col("c").alias("v"), F.col("m").alias("least"), F.lit(None).cast(labels.schema["c"].dataType).alias("was"))
        offers = labels.join(near, "v").select(F.inline(F.array(own, root)))
        hooked = staged(offers.groupBy("v").agg(F.max("was").alias("was"), F.min("least").alias("c")), "hooked", rows)
        # The label's label; every label is a vertex of the table.
        jump = hooked.join(hooked.select(F.col("v").alias("c"), F.col("c").alias("far")), "c")
        after = staged(jump.select("v", "was", F.least("c", "far").alias("c")), "labels", rows)
        if after.filter("c <> was").isEmpty():
            return after.select("v", "c")
        labels = after.select("v", "c")
