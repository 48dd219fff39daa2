"""Connected components of a link table by contraction, without a driver-side graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilake.session import materialise


def components(links: DataFrame, jumps: int = 3) -> DataFrame:
    """(node, component) of every node that has a link; the component is its smallest node.

    Each round hangs a node under its smallest smaller neighbour, follows those pointers a few times, and
    replaces the ends of all links by where they point. Links inside one group vanish, so the table shrinks
    from round to round; a star of any size is gone after one. Rounds are written, not kept in lineage.
    """
    pairs = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct()
    pairs = materialise(pairs, "links")
    found = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("component", F.col("node"))
    while not pairs.isEmpty():
        up = pairs.groupBy(F.col("b").alias("child")).agg(F.min("a").alias("parent"))
        for _ in range(jumps):
            above = up.select(F.col("child").alias("parent"), F.col("parent").alias("_higher"))
            up = up.join(above, "parent", "left").select("child", F.coalesce("_higher", "parent").alias("parent"))
        up = materialise(up, "parents")
        found = materialise(
            found.join(up, F.col("component") == F.col("child"), "left").select("node", F.coalesce("parent", "component").alias("component")), "found"
        )
        ends = pairs
        for end in ("a", "b"):
            to = up.select(F.col("child").alias(end), F.col("parent").alias("_to"))
            ends = ends.join(to, end, "left").withColumn(end, F.coalesce("_to", end)).drop("_to")
        ends = ends.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        pairs = materialise(ends.filter("a < b").distinct(), "links")
    return found
