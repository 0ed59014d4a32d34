"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendlake.shared import materialize


def components(edges: DataFrame) -> DataFrame:
    """node, root: the smallest node reachable, for every node that has an edge (columns a, b).

    Large and small stars in turn: every node's larger neighbours are linked to the least neighbour, then the
    smaller ones, until each component is a star. A round is two group-wise minima and joins, stored in
    the shared folder; rounds grow with the logarithm of the longest path.
    """

    def state(table: DataFrame):
        return table.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()

    def star(table: DataFrame, both: bool) -> DataFrame:
        """Links neighbours to the least of a node's neighbours and itself; a > b holds before and after."""
        pairs = table.select(F.col("a").alias("n"), F.col("b").alias("m"))
        if both:
            pairs = pairs.union(table.select("b", "a"))
        least = pairs.groupBy("n").agg(F.least(F.min("m"), F.col("n")).alias("low"))
        linked = pairs.join(least, "n")
        if both:
            return linked.where("m > n").select(F.col("m").alias("a"), F.col("low").alias("b")).distinct()
        out = linked.select(F.col("m").alias("a"), F.col("low").alias("b")).union(
            least.select(F.col("n").alias("a"), F.col("low").alias("b"))
        )
        return out.where("a > b").distinct()

    current = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()
    current = materialize(current, "edges")
    before = state(current)
    while True:
        current = materialize(star(current, True), "large-star")
        current = materialize(star(current, False), "small-star")
        now = state(current)
        if now == before:
            break
        before = now
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        current.select(F.col("b"), F.col("b")).distinct()
    )
