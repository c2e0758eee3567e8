"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, stored


def _largest_star(links: DataFrame) -> DataFrame:
    """Tie every larger neighbour of a node to the smallest node around it."""
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _smallest_star(links: DataFrame) -> DataFrame:
    """Tie a node and its smaller neighbours to the smallest of them; links point downwards."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def connected(links: DataFrame) -> DataFrame:
    """Of every linked node the smallest node it can reach: columns node and component.

    ``links`` has columns a and b in any direction; pairs of equal or null nodes are left out.
    Nodes without links have no row. Each round aggregates before it shuffles and joins on
    one key; it stores its links in the shared folder, so a round never depends on
    earlier ones, and the driver sees one count and one sum. A star with very many
    leaves is split by the skew handling of the join.
    """
    rows = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    current = stored(rows.distinct(), "links")
    state = None
    while True:
        step = _smallest_star(_largest_star(current).distinct()).distinct()
        new = stored(step, "links")
        forget(current)
        current = new
        mark = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(mark) == state:
            break
        state = tuple(mark)
    parts = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return parts.union(current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
