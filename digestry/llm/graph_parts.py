"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from digestry.session import stage


def are_stars(links: DataFrame) -> bool:
    """Whether every u of the distinct links (u, v), v < u, has one v, which has none of its own: then v is the root."""
    ends = links.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(links.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return not ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 OR up = 1 AND down = 1").limit(1).count()


def components(edges: DataFrame, name: str = "parts") -> DataFrame:
    """(node, root): the smallest node reachable, for every node of `edges` (columns a and b).

    Every round links each node's larger neighbours to its smallest one and then
    its smaller neighbours, which shortens paths as it goes; the number of rounds
    grows with the logarithm of the longest path. A row holds one edge, sums are
    grouped minima that combine before the shuffle, and every round is a written
    table. A node with many neighbours has many rows, never one long row.
    """
    links = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), name)
    while not are_stars(links):
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
        links = stage(lowest.select("u", F.col("m").alias("v")).unionByName(small).distinct(), name)
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
