"""Connected components of a table of links, by star contraction.

Each round joins every node to the smallest of its neighbours, first from the larger
side, then from the smaller. Rounds are few (about the logarithm of the longest chain),
each is written below the shared folder, and the driver sees two numbers per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenorlake.sources import lineage


def _stars(links: DataFrame, larger: bool) -> DataFrame:
    """Links (u, v), u > v, to links from neighbours to the smallest neighbour of each node."""
    if larger:
        both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        out = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = links.groupBy("u").agg(F.min("v").alias("m"))
        out = links.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.where(F.col("u") > F.col("v")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for nodes that have links; columns a and b, no nulls."""
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct()
    edges = lineage.settled(edges, "links")
    state = None
    while True:
        edges = lineage.settled(_stars(_stars(edges, True), False), "links")
        row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if (row.n, row.h) == state:
            break
        state = (row.n, row.h)
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return lineage.settled(edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots), "components")
