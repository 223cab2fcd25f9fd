"""Connected components of a link table, wholly in Spark.

Alternating star contraction: every round links each node's neighbours to the smallest of them, so
long chains halve and a component becomes a star around its smallest node.  Rounds run over joins and
aggregates with map-side combine; nodes with very many links (at most 256 have more than one in 256) are sent to
all tasks rather than joined.  Each round's links are written to the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import met, written

FILE_ROWS = 50_000


def _pointed(both: DataFrame) -> DataFrame:
    """(u, m, n): the smallest of each node's neighbours and itself, and its rows."""
    return both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count(F.lit(1)).alias("n"))


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node that has a link to another one; ``component`` is the smallest node
    that can be reached.  Null ends and links of a node to itself are ignored."""
    edges = (links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
             .where(f"{a} is not null and {b} is not null").where("u <> v").distinct())
    edges = written(edges, "links")
    before, parts, count = None, None, edges.count()
    while True:
        # large star: every larger neighbour points to the node's least neighbour
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (met(both, _pointed(both), "u", "n", 2 * count).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        large = written(large if parts is None else large.coalesce(parts), "large-star")
        # small star: every smaller neighbour, and the node, point to the least neighbour
        least = large.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
        small = (met(large, least, "u", "n", count).select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        edges = written(small if parts is None else small.coalesce(parts), "links")
        state = edges.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first()
        if tuple(state) == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")) \
                .unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        before, count = tuple(state), state[0]
        parts = 1 + state[0] // FILE_ROWS  # about as many as before: few links need few files
