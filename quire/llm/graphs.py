"""Connected components by alternating star contraction: nothing is gathered on the driver but one sum for each round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

C.by_value(__name__)


def _star(edges: DataFrame, large: bool, scratch: C.Scratch) -> DataFrame:
    """Tie each node's neighbours (the larger ones, or the smaller ones and itself) to its smallest neighbour.

    The smallest neighbours are a table of their own, so that the join can split a node with very many neighbours.
    """
    both = edges if not large else edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = scratch.keep(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
    tied = both.join(least, "u")
    if large:
        return tied.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
    own = least.where("u <> m").select("u", F.col("m").alias("v"))
    return tied.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(own).distinct()


def components(links: DataFrame, scratch: C.Scratch) -> DataFrame:
    """node, comp for every node of links (a, b) but each component's smallest: comp is that one. Few rounds even for long chains.

    Edges run from the larger node (u) to the smaller (v); at the fixed point each node has one edge, to its component.
    """
    a, b = F.col("a"), F.col("b")
    edges = scratch.keep(links.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    total = None
    while True:
        new = scratch.keep(_star(_star(edges, True, scratch), False, scratch))
        scratch.drop(edges)
        edges = new
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == total:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("comp"))
        total = now
