"""Connected components of links between ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import store


def _stars(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step over ``u > v``."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = both.where("u > v").join(least, "u").select("u", F.col("m").alias("v"))
    large = large.unionByName(own).where("u > v").distinct()
    least = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return small.unionByName(least.withColumnRenamed("m", "v")).distinct()


def components(links: DataFrame) -> DataFrame:
    """``id, component`` of every id in a link, given links ``a, b``; the component is its least id.

    Alternating star contractions: every round each id hands its neighbours to its least
    neighbour, until all that is left is a star around the least id of each component. Rounds
    are stored, so a lost executor costs one round, and grow with the logarithm of the longest
    chain. Links from an id to itself are left out.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = store(edges.where("u > v").distinct())
    state = None
    while True:
        mark = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if mark == state:
            break
        state = mark
        edges = store(_stars(edges))
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
