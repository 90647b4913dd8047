"""Connected components of links, as a distributed union-find on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SMALL_ROWS, cut


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component (the smallest node reachable) for every node of an undirected link list.

    Large-star and small-star rounds (every node's larger neighbours, then its smaller ones, are
    linked to the smallest) until the links are stars. The smallest neighbours are aggregated,
    combined before they are shuffled, and joined back to the links, so that no star is gathered
    in one task: few are broadcast, by the count of links; beyond, Spark splits the join of a hot
    centre. Each round is cut by a checkpoint.

    Links with a null end, links of a node to itself and repeated links change nothing. No
    links: no rows.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    edges = cut(edges.filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v"))).distinct())

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    seen = state(edges)
    while seen[0]:
        hint = F.broadcast if seen[0] <= SMALL_ROWS // 2 else lambda df: df
        ends = edges.select(F.explode(F.array(F.struct(F.col("v").alias("v"), F.col("v").alias("m")), F.struct(F.col("u").alias("v"), F.col("v").alias("m")))).alias("e"))
        least = ends.groupBy(F.col("e.v").alias("v")).agg(F.min("e.m").alias("m"))  # of a node and its neighbours
        large = edges.join(hint(least), "v").select("u", F.col("m").alias("v"))
        near = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(hint(near), "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        edges = cut(small.distinct())
        now = state(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
