"""Connected components of a large edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glyphmill.sources.scratch import materialize


def _with_least(edges: DataFrame) -> DataFrame:
    """(u, v, m): each edge with the least node among u and all its neighbours."""
    least = edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return edges.join(least.withColumnRenamed("u", "_u"), F.col("u") == F.col("_u")).select("u", "v", "m")


def _summary(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("v", "u"))
    ).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """(node, component): the least node reachable, for every node of ``links`` (u, v).

    Alternating large-star and small-star steps: in a large step each node
    points its larger neighbours at its least one, in a small step the smaller
    ones. The edge list never grows, a chain of n nodes needs some log n rounds,
    and each round is written to the shared folder.
    """
    edges = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
    edges = materialize(edges, "edges", thin=True)
    seen = _summary(edges)
    while seen[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        down = large.where("u <> v").distinct()
        small = _with_least(down).select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        edges = materialize(small.where("u <> v").distinct(), "edges", thin=True)
        now = _summary(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
