"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import stored


def _sum(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(r)


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, label) for the nodes of ``edges`` (a, b: long); the label is the
    component's smallest node.  Alternates large-star and small-star steps
    until every node points at its component's smallest; each round is stored,
    holds at most as many edges as the input, and the number of rounds grows with
    the logarithm of the size.  The joins are on node, and AQE splits those of
    a hub."""
    e = stored(edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), name)
    before = _sum(e)
    while before[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        e = stored(small, name)
        now = _sum(e)
        if now == before:
            break
        before = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
