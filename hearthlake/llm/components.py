"""Connected components of a table of links, on the executors only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthlake.llm.common import checkpointed


def components(links: DataFrame) -> DataFrame:
    """(node, root): every node of the links (a, b) with the smallest node it reaches.

    Alternating large and small stars: each round links a node's larger neighbours, then
    its smaller ones, to the smallest node beside it, until only stars are left; rounds
    grow with the logarithm of the nodes. Neighbours are never gathered: a round is two
    aggregates to a minimum and two joins, whose hot keys adaptive execution may split.
    Each round is checkpointed. No links give an empty result.
    """
    stars = checkpointed(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    seen = _state(stars)
    while seen[0]:
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = checkpointed(moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        last, seen = seen, _state(stars)
        if seen == last:
            break
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        stars.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def _state(stars: DataFrame) -> tuple:
    """Number of links and two sums over them, equal only where a round changed nothing."""
    row = stars.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.sum(F.hash("v", "u").cast("long"))
    ).first()
    return tuple(row)
