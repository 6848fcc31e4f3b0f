"""Connected components of links between integer keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from draftlake.llm.texts import one_row, scratch_table


def _least(pairs: DataFrame, include_self: bool) -> DataFrame:
    least = F.least("u", F.min("v")) if include_self else F.min("v")
    return pairs.groupBy("u").agg(least.alias("m"))


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """(node, component): the least key that a key is linked to, directly or not; keys without links are left out.

    Alternates large and small stars (every neighbour is handed to the least neighbour) until the links form stars; the
    number of rounds grows with the logarithm of the longest chain. No neighbourhood is gathered in one place: a minimum
    per key is aggregated and joined back.
    """
    edges = scratch_table(links.select(F.least(left, right).alias("v"), F.greatest(left, right).alias("u"))
                          .where("u != v").distinct(), "links")
    before = None
    while True:
        both = edges.select("u", "v").union(edges.select(F.col("v"), F.col("u")))
        large = both.join(_least(both, True), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u != v").distinct()
        least = _least(large, False)
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .union(least.select("u", F.col("m").alias("v"))).where("u != v").distinct()
        edges = scratch_table(small.select("v", "u"), "stars")
        now = tuple(one_row(edges, F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))))
        if now == before:
            break
        before = now
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
