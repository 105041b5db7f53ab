"""Connected components of an undirected graph given as links, by large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.session import materialise


def _summary(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first())


def _star(pairs: DataFrame, keep: Column) -> DataFrame:
    """Links each kept neighbour v of u to the smallest of u and its neighbours.

    The smallest is found by a partial aggregation and joined back, so a node that most links
    share is split like any other skewed key.
    """
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    return (
        pairs.filter(keep).join(least, "u")
        .filter(F.col("v") != F.col("m"))
        .select(F.col("m").alias("a"), F.col("v").alias("b")).distinct()
    )


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b); root is the smallest node of its component.

    Each round is written to the shared folder, so a lost executor repeats one round at most.
    Rounds end when the links no longer change; their number grows with the logarithm of the
    longest chain. No links give an empty table.
    """
    a, b = F.col("a"), F.col("b")
    links = materialise(
        links.filter(a != b).select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()
    )
    before = None
    while (now := _summary(links)) != before and now[0]:
        before = now
        both = links.select(a.alias("u"), b.alias("v")).unionByName(links.select(b.alias("u"), a.alias("v")))
        large = materialise(_star(both, F.col("v") > F.col("u")))
        down = large.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        # of the smaller neighbours of u the smallest takes the others and u itself
        hung = down.join(low, "u").filter(F.col("v") != F.col("m")).select(F.col("m").alias("a"), F.col("v").alias("b"))
        links = materialise(hung.unionByName(low.select(F.col("m").alias("a"), F.col("u").alias("b"))).distinct())
    stars = links.select(b.alias("node"), a.alias("root"))
    return stars.unionByName(links.select(a.alias("node"), a.alias("root")).distinct())
