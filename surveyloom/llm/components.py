"""Connected components of a graph that is given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyloom.sources.workspace import written


def star_roots(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links(a, b)`` but the roots; the root is the least node.

    Large and small stars alternate: every node hands its greater neighbours, then its smaller
    ones, to the least node it knows, until all links lead to roots. A round is a map-side combined
    minimum and a join back to it, so a hub with very many neighbours is a skewed join that
    adaptive execution splits, never a collected list. Each round is written to the shared folder
    and ends at a checksum over its links, so nothing but two numbers reaches the driver.
    """
    now = written(
        links.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "links",
    )
    before = None
    while (state := _checksum(now)) != before:
        before = state
        now = written(_small_star(_large_star(now)), "links")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _checksum(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.col("b") % 1009))
    return tuple(row.first())


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy(F.col("a").alias("hub")).agg(F.min("b").alias("m"))
    least = least.select("hub", F.least("hub", "m").alias("m"))
    return (
        both.join(least, F.col("a") == F.col("hub"))
        .where(F.col("b") > F.col("a"))
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy(F.col("a").alias("hub")).agg(F.min("b").alias("m"))
    joined = links.join(least, F.col("a") == F.col("hub"))
    kept = joined.select(F.inline(F.array(
        F.struct(F.col("a").alias("a"), F.col("m").alias("b")),
        F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
    )))
    return kept.where(F.col("a") != F.col("b")).distinct()
