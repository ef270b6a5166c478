"""Connected components of a table of links, by alternating stars.

Every step is an aggregate taken in part before its shuffle and a join that
adaptive execution can split, so a node with very many links is no one's
burden. Each round is written to the shared folder; links never come to the
driver, only whether a round still changed something.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.llm.common import discard, written


def components(links: DataFrame) -> DataFrame:
    """``id, component`` (the smallest id reachable) for each id in ``links (a, b)``.

    Links may repeat, run either way, or join an id to itself; ids that are only
    joined to themselves, and null ids, are not listed.
    """
    now = written(_ordered(links), "links")
    while True:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
        # Larger neighbours are tied to the smallest one ...
        large = both.join(least, F.col("a") == F.col("n")).filter("b > a").select(F.col("m").alias("a"), "b")
        large = written(_ordered(large), "links")
        # ... and then smaller neighbours and the node itself.
        least = large.groupBy("b").agg(F.min("a").alias("m")).select(F.col("b").alias("n"), "m")
        small = large.join(least, F.col("b") == F.col("n"))
        small = small.select(F.col("m").alias("a"), F.col("a").alias("b")).union(
            least.select(F.col("m").alias("a"), F.col("n").alias("b"))
        )
        small = written(_ordered(small), "links")
        discard(large)
        if _same(now, small):
            discard(now)
            members = small.select(F.col("b").alias("id"), F.col("a").alias("component"))
            return members.union(small.select("a", F.col("a").alias("component")).distinct())
        discard(now)
        now = small


def _ordered(links: DataFrame) -> DataFrame:
    """Distinct links from the smaller to the greater id."""
    return links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct()


def _same(one: DataFrame, two: DataFrame) -> bool:
    sums = [F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))]
    return one.agg(*sums).first() == two.agg(*sums).first()
