"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchlake.llm.common import Scratch

#: Links of one partition, at least: a few thousand links in hundreds of files would cost files, not work.
LINKS = 4096


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(scratch: Scratch, links: DataFrame) -> DataFrame:
    """(id, root) for every id of the links (a, b): root is the smallest id reachable.

    Distributed union-find: each step hangs neighbours under the smallest id of their
    neighbourhood, first from larger ids, then from smaller ones, until the links are stars.
    Minima are aggregated before the shuffle and written; they are joined as a plain table, so
    Spark can split the rows of an id with very many links. Partitions follow the number of links.
    """
    edges = scratch.keep(
        links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges"
    )
    before = _digest(edges)
    # No step makes more rows than twice the links; coalescing never makes more partitions than there are.
    parts = max(2, -(-before[0] // LINKS))
    keep = lambda df, name: scratch.keep(df.coalesce(parts), name)
    while before[0]:
        last = edges
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        smallest = keep(both.groupBy("a").agg(F.least("a", F.min("b")).alias("m")), "large-min")
        large = keep(
            both.filter("b > a").join(smallest, "a").select(F.col("m").alias("a"), "b").filter("a <> b").distinct(), "large"
        )
        scratch.drop(last, smallest)
        # Here a < b holds throughout; the small-star step works on the smaller neighbours of b.
        smallest = keep(large.groupBy("b").agg(F.min("a").alias("m")), "small-min")
        lower = large.join(smallest, "b").filter("a <> m").select(F.col("m").alias("a"), F.col("a").alias("b"))
        edges = keep(lower.union(smallest.select(F.col("m").alias("a"), "b")).distinct(), "small")
        scratch.drop(large, smallest)
        now = _digest(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("b").alias("id"), F.col("a").alias("root")).union(
        edges.select(F.col("a").alias("id"), F.col("a").alias("root")).distinct()
    )
