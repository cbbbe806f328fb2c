"""Connected components of a link table, by alternating large-star and small-star rounds.

Every round is a grouping and a join over the links that are left; a round turns each group of links
into fewer hops to its smallest node, so a chain of n nodes takes about log(n) rounds. Links never
leave the executors; the driver only compares one count and one checksum per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.llm.store import stored


def _joined_low(edges: DataFrame, low: DataFrame) -> DataFrame:
    return edges.join(low, "u")


def _large_star(edges: DataFrame) -> DataFrame:
    """Link the larger neighbours of every node to the smallest of its neighbours and itself."""
    both = edges.union(edges.select(F.col("v"), F.col("u")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return _joined_low(both, low).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link every node and its smaller neighbours to the smallest of those. Links run from large to small."""
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = _joined_low(edges, low).filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(low.select("u", F.col("m").alias("v"))).distinct()


def _checksum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))"), F.expr("sum(xxhash64(v, u) % 1000003)")).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of a link table (u long, v long); root is the smallest node it reaches.

    Loops, repeated links and either direction are fine; no links give no rows.
    """
    edges = stored(links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before, now = None, _checksum(edges)
    while now != before and now[0]:
        edges = stored(_small_star(_large_star(edges)))
        before, now = now, _checksum(edges)
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
