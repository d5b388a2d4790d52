"""Connected components of a link table, by joins and counts only.

Large-star and small-star rounds after Kiveris et al., "Connected Components in MapReduce and Beyond"
(2014): every round hangs the neighbours of each node on its smallest one, until nothing changes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lingmill.sources.shared import materialize


def _large_star(links: DataFrame) -> DataFrame:
    """Of each node, the larger neighbours are linked to the smallest of the node and its neighbours."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Of each node, the smaller neighbours and itself are linked to the smallest of them. Here a > b."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node in `links` (a, b): the smallest node that can be reached.

    Links may repeat, run either way or from a node to itself (which gives that node alone nothing); those
    with a NULL end are left out. Minima combine before the shuffle and joins split hot nodes, so a node
    with a third of all links is no obstacle. Each round is written to the shared folder; the rounds
    end when two of them have the same links.
    """
    ends = links.filter("a is not null and b is not null and a != b")
    links = materialize(ends.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        state = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if before == state:
            break
        before = state
        links = materialize(_small_star(_large_star(links)))
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
