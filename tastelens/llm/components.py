"""Connected components of a large link table by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastelens.session import cut


def _state(links: DataFrame):
    return links.agg(
        F.count(F.lit(1)), F.sum(F.hash("a", "b").cast("decimal(20,0)"))
    ).first()


def connected(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): the smallest node reachable, for every node that has a link.

    Each round hangs every larger neighbour of a node on its smallest neighbour, then every node
    and its smaller neighbours on the smallest of these. Rounds grow with the logarithm of the
    links; no neighbourhood is ever collected, minima are combined before the shuffle, and the
    joins are plain equality joins whose hot keys can be split. Links with a null end and links
    of a node to itself say nothing and are left out.
    """
    high, low = F.greatest(a, b).alias("a"), F.least(a, b).alias("b")
    links = cut(
        links.filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .select(high, low)
        .distinct()
    )
    before = _state(links)
    while before[0]:
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select("a", F.least("a", "m").alias("m"))
        larger = both.filter(F.col("b") > F.col("a")).join(least, "a")
        large = larger.select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter(F.col("a") != F.col("b")).distinct()
        smallest = large.groupBy("a").agg(F.min("b").alias("m"))
        hung = large.join(smallest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = hung.union(smallest.select("a", F.col("m").alias("b")))
        links = cut(small.filter(F.col("a") != F.col("b")).distinct())
        now = _state(links)
        if now == before:
            break
        before = now
    roots = links.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
