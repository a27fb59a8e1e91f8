"""Connected components of links by alternating large-star and small-star steps on DataFrames.

Each step takes the least neighbour of every node (an aggregate with map-side combine), stores it, and joins it back to the
links, a join of stored tables that adaptive execution can split where one node has very many links. Nothing is collected but
a row count."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def merged(found: DataFrame, links: DataFrame) -> DataFrame:
    """found (u, m) after links (u, v) between its components' least nodes are added."""
    more = components(links)
    over = more.select(F.col("u").alias("m"), F.col("m").alias("over"))
    return materialise(found.join(over, "m", "left").select("u", F.coalesce("over", "m").alias("m")).unionByName(more), "components", found.count() + more.count())


def _with_least(e: DataFrame, rows: int) -> DataFrame:
    """e (u, v) with m, the least v of each u."""
    return e.join(materialise(e.groupBy("u").agg(F.min("v").alias("m")), "least", rows), "u")


def components(links: DataFrame) -> DataFrame:
    """links (u, v: longs, any order, repeats allowed) -> (u, m): for every node that isn't the least of its component, that
    least node. Self links and nulls are ignored. links should be a stored table; no step makes more rows than it has."""
    n = links.count()
    e = materialise(links.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links", n)
    while not _stars(e):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both, 2 * n).where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        large = materialise(large.distinct(), "large", n)
        small = _with_least(large, n)
        e = small.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v")))
        e = materialise(e.distinct(), "links", 2 * n)
    return e.select("u", F.col("v").alias("m"))


def _stars(e: DataFrame) -> bool:
    """Whether every node u of the links (u, v), v < u, has one link only, to a node that has none."""
    if not e.groupBy("u").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
        return False
    return e.select("u").join(e.select(F.col("v").alias("u")), "u", "left_semi").isEmpty()
