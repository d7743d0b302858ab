"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialize


def _both_ways(links: DataFrame) -> DataFrame:
    return links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(links: DataFrame) -> DataFrame:
    """Every neighbour above a node is linked to the least of the node and its neighbours."""
    both = _both_ways(links)
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")


def _small_star(links: DataFrame) -> DataFrame:
    """A node's smaller neighbours, and itself, are linked to the least of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    rest = down.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return rest.union(least.select("a", F.col("m").alias("b"))).filter("a <> b")


def components(links: DataFrame, most: int = 60) -> DataFrame:
    """(node, component): for each node of the links (a, b) that isn't its component's least node, that node.

    links: two columns a, b of one type; self-links and repeats do no harm.
    """
    now = materialize(links.select("a", "b").filter("a <> b").distinct())
    sign = _sign(now)
    for _ in range(most):
        if not sign[0]:
            break
        now = materialize(_small_star(_large_star(now)).distinct())
        before, sign = sign, _sign(now)
        if sign == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    if sign[0]:
        raise RuntimeError("components did not settle")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component"))


def _sign(links: DataFrame) -> tuple:
    """Equal for equal tables of distinct links."""
    row = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return (row[0], row[1])
