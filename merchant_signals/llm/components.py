"""Connected components of links by alternating large stars and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchant_signals.llm.common import release, staged


def _large_star(e: DataFrame) -> DataFrame:
    """Each node's larger neighbours move to the smallest of the node and its neighbours."""
    both = e.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
        e.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.where(F.col("v") > F.col("u")).join(least, "u").where(F.col("v") != F.col("m"))
            .select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct())


def _small_star(e: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours move to the smallest of them."""
    least = e.groupBy("hi").agg(F.min("lo").alias("m"))
    moved = e.join(least, "hi").where(F.col("lo") != F.col("m")).select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return moved.unionByName(least.select("hi", F.col("m").alias("lo"))).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """links (a, b) -> node, component (the smallest node reachable) of every node that isn't its own component."""
    e = links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()
    e = staged(e, "links")
    while True:
        # a star forest has no node that is both below one and above another
        chained = e.select("lo").join(e.select(F.col("hi").alias("lo")), "lo", "left_semi").limit(1).count()
        twice = 0 if chained else e.groupBy("hi").count().where(F.col("count") > 1).limit(1).count()
        if not chained and not twice:
            return e.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
        before, e = e, staged(_small_star(_large_star(e)), "links")
        release(before)
