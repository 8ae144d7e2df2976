"""Connected components of a table of links, by alternating large-star and small-star steps.

Each step looks at a node's smallest neighbour only, found by a partial aggregation, and hangs the other
neighbours on it, so the hub of a large group costs no more than its links. Every step starts from a
written table; only two numbers, the count and a checksum of the links, come to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from narrata.llm.common import staged


def _smallest(pairs: DataFrame) -> DataFrame:
    """The smallest of each u and its neighbours v."""
    return pairs.groupBy("u").agg(F.min("v").alias("least")).withColumn("least", F.least("u", "least"))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return both.join(_smallest(both), "u").filter("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    hung = down.join(_smallest(down), "u")
    moved = hung.filter("v != least").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return moved.unionByName(hung.select("u", F.col("least").alias("v"))).distinct()


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, component): the smallest node that each linked node reaches. ``links`` has columns u and v."""
    links, before = staged(links.filter("u != v").distinct(), name), None
    while True:
        links = staged(_small_star(_large_star(links)), name)
        state = tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_003)).first())
        if state == before:
            break
        before = state
    hung = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return hung.unionByName(roots).distinct()
