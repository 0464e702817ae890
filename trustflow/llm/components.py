"""Connected components of a graph given as links, by alternating large-star and small-star steps.

Each step groups by node for its least neighbour and joins that back, so a hub's links are never gathered in one row. In
the large-star step, where hubs have their links, the least neighbours are stored first: as both sides of
the join are plain tables, a hub's partition can be split. In the small-star step a node only has
links to the centres that it is about to leave. Between steps the links are
written to the shared folder. The result does not depend on partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from trustflow.llm import store


def _least(pairs: DataFrame) -> DataFrame:
    """pairs (u, v): for each u the least of itself and its v."""
    return pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return both.join(store.keep(_least(both), "least"), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    least = _least(links)  # every link has u > v here
    moved = links.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """links: two columns of one comparable type, nulls and self-links ignored.
    Returns (node, label): each node of a link, and the least node that it reaches."""
    u, v = F.greatest(a, b), F.least(a, b)
    now = links.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).select(u.alias("u"), v.alias("v"))
    now = store.keep(now.filter("u <> v").distinct(), "links")
    before = None
    while True:
        now = store.keep(_small_star(_large_star(now)).filter("u > v").distinct(), "stars")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == before or not state[0]:
            break
        before = state
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return stars.union(stars.select("label", "label").distinct())
