"""Connected components of a table of links by alternating large-star and small-star steps.

(Kiveris et al., "Connected Components in MapReduce and Beyond".)  Every step keeps the components
and moves links towards the smallest node; stars stay as they are, which ends the loop.  Each round
is written to the shared folder, so lineage stays short and lost executors cost one round.  Links
never reach the driver, only their count and sums.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.llm.shared import remove, written_in_few


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b): the smallest node it can reach."""
    links = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links, before = written_in_few(links), None
    for _ in range(rounds):
        state = links.agg(F.count("*"), F.sum(F.col("a").cast("decimal(38,0)")), F.sum(F.col("b").cast("decimal(38,0)")), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before, old = state, links
        links = written_in_few(_small_star(_large_star(links)))
        remove(old)
    else:
        raise RuntimeError("the components did not settle")
    stars = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())
