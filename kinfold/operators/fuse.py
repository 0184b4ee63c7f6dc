"""Reciprocal-rank fusion of channels, with places kept for every channel and source."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: A channel's bit in the mask, and how many targets of a source it may bring.
CHANNELS = {"exact": 0, "char": 1, "rare": 2, "translit": 3, "address": 4, "minhash_name": 5, "minhash_joint": 6}
BUDGETS = {"exact": 20, "char": 20, "rare": 10, "translit": 15, "address": 10, "minhash_name": 10, "minhash_joint": 10}
#: What is added to a rank before it is turned over.
RANK_SHIFT = 60


def _lookup(values: dict[str, int]):
    return F.element_at(F.create_map(*[F.lit(x) for p in values.items() for x in p]), F.col("channel"))


def fuse(hits: DataFrame, k: int = 60, coverage: int = 2) -> DataFrame:
    """(q, t, source, mask, rrf, position) of hits (q, t, source, channel, score).

    A channel's hits in a source are ranked by score, ties by t, and cut at its budget; a target's
    rrf is the sum of 1 / (RANK_SHIFT + rank).  The first ``coverage`` of each channel and source, fewer
    if k is too small for all, have a place; the best of the rest fill up to k.  ``position`` orders
    by rrf, then number of channels, then t.
    """
    group = ["q", "channel", "source"]
    # a query's hits are brought together once, for all that follows
    best = hits.repartition("q").groupBy(*group, "t").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(F.col("score").desc(), "t"))
    ranked = best.withColumn("rank", rank).where(F.col("rank") <= _lookup(BUDGETS))
    per_query = Window.partitionBy("q")
    groups = F.size(F.collect_set(F.struct("channel", "source")).over(per_query))
    ranked = ranked.withColumn("cover", F.least(F.lit(coverage), F.floor(F.lit(k) / groups)))
    fused = ranked.groupBy("q", "t").agg(
        F.first("source").alias("source"),
        F.bit_or(F.call_function("shiftleft", F.lit(1), _lookup(CHANNELS))).alias("mask"),
        F.round(F.sum(1 / (F.lit(RANK_SHIFT) + F.col("rank"))), 12).alias("rrf"),
        F.max((F.col("rank") <= F.col("cover")).cast("int")).alias("reserved"),
    )
    order = per_query.orderBy(F.col("rrf").desc(), F.bit_count("mask").desc(), "t")
    placed = fused.withColumns({"position": F.row_number().over(order), "reserve": F.sum("reserved").over(per_query), "others": F.sum(1 - F.col("reserved")).over(order)})
    return placed.where((F.col("reserved") == 1) | (F.col("others") <= k - F.col("reserve"))).select("q", "t", "source", "mask", "rrf", "position")
