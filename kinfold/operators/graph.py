"""Groups of queries that share targets, the split of groups, and sampling by hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinfold.operators.store import saved

#: Upper bounds, in hundredths, of the splits.
SPLITS = [(60, "fit"), (65, "stop"), (75, "cal_fit"), (80, "cal_select"), (90, "tune"), (100, "final")]


def hashed(c: Column) -> Column:
    """60 bits of a string's md5, as other engines have it too."""
    return F.conv(F.substring(F.md5(c.cast("string").cast("binary")), 1, 15), 16, 10).cast("long")


def query_components(queries: DataFrame, truth: DataFrame, rounds: int = 50) -> DataFrame:
    """(q, component): the smallest q connected with q over shared targets.

    Labels travel from queries to their targets and back as minima, and each round also jumps to the
    label's own label, so chains shorten by half or more.
    """
    labels = saved(queries.select("q", F.col("q").alias("component")))
    for _ in range(rounds):
        of_target = truth.join(labels, "q").groupBy("t").agg(F.min("component").alias("m"))
        heard = truth.join(of_target, "t").groupBy("q").agg(F.min("m").alias("m"))
        merged = labels.join(heard, "q", "left").select("q", F.least("component", F.coalesce("m", "component")).alias("c"), "component")
        jump = merged.select(F.col("q").alias("c"), F.col("c").alias("next"))
        new = saved(merged.join(jump, "c").select("q", F.least("c", "next").alias("component"), (F.least("c", "next") != F.col("component")).alias("changed")))
        labels = new.select("q", "component")
        if not new.where("changed").limit(1).count():
            return labels
    raise RuntimeError("the components did not settle")


def assign_splits(queries: DataFrame, truth: DataFrame) -> DataFrame:
    """(q, component, split): whole components go to one split, by a hash of the component."""
    bucket = hashed(F.col("component")) % 100
    split = F.lit(SPLITS[-1][1])
    for bound, name in reversed(SPLITS[:-1]):
        split = F.when(bucket < bound, F.lit(name)).otherwise(split)
    return query_components(queries, truth).withColumn("split", split)


def select_queries(splits: DataFrame, split: str, limit: int, seed: int = 42) -> DataFrame:
    """The ``limit`` queries of a split with the smallest hashes."""
    order = hashed(F.concat(F.lit(f"{seed}:"), F.col("q").cast("string")))
    return splits.where(F.col("split") == split).select("q", order.alias("h")).orderBy("h", "q").limit(limit).select("q")


def sample_candidates(candidates: DataFrame, truth: DataFrame, hard: int = 5, easy: int = 5, seed: int = 42) -> DataFrame:
    """Candidates for training, with label y: all true ones, the ``hard`` false ones with the highest
    rrf, and ``easy`` more by hash."""
    y = candidates.join(truth.select("q", "t", F.lit(1).alias("y")), ["q", "t"], "left").fillna(0, ["y"])
    best = F.row_number().over(Window.partitionBy("q", "y").orderBy(F.col("rrf").desc(), "t"))
    ranked = y.withColumn("best", best).withColumn("is_hard", F.col("best") <= hard)
    order = hashed(F.concat_ws(":", F.lit(str(seed)), F.col("q").cast("string"), F.col("t").cast("string")))
    drawn = F.row_number().over(Window.partitionBy("q", "y", "is_hard").orderBy(order, "t"))
    return ranked.withColumn("drawn", drawn).where((F.col("y") == 1) | F.col("is_hard") | (F.col("drawn") <= easy)).drop("best", "is_hard", "drawn")


def pair_groups(pairs: DataFrame, splits: DataFrame) -> DataFrame:
    return pairs.join(splits.select("q", "component"), "q")
