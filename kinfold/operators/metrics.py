"""Decisions and their quality: F0.5 per query, the threshold sweep, slices, and retrieval reports.

Every mean is over all queries of the universe, those without candidates or truth included.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinfold.operators.fuse import fuse
from kinfold.operators.store import saved


def require_scores(scored: DataFrame) -> None:
    """Raises on repeated targets and on scores that aren't probabilities."""
    p = F.col("p")
    row = scored.agg(F.sum((p.isNull() | F.isnan(p) | (p < 0) | (p > 1)).cast("int")).alias("bad")).first()
    if row.bad:
        raise ValueError("Invalid probability")
    if scored.groupBy("q", "t").count().where("count > 1").limit(1).count():
        raise ValueError("Duplicate candidate")


def decide(scored: DataFrame, threshold: float) -> DataFrame:
    return scored.where(F.col("p") >= threshold)


def f05(hit: Column, predicted: Column, true: Column) -> Column:
    size = predicted + 0.25 * true
    return F.when(size == 0, 1.0).otherwise(1.25 * hit / size)


def ceiling(hit: Column, true: Column) -> Column:
    """F0.5 of a perfect choice among the candidates."""
    return F.when(true == 0, 1.0).otherwise(5 * hit / (true + 4 * hit))


def per_query(universe: DataFrame, truth: DataFrame, scored: DataFrame, threshold: float) -> DataFrame:
    """(q, m, candidates, hit, predicted, tp, f05, oracle, complete) of every query."""
    m = truth.groupBy("q").agg(F.count("*").alias("m"))
    flagged = scored.join(truth.select("q", "t", F.lit(1).alias("y")), ["q", "t"], "left").fillna(0, ["y"])
    taken = (F.col("p") >= threshold).cast("int")
    counts = flagged.groupBy("q").agg(F.count("*").alias("candidates"), F.sum("y").alias("hit"), F.sum(taken).alias("predicted"), F.sum(taken * F.col("y")).alias("tp"))
    rows = universe.select("q").join(m, "q", "left").join(counts, "q", "left").fillna(0)
    return rows.withColumns({"f05": f05(F.col("tp"), F.col("predicted"), F.col("m")), "oracle": ceiling(F.col("hit"), F.col("m")), "complete": (F.col("hit") == F.col("m")).cast("int")})


def threshold_curve(universe: DataFrame, truth: DataFrame, scored: DataFrame, steps: int = 1000) -> DataFrame:
    """(tau, score): mean F0.5 at each of the thresholds 0, 1 / steps .. 1, and just past 1.

    A query's F0.5 changes only at its own scores, so each change is put into the one grid cell from
    which on, downwards, it holds; running sums over the grid give every threshold at once.  The
    window at the end runs over the grid's rows, of which there are steps + 2.
    """
    m = universe.select("q").join(truth.groupBy("q").agg(F.count("*").alias("m")), "q", "left").fillna(0)
    flagged = scored.join(truth.select("q", "t", F.lit(1).alias("y")), ["q", "t"], "left").fillna(0, ["y"])
    at = flagged.groupBy("q", "p").agg(F.count("*").alias("c"), F.sum("y").alias("tp")).join(m, "q")
    down = Window.partitionBy("q").orderBy(F.col("p").desc())
    value = f05(F.sum("tp").over(down), F.sum("c").over(down), F.col("m"))
    nothing = F.when(F.col("m") == 0, 1.0).otherwise(0.0)
    moved = at.withColumn("value", value).withColumn("delta", F.col("value") - F.coalesce(F.lag("value").over(down), nothing))
    cell = F.floor(F.col("p") * steps).cast("int")
    cell = F.when(cell / steps > F.col("p"), cell - 1).when((cell + 1) / steps <= F.col("p"), cell + 1).otherwise(cell)
    deltas = moved.groupBy(cell.alias("cell")).agg(F.sum("delta").alias("delta"))
    base = m.agg(F.sum(nothing).alias("base"), F.count("*").alias("n"))
    beyond = math.nextafter(1.0, 2.0)
    grid = universe.sparkSession.range(steps + 2).select(F.col("id").cast("int").alias("cell"), F.when(F.col("id") > steps, beyond).otherwise(F.col("id") / steps).alias("tau"))
    up = Window.orderBy(F.col("cell").desc())
    return grid.join(deltas, "cell", "left").join(F.broadcast(base)).select("tau", ((F.col("base") + F.coalesce(F.sum("delta").over(up), F.lit(0.0))) / F.col("n")).alias("score"))


def threshold_search(universe: DataFrame, truth: DataFrame, scored: DataFrame, steps: int = 1000) -> tuple[float, float]:
    """The largest threshold whose score is within 1e-12 of the best, and its score."""
    require_scores(scored)
    curve = [(r.tau, r.score) for r in threshold_curve(universe, truth, scored, steps).collect()]
    if not curve or curve[0][1] is None:
        raise ValueError("Empty threshold-tuning universe")
    top = max(s for _, s in curve)
    return max((t, s) for t, s in curve if s >= top - 1e-12)


def difficulty_tags(universe: DataFrame, truth: DataFrame, records: DataFrame) -> DataFrame:
    """(q, tag), several rows a query: country, whether it has matches and how many, and what its
    true targets lack or hold."""
    targets = truth.join(records.select(F.col("rid").alias("t"), "missing", (F.col("name.script.indic") > 0).cast("int").alias("indic")), "t")
    true = targets.groupBy("q").agg(F.count("*").alias("m"), F.max("missing").alias("missing"), F.max("indic").alias("indic"))
    rows = universe.select("q").join(records.select(F.col("rid").alias("q"), "country"), "q").join(true, "q", "left").fillna(0, ["m", "missing", "indic"])
    tags = F.array_compact(
        F.array(
            F.concat(F.lit("country:"), F.col("country")),
            F.when(F.col("m") == 0, "singleton").otherwise("non_singleton"),
            F.when(F.col("missing") == 1, "true_vendor_missing_address"),
            F.when(F.col("indic") == 1, "true_vendor_indic"),
            F.when(F.col("m") == 1, "one_match").when(F.col("m") > 1, "many_matches"),
        )
    )
    return rows.select("q", F.explode(tags).alias("tag"))


def evaluate(universe: DataFrame, truth: DataFrame, scored: DataFrame, threshold: float, tags: DataFrame | None = None) -> DataFrame:
    """(tag, n, macro_f05, oracle, pair_recall, complete_recall) for all and for each tag; recalls are
    null where there is nothing to find."""
    rows = per_query(universe, truth, scored, threshold)
    tagged = rows.withColumn("tag", F.lit("all"))
    if tags is not None:
        tagged = tagged.unionByName(rows.join(tags, "q"))
    some = F.col("m") > 0
    return tagged.groupBy("tag").agg(
        F.count("*").alias("n"),
        F.avg("f05").alias("macro_f05"),
        F.avg("oracle").alias("oracle"),
        F.try_divide(F.sum("hit"), F.sum("m")).alias("pair_recall"),
        F.avg(F.when(some, F.col("complete"))).alias("complete_recall"),
    )


def reached(universe: DataFrame, truth: DataFrame, found: DataFrame, alike: DataFrame | None = None) -> DataFrame:
    """(q, m, candidates, hit, oracle) of every query, without scores.  With (q, first) ``alike``, ``found`` is
    what the first of queries that are alike found; it isn't copied to the others, only counted."""
    same = universe.select("q", F.col("q").alias("first")) if alike is None else alike
    own = found.select(F.col("q").alias("first"), "t").distinct()
    m = truth.groupBy("q").agg(F.count("*").alias("m"))
    hit = truth.join(same, "q").join(own, ["first", "t"], "left_semi").groupBy("q").agg(F.count("*").alias("hit"))
    n = same.join(own.groupBy("first").agg(F.count("*").alias("candidates")), "first").select("q", "candidates")
    rows = universe.select("q").join(m, "q", "left").join(n, "q", "left").join(hit, "q", "left").fillna(0)
    return rows.withColumn("oracle", ceiling(F.col("hit"), F.col("m")))


def retrieval_report(universe: DataFrame, truth: DataFrame, candidates: DataFrame, hits: DataFrame, overflow: DataFrame, alike: DataFrame | None = None) -> DataFrame:
    """One row about the candidates of all queries: how many, how far a perfect choice could go before
    and after the cut, and nearest-rank percentiles of how many a query has.  Both are counted in one pass,
    and no table of queries, truth or hits goes through the driver."""
    same = universe.select("q", F.col("q").alias("first")) if alike is None else alike
    flagged = lambda rows, cut, met: rows.select(F.col("q").alias("first"), "t", F.lit(cut).alias("cut"), F.lit(met).alias("met"))
    own = flagged(candidates, 1, 0).unionByName(flagged(hits, 0, 1)).groupBy("first", "t").agg(F.max("cut").alias("cut"), F.max("met").alias("met"))
    own = saved(own)
    n = own.groupBy("first").agg(F.sum("cut").alias("candidates"))
    # millions of hits are few bytes on disk, by which Spark would send them through the driver
    true = truth.join(same.hint("merge"), "q", "left").join(own.hint("merge"), ["first", "t"], "left")
    true = true.groupBy("q").agg(F.count("*").alias("m"), F.sum("cut").alias("hit"), F.sum("met").alias("met"))
    rows = universe.select("q").join(same.hint("merge"), "q", "left").join(n.hint("merge"), "first", "left").join(true.hint("merge"), "q", "left").fillna(0)
    rows = rows.select("m", "candidates", "hit", ceiling(F.col("hit"), F.col("m")).alias("oracle"), ceiling(F.col("met"), F.col("m")).alias("before"))
    many = overflow.join(universe.hint("merge"), "q", "left_semi").agg(F.count("*").alias("exact_overflows"))
    report = rows.agg(
        F.count("*").alias("queries"),
        F.sum("candidates").alias("pairs"),
        F.avg("oracle").alias("oracle"),
        F.avg("candidates").alias("mean_k"),
        *[F.expr(f"percentile_disc({x}) within group (order by candidates)").cast("long").alias(f"p{round(100 * x)}_k") for x in (0.95, 0.99)],
        F.max("candidates").alias("max_k"),
        F.try_divide(F.sum("hit"), F.sum("m")).alias("pair_recall"),
        F.avg("before").alias("precap_oracle"),
    )
    return report.join(F.broadcast(many))


def budget_curve(universe: DataFrame, truth: DataFrame, hits: DataFrame, values: tuple[int, ...] = (5, 10, 20, 40, 60, 100), alike: DataFrame | None = None) -> DataFrame:
    """(k, queries, pairs, oracle, mean_k, max_k, pair_recall) with the candidates cut at each k."""
    out = None
    for k in values:
        rows = reached(universe, truth, saved(fuse(hits, k)), alike)
        one = rows.agg(
            F.lit(k).alias("k"), F.count("*").alias("queries"), F.sum("candidates").alias("pairs"), F.avg("oracle").alias("oracle"), F.avg("candidates").alias("mean_k"),
            F.max("candidates").alias("max_k"), F.try_divide(F.sum("hit"), F.sum("m")).alias("pair_recall"),
        )
        out = one if out is None else out.unionByName(one)
    return out
