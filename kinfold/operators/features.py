"""The 28 features of a candidate pair.

What depends on one record alone (token sets, numbers, landmarks) is worked out once a record,
before the pairs are joined.  String ratios run in Arrow batches; all else stays in the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.functions.similarity import RATIOS, similarities
from kinfold.functions.text import address_parts, tokens
from kinfold.operators.fuse import CHANNELS
from kinfold.operators.store import saved

#: Record numbers that are sent to all tasks, at most, so that the records of pairs are found without a shuffle.
NAMED = 500_000

#: The features in their order.
FEATURES = [
    "name_exact", "core_exact", "name_ratio", "name_token_set", "translit_ratio", "name_jaccard", "rare_overlap", "legal_equal", "addr_ratio", "addr_jaccard",
    "numeric_overlap", "numeric_conflict", "landmark_overlap", "addr_missing", "name_length_ratio", "country_equal", "cross_script", "indic_fraction", "source3", "channels",
    "retrieved_exact", "retrieved_char", "retrieved_rare", "retrieved_translit", "retrieved_address", "retrieved_minhash_name", "retrieved_minhash_joint", "rrf",
]


def jaccard(a: Column, b: Column) -> Column:
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, 0.0).otherwise(F.size(F.array_intersect(a, b)) / union)


def prepared(records: DataFrame) -> DataFrame:
    """A struct ``r`` of what the features need of each record."""
    parts = records.withColumn("parts", address_parts(F.col("address.corrected")))
    fields = [
        F.col("name.accent_folded").alias("folded"), F.col("name.corrected").alias("corrected"), F.col("name.core").alias("core"), F.col("name.legal").alias("legal"),
        F.col("name.script.indic").alias("indic"), F.col("address.corrected").alias("address"), F.col("address.has").alias("has"), F.array_distinct(tokens(F.col("name.core"))).alias("words"),
        F.col("parts.tokens").alias("address_words"), F.col("parts.numbers").alias("numbers"), F.col("parts.landmarks").alias("landmarks"), F.col("country").alias("country"), F.col("source").alias("source"),
    ]
    return parts.select("rid", F.struct(*fields).alias("r"))


def word_weights(records: DataFrame, table: DataFrame) -> DataFrame:
    """(rid, weights): the idf of each of a record's words.  The join with the idf table, which may be of
    any size, is over the records' words, not over those of the pairs."""
    unseen = table.where("term is null").select(F.col("idf").alias("unseen"))
    words = records.select("rid", F.explode(F.array_distinct(tokens(F.col("name.core")))).alias("term"))
    known = words.join(table.where("term is not null"), "term", "left").join(F.broadcast(unseen))
    return known.groupBy("rid").agg(F.map_from_entries(F.collect_list(F.struct("term", F.coalesce("idf", "unseen").alias("idf")))).alias("weights"))


def rare_overlap(a: Column, b: Column) -> Column:
    """Shared over all idf of two maps from words to idf."""
    total = lambda m: F.aggregate(F.map_values(m), F.lit(0.0), lambda s, x: s + F.coalesce(x, F.lit(0.0)))
    shared = total(F.map_zip_with(a, b, lambda _, x, y: F.when(y.isNotNull(), x)))
    both = F.coalesce(total(a), F.lit(0.0)) + F.coalesce(total(b), F.lit(0.0)) - F.coalesce(shared, F.lit(0.0))
    return F.coalesce(shared, F.lit(0.0)) / F.greatest(both, F.lit(1e-8))


def with_records(candidates: DataFrame, records: DataFrame, table: DataFrame) -> DataFrame:
    """Candidates with the query's struct ``a`` and the target's ``b``; records in no pair are left out first."""
    wanted = saved(candidates.select(F.col("q").alias("rid")).unionByName(candidates.select(F.col("t").alias("rid"))).distinct())
    records = records.join(F.broadcast(wanted) if wanted.count() <= NAMED else wanted, "rid", "left_semi")
    r = prepared(records).join(word_weights(records, table), "rid", "left")
    r = r.select("rid", F.col("r").withField("weights", F.col("weights")).alias("r"))
    queries = r.where("r.source = 1").select(F.col("rid").alias("q"), F.col("r").alias("a"))
    return candidates.join(queries, "q").join(r.where("r.source <> 1").select(F.col("rid").alias("t"), F.col("r").alias("b")), "t")


def pair_features(candidates: DataFrame, records: DataFrame, table: DataFrame, ratios: bool = True) -> DataFrame:
    """(q, t, features...) of candidates (q, t, mask, rrf); without ``ratios``, all but RATIOS."""
    pairs = with_records(candidates.select("q", "t", "mask", "rrf"), records, table)
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    missing = ~F.col("a.has") | ~F.col("b.has")
    longest = F.greatest(F.length("a.core"), F.length("b.core"), F.lit(1))
    any_words = (F.size("a.words") > 0) | (F.size("b.words") > 0)
    both_numbers = (F.size("a.numbers") > 0) & (F.size("b.numbers") > 0)
    made = {
        "name_exact": flag((F.col("a.folded") == F.col("b.folded")) & any_words),
        "core_exact": flag((F.col("a.core") == F.col("b.core")) & any_words),
        "rare_overlap": rare_overlap(F.col("a.weights"), F.col("b.weights")),
        "name_jaccard": jaccard(F.col("a.words"), F.col("b.words")),
        "legal_equal": flag((F.col("a.legal") != "") & (F.col("a.legal") == F.col("b.legal"))),
        "addr_jaccard": F.when(missing, 0.0).otherwise(jaccard(F.col("a.address_words"), F.col("b.address_words"))),
        "numeric_overlap": jaccard(F.col("a.numbers"), F.col("b.numbers")),
        "numeric_conflict": flag(both_numbers & ~F.arrays_overlap("a.numbers", "b.numbers")),
        "landmark_overlap": jaccard(F.col("a.landmarks"), F.col("b.landmarks")),
        "addr_missing": flag(missing),
        "name_length_ratio": F.least(F.length("a.core"), F.length("b.core")) / longest,
        "country_equal": flag((F.col("a.country") != "") & (F.col("a.country") == F.col("b.country"))),
        "cross_script": flag((F.col("a.indic") > 0) != (F.col("b.indic") > 0)),
        "indic_fraction": F.col("b.indic"),
        "source3": flag(F.col("b.source") == 3),
        "channels": F.bit_count("mask").cast("double"),
        **{f"retrieved_{c}": F.shiftright("mask", bit).bitwiseAND(F.lit(1)).cast("double") for c, bit in CHANNELS.items()},
    }
    if ratios:
        address = lambda x: F.when(~missing, F.col(f"{x}.address"))
        measured = similarities(*[F.col(f"{x}.{f}") for f in ("folded", "core", "corrected") for x in "ab"], address("a"), address("b"))
        pairs = pairs.withColumn("ratios", measured)
        made |= {r: F.col(f"ratios.{r}") for r in RATIOS}
    names = [f for f in FEATURES if ratios or f not in RATIOS]
    return pairs.select("q", "t", *[(F.col(n) if n == "rrf" else made[n]).alias(n) for n in names])
