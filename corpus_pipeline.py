"""The corpus pipeline: toxic documents go, repeated lines go, one document of each near-duplicate
group stays, sources are mixed to target weights, and what is left is encoded.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again as
the next stage's ``docs``.  All but the last return the columns of ``documents``.  Null and empty
texts, null sources, repeated rows and extra columns go through; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.llm import bpe, lines, mixing, setsketch, toxicity
from kinfold.llm.shared import BLANKS, in_few, remove, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Scores every document by the machine trained on the table's labels; predicted 1 goes."""
    score = toxicity.probability_of(spark, toxicity.machine_from(spark, sf_dir), F.col("text"))
    return docs.select(F.struct(*[f"`{c}`" for c in docs.columns]).alias("row"), score.alias("score")).where("score < 0.5").select("row.*")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines whose key at least 10 of the documents hold go from all of them.  ``n_chars`` follows
    the text.  A document that would have only blanks left keeps its text: such are the members of
    groups of copies, of which the next stage keeps one.  No row goes."""
    names = docs.columns
    inner = docs.select(F.struct(*[f"`{c}`" for c in names]).alias("row"), F.col("text").alias("text"))
    done = lines.drop_frequent_lines(inner)
    cut = (F.col("n_dropped") > 0) & (F.btrim("text", F.lit(BLANKS)) != "")
    row = F.col("row").withField("text", F.when(cut, F.col("text")).otherwise(F.col("row.text")))
    if "n_chars" in names:
        row = row.withField("n_chars", F.when(cut, F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("row.n_chars")))
    return in_few(done.select(row.alias("row")).select("row.*"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by five-word shingles at a similarity of 0.8 or more, the document with
    the smallest doc_id stays.  Rows that repeat a doc_id are told apart by their number in it."""
    kept = setsketch.near_duplicates(docs, words=5, percent=80).where("kept").select("doc_id").distinct()
    stay = docs.join(kept.where("doc_id is not null"), "doc_id", "left_semi")
    first = F.min(F.struct(*[F.col(f"`{c}`") for c in docs.columns])).alias("row")
    one = stay.groupBy("doc_id").agg(first).select("row.*") if has_repeats(docs) else stay
    return in_few(one.unionByName(docs.where("doc_id is null")).select(*[f"`{c}`" for c in docs.columns]))


def has_repeats(docs: DataFrame) -> bool:
    ids = docs.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n"))
    return bool(ids.where("n > 1").limit(1).count())


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources weigh 3, 1, 2, repeating, and share 150 % of all words, none above twice its own; a
    document appears as often as the mix takes it."""
    names = docs.columns
    inner = docs.select(F.struct(*[f"`{c}`" for c in names]).alias("row"), "doc_id", "source", "text")
    return mixing.mix(inner, [3, 1, 2], share=1.5, most=2).select("row.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, and digests of the ids and of the bytes they decode to."""
    import public_tokenizers

    found = bpe.digests(docs.select("doc_id", "text"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return found.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("mix", mix_sources),
    ("encode", encode),
]

#: The trained machine, the hashes of the mix and the merges of the vocabulary are not SQL; the
#: stages are tested against brute force in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder, read again, and removed when
    the session ends or its successor is written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for at, (_, stage) in enumerate(STAGES[:-1]):
        before, docs = docs, written(stage(spark, docs, sf_dir))
        if at:
            remove(before)
    return STAGES[-1][1](spark, docs, sf_dir)
