"""TSV sources and sinks, and the checks on outputs."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from kinfold.operators.metrics import decide, require_scores
from kinfold.operators.records import placed, require_none
from kinfold.operators.store import files, remove, write_file

#: The columns of the files.
SOURCE_COLUMNS = ["entity_id", "business_name", "business_address", "country"]
TRUTH_COLUMNS = ["source1_entity_id", "matched_entity_ids"]
CANDIDATE_COLUMNS = ["source1_entity_id", "candidate_entity_ids"]


def schema(columns: list[str]) -> StructType:
    return StructType([StructField(c, StringType()) for c in columns])


def read_tsv(spark: SparkSession, path: str, columns: list[str] = SOURCE_COLUMNS, multi_line: bool = False, places: bool = False) -> DataFrame:
    """Rows of a TSV file with exactly these columns; a reordered header or a ragged row raises when
    it is read.  Empty fields are ''.  Files are read in splits; quoted line breaks need ``multi_line``,
    which reads a file in one task, and are ragged rows without it.  ``places`` adds ``row``, the row's
    place in the file."""
    rows = spark.read.csv(path, schema(columns), sep="\t", header=True, enforceSchema=False, mode="FAILFAST", quote='"', escape='"', encoding="UTF-8", multiLine=multi_line)
    if not places:
        return rows.fillna("")
    block = F.struct(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"))
    return placed(rows.select(*columns, block.alias("block"), F.monotonically_increasing_id().alias("at"))).fillna("", columns)


def outputs(records: DataFrame, scored: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(source1_entity_id, matched_entity_ids) and (source1_entity_id, candidate_entity_ids): one row a
    source-1 record, ids sorted and joined by commas."""
    queries = records.where("source = 1").select(F.col("rid").alias("q"), F.col("eid").alias("source1_entity_id"))
    named = scored.join(records.where("source in (2, 3)").select(F.col("rid").alias("t"), "eid"), "t", "left")

    def listed(rows: DataFrame, name: str) -> DataFrame:
        ids = rows.groupBy("q").agg(F.concat_ws(",", F.sort_array(F.collect_list("eid"))).alias(name))
        return queries.join(ids, "q", "left").fillna("", [name]).select("q", "source1_entity_id", name)

    return listed(decide(named, threshold), TRUTH_COLUMNS[1]), listed(named, CANDIDATE_COLUMNS[1])


def output_violations(records: DataFrame, matches: DataFrame, candidates: DataFrame) -> DataFrame:
    """(check, violations) of the two output tables."""
    ids = lambda c: F.filter(F.split(F.coalesce(F.col(c), F.lit("")), ","), lambda x: x != "")
    m = matches.select(F.col("source1_entity_id").alias("eid"), ids("matched_entity_ids").alias("ms"))
    c = candidates.select(F.col("source1_entity_id").alias("eid"), ids("candidate_entity_ids").alias("cs"))
    both = m.join(c, "eid", "full_outer")
    queries = records.where("source = 1").select("eid")
    targets = records.where("source in (2, 3)").select(F.col("eid").alias("id"))
    count = lambda df, name: df.agg(F.lit(name).alias("check"), F.count("*").alias("violations"))
    twice = lambda x: F.size(F.array_distinct(x)) < F.size(x)
    checks = [
        count(both.where("ms is null or cs is null"), "row in one file only"),
        count(m.groupBy("eid").count().where("count > 1"), "repeated query"),
        count(m.join(queries, "eid", "left_anti"), "unknown query"),
        count(queries.join(m, "eid", "left_anti"), "missing query"),
        count(both.where(twice(F.col("ms")) | twice(F.col("cs"))), "duplicate targets"),
        count(both.where(F.size(F.array_except("ms", "cs")) > 0), "matches outside candidates"),
        count(c.select(F.explode("cs").alias("id")).join(targets, "id", "left_anti"), "unknown or wrong-source target"),
    ]
    return reduce(DataFrame.unionByName, checks)


def write_outputs(records: DataFrame, scored: DataFrame, threshold: float, folder: str) -> list[str]:
    """Writes matching_results.tsv and candidate_pairs.tsv into a folder of any file system; each appears
    whole.  Rows are sorted and written in parts, whose bytes are then strung together."""
    require_scores(scored)
    spark, paths = records.sparkSession, []
    for rows, name, columns in zip(outputs(records, scored, threshold), ("matching_results.tsv", "candidate_pairs.tsv"), (TRUTH_COLUMNS, CANDIDATE_COLUMNS), strict=True):
        parts, path = f"{folder}/.{uuid.uuid4().hex}", f"{folder}/{name}"
        rows.orderBy("q").drop("q").write.csv(parts, sep="\t", header=False, emptyValue="", nullValue="", quote='"', escape='"')
        write_file(spark, path, "\t".join(columns) + "\n", files(spark, parts, "part-"))
        remove(spark, parts)
        paths.append(path)
    return paths


def validate_outputs(spark: SparkSession, records: DataFrame, folder: str) -> None:
    read = lambda name, columns: read_tsv(spark, f"{folder}/{name}", columns)
    require_none(output_violations(records, read("matching_results.tsv", TRUTH_COLUMNS), read("candidate_pairs.tsv", CANDIDATE_COLUMNS)))


def write_pairs(rows: DataFrame, path: str, cap: int = 1_500_000) -> int:
    """Writes a pair table as Parquet, working it out once; more rows than ``cap`` are an error, never
    cut, and leave nothing behind."""
    rows.write.option("compression", "zstd").mode("overwrite").parquet(path)
    try:
        return read_pairs(rows.sparkSession, path, cap).count()
    except MemoryError:
        remove(rows.sparkSession, path)
        raise


def read_pairs(spark: SparkSession, path: str, cap: int = 1_500_000) -> DataFrame:
    """A pair table that ``write_pairs`` wrote; raises if it has more rows than ``cap``."""
    rows = spark.read.parquet(path)
    n = rows.count()
    if n > cap:
        raise MemoryError(f"{n} pairs exceed the cap of {cap}")
    return rows
