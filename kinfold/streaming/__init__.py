"""Normalising records as they arrive: the batch projection as a streaming query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.operators.records import normalise
from kinfold.sources.tsv import SOURCE_COLUMNS, schema


def arriving_records(spark: SparkSession, folder: str, source: int, rules: dict[str, str] | None = None) -> DataFrame:
    """A stream of records from the TSV files that appear in a folder.  Row numbers need an order of
    all rows, so rid is a hash of the id here."""
    rows = spark.readStream.schema(schema(SOURCE_COLUMNS)).csv(folder, sep="\t", header=True, quote='"', escape='"').fillna("")
    return normalise(rows.withColumn("rid", F.xxhash64("entity_id")), source, rules)
