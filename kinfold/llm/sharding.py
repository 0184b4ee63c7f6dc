"""Shards by jump consistent hashing, in DataFrame functions only.

A key is hashed to 64 bits and walks an increasing sequence of shard numbers (Lamping and Veach,
"A Fast, Minimal Memory, Consistent Hash Algorithm").  The walk doesn't depend on how many shards
there are; the shard is its last stop below that number.  So one walk answers for ``n`` shards and
for ``n + 1``, there is no ring table, and an added shard takes rows only into itself.

Cases: a null key is a key like any other (all such rows share one shard); repeated rows share a
shard and get slots of their own; an empty table gives an empty table; other columns stay, but for
``shard``, ``grown_shard`` and ``slot``, which are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinfold.llm.shared import bucket_of, hash64, key_struct, range_bounds, written

#: The generator of the published algorithm, and the range of its 31-bit draw.
MULTIPLIER = "2862933555777941757"
TWO_64 = "18446744073709551616"
DRAW = 2.0**31


def key_hash(*columns: Column) -> Column:
    """A stable signed 64-bit hash of the key columns: the first half of an md5, which other engines
    have too."""
    parts = [F.coalesce(c.cast("string"), F.lit("\0")) for c in columns]
    return hash64(F.md5(F.concat_ws("\1", *parts).cast("binary")))


def jump_walk(key: Column, n: int) -> Column:
    """Struct (shard, grown): the jump hash of the 64-bit ``key`` among ``n`` and ``n + 1`` shards.

    The generator needs products modulo 2**64; decimal(38) holds them without overflow.
    Every step moves on by at least one, so n + 1 steps always reach the end.
    """
    if n < 1:
        raise ValueError("at least one shard is needed")
    big = lambda x: F.lit(x).cast("decimal(20,0)")

    def draw(k: Column) -> Column:
        return ((k * F.lit(MULTIPLIER).cast("decimal(19,0)") + F.lit(1).cast("decimal(1,0)")) % big(TWO_64)).cast("decimal(20,0)")

    unsigned = F.when(key < 0, key.cast("decimal(20,0)") + big(TWO_64)).otherwise(key).cast("decimal(20,0)")
    start = F.struct(draw(unsigned).alias("k"), F.lit(0).cast("long").alias("j"), F.lit(0).cast("long").alias("shard"), F.lit(0).cast("long").alias("grown"))

    def step(a: Column, _: Column) -> Column:
        high = F.call_function("div", a.k, F.lit("8589934592").cast("decimal(10,0)")).cast("double")
        return F.when(a.j > n, a).otherwise(
            F.struct(
                draw(a.k).alias("k"),
                ((a.j + 1) * (F.lit(DRAW) / (high + 1))).cast("long").alias("j"),
                F.when(a.j < n, a.j).otherwise(a.shard).alias("shard"),
                a.j.alias("grown"),
            )
        )

    return F.aggregate(F.sequence(F.lit(0), F.lit(n)), start, step, lambda a: F.struct(a.shard.cast("int").alias("shard"), a.grown.cast("int").alias("grown")))


def assign_shards(df: DataFrame, keys: list[str], n: int) -> DataFrame:
    """``df`` with ``shard`` and ``grown_shard`` (the shard if one more were there): a projection,
    without any shuffle.  Columns of these names are replaced."""
    walk = df.select(*[F.col(f"`{c}`") for c in df.columns if c not in ("shard", "grown_shard")], jump_walk(key_hash(*[F.col(f"`{k}`") for k in keys]), n).alias("__walk"))
    return walk.withColumns({"shard": F.col("__walk.shard"), "grown_shard": F.col("__walk.grown")}).drop("__walk")


def with_slots(df: DataFrame, order: list[str]) -> DataFrame:
    """Adds ``slot``, gapless from 0 in every ``shard`` in the given order.

    A shard may be far larger than a task, so rows are numbered in cells, a shard's rows from one of
    as many ranges of the order as there are shuffle partitions, and cells are laid end to end by
    their counts.  Rows alike in the order are told apart by a number each, which the table is
    written with, so a cell is bounded however many rows share a key.
    """
    rows = written(df.drop("slot").withColumn("__row", F.monotonically_increasing_id()))
    keys = [*order, "__row"]
    cells = rows.withColumn("__cell", bucket_of(key_struct(keys), range_bounds(rows, keys, rows.count())))
    counts = cells.groupBy("shard", "__cell").agg(F.count("*").alias("__n"))
    before = Window.partitionBy("shard").orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "__cell", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    number = F.row_number().over(Window.partitionBy("shard", "__cell").orderBy(*[F.col(f"`{c}`") for c in keys]))
    return cells.withColumn("__number", number).join(starts, ["shard", "__cell"]).withColumn("slot", F.col("__start") + F.col("__number") - 1).drop("__row", "__cell", "__number", "__start")


def op2_jump_shards(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.encode(F.coalesce("text", F.lit("")), "utf-8")).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    placed = with_slots(assign_shards(rows, ["doc_id"], 8), ["doc_id", "text_crc32", "size"])
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


#: The checksum's table is made by its rule: eight steps of halving with the reversed polynomial.
OP2_SQL = r"""
WITH crc AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(list_concat([i], range(8)), lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c FROM range(256) r(i))),
b AS (SELECT doc_id, strlen(coalesce(text, '')) + 1 AS size, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::BIGINT) AS bytes FROM documents),
c AS (SELECT doc_id, size, xor(list_reduce(list_concat([4294967295::BIGINT], bytes), lambda a, x: xor(t[(xor(a, x) & 255) + 1], a >> 8)), 4294967295::BIGINT) AS text_crc32 FROM b, crc),
w AS (SELECT *, list_reduce(list_concat([{'k': NEXT(KEY), 'j': 0::BIGINT, 'shard': 0, 'grown': 0}], list_transform(range(9), lambda x: {'k': 0::HUGEINT, 'j': 0::BIGINT, 'shard': 0, 'grown': 0})),
  lambda a, x: CASE WHEN a.j > 8 THEN a ELSE {'k': NEXT(a.k), 'j': floor((a.j + 1) * (2147483648.0::DOUBLE / ((a.k // 8589934592)::DOUBLE + 1)))::BIGINT,
    'shard': (CASE WHEN a.j < 8 THEN a.j ELSE a.shard END)::INT, 'grown': a.j::INT} END) AS w FROM c)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'key' AS law, w.shard AS shard, row_number() OVER (PARTITION BY w.shard ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS slot, w.grown AS grown_shard FROM w
""".replace("KEY", "('0x' || substr(md5(doc_id::VARCHAR), 1, 16))::UBIGINT::HUGEINT")
for _k in ("a.k", "('0x' || substr(md5(doc_id::VARCHAR), 1, 16))::UBIGINT::HUGEINT"):
    OP2_SQL = OP2_SQL.replace(f"NEXT({_k})", f"(({_k} * 2862933555777941757 + 1) % 18446744073709551616::HUGEINT)")
