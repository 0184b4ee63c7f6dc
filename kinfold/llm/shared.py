"""What the operators share: the shared folder, written tables, word rules and links.

Temporary tables go to the folder named by ``spark.checkpoint.dir``, which the driver and all
executors can reach; a folder of our own is used only where that setting is missing and the driver
is the only machine (tests).
"""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: The word rule of the contracts: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = "\t\n\x0b\x0c\r "

#: Rows of an Arrow batch that a Python worker turns into objects at once.
SLICE = 500

#: Bytes read for each file written: FILE where there are more than CORE_FILES files a core, else at least LEAST.
FILE, LEAST, CORE_FILES = 2_000_000, 64_000, 2

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        named = spark.sparkContext.getCheckpointDir()
    if named is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="kinfold-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def written(df: DataFrame, partition_by: str | None = None) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back: lineage ends there, and the table
    survives the loss of any executor."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/kinfold-{uuid.uuid4().hex}"
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    atexit.register(_remove, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def in_few(df: DataFrame) -> DataFrame:
    """``df`` in as few partitions as the bytes it reads call for, and never in more than it has.

    For each file on a local disk Hadoop without its native library starts ``chmod`` three times,
    each for a moment a second process with all of the executor's memory, and a small table dealt
    over hundreds of partitions would be as many files.  What Spark can't tell the size of counts as large.
    """
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    read = sum(leaves.apply(i).stats().sizeInBytes() for i in range(leaves.size()))
    spread = min(CORE_FILES * df.sparkSession.sparkContext.defaultParallelism, -(-read // LEAST))
    return df.coalesce(min(max(1, spread, -(-read // FILE)), 2**31 - 1))


def written_in_few(df: DataFrame, partition_by: str | None = None) -> DataFrame:
    return written(in_few(df), partition_by)


def remove(df: DataFrame) -> None:
    """Deletes the files under a table that ``written`` made, once nothing reads it any more."""
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/kinfold-" in path:
            _remove(df.sparkSession, path)


def _remove(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):  # the session may have ended, and its folder with it
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased, all other characters as they are.  ``lower`` is the quick way and right
    where a text has one byte a character."""
    return F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(F.translate(c, _UPPER, _UPPER.lower()))


def text_or_empty(c: Column | str) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def hash64(hex_digits: Column) -> Column:
    """The first 16 hex digits, of an md5 say, as a signed 64-bit number."""
    return F.conv(F.substring(hex_digits, 1, 16), 16, -10).cast("long")


def numbered(rows: DataFrame, key: str) -> DataFrame:
    """``rows``, a written table with a column ``__row`` of monotonically increasing ids, with
    ``__number``: a row's number, from 0, among those of equal ``key``.

    A key may be that of very many rows, so they are numbered in cells, a key's rows from one
    partition of the table before it was written, and cells are laid end to end by their counts.
    """
    cells = rows.withColumn("__part", F.shiftright("__row", 33))
    counts = cells.groupBy(key, "__part").agg(F.count("*").alias("__n"))
    before = Window.partitionBy(key).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("__start", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    at = F.row_number().over(Window.partitionBy(key, "__part").orderBy("__row")) - 1
    return cells.withColumn("__at", at).join(starts, [key, "__part"]).withColumn("__number", F.col("__start") + F.col("__at")).drop("__part", "__at", "__start")


def key_struct(columns: list[str]) -> Column:
    """The columns as one value that can be compared, nulls first."""
    return F.struct(*[x for i, c in enumerate(columns) for x in (F.col(f"`{c}`").isNotNull().alias(f"h{i}"), F.col(f"`{c}`").alias(f"v{i}"))])


def range_bounds(rows: DataFrame, columns: list[str], n: int, drawn: int = 64) -> list[Column]:
    """Bounds that cut the keys of ``n`` rows into about as many equal ranges as there are shuffle
    partitions, from about ``drawn`` distinct keys a range."""
    parts, scale = n_partitions(rows.sparkSession), 1 << 30
    some = rows.select(key_struct(columns).alias("k")).where(F.pmod(F.xxhash64(F.lit(3), "k"), F.lit(scale)) < min(scale, drawn * parts * scale // max(n, 1)))
    keys = sorted((tuple(r.k) for r in some.distinct().collect()), key=lambda k: [(h, v) if h else (h,) for h, v in zip(k[::2], k[1::2], strict=True)])
    types = [rows.schema[c].dataType for c in columns]
    chosen = dict.fromkeys(keys[len(keys) * i // parts] for i in range(1, parts)) if keys else {}
    return [F.struct(*[F.lit(v).cast("boolean" if i % 2 == 0 else types[i // 2]).alias(f"{'hv'[i % 2]}{i // 2}") for i, v in enumerate(k)]) for k in chosen]


def bucket_of(value: Column, bounds: list[Column]) -> Column:
    """How many of the sorted ``bounds`` are at most ``value``, by halves."""
    if not bounds:
        return F.lit(0)
    limits = F.array(*bounds)

    def halve(a: Column, _: Column) -> Column:
        mid = F.shiftright(a["lo"] + a["hi"], 1)
        below = F.coalesce(F.get(limits, mid) <= value, F.lit(False))
        return F.when(a["lo"] >= a["hi"], a).otherwise(F.struct(F.when(below, mid + 1).otherwise(a["lo"]).alias("lo"), F.when(below, a["hi"]).otherwise(mid).alias("hi")))

    steps = F.sequence(F.lit(1), F.lit(len(bounds).bit_length() + 1))
    return F.aggregate(steps, F.struct(F.lit(0).alias("lo"), F.lit(len(bounds)).alias("hi")), halve, lambda a: a["lo"])


def hand_back() -> None:
    """Memory that is free goes back to the system, where the C library (glibc) can do that."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` over a task's batches; what it has freed goes back when the task ends, as its worker lives on."""

    @wraps(run)
    def then_hand_back(batches: Iterator) -> Iterator:
        yield from run(batches)
        hand_back()

    return then_hand_back


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in slices of SLICE rows, so that few texts are Python objects at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            yield batch.slice(at, SLICE)


def n_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
