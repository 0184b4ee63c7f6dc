"""Tables and small files in file systems that the driver and all executors share.

Tables that are read more than once are written as Parquet, so that later reads keep column pruning,
pushdown and statistics, lineage ends there, and a lost executor costs nothing.
"""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; one of our own only where that is unset and the driver is the
    only machine."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="kinfold-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def saved(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back; it goes when the session ends."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/kinfold-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    atexit.register(_forget, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def _forget(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):  # the session may have ended, and its folder with it
        remove(spark, path)


def _at(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.exists(p)


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.delete(p, True)


def read_text(spark: SparkSession, path: str) -> str:
    """A small file."""
    fs, p = _at(spark, path)
    stream = fs.open(p)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def write_file(spark: SparkSession, path: str, head: str, parts: Iterable[str] = ()) -> None:
    """``head`` and then the bytes of the files ``parts`` as one file, streamed, which appears at
    ``path`` whole."""
    fs, p = _at(spark, path)
    _, half = _at(spark, f"{path}.{uuid.uuid4().hex}.tmp")
    out = fs.create(half)
    try:
        out.write(bytearray(head.encode()))
        for part in parts:
            source, at = _at(spark, part)
            stream = source.open(at)
            try:
                spark.sparkContext._jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, out, 1 << 20, False)
            finally:
                stream.close()
    finally:
        out.close()
    fs.delete(p, False)
    if not fs.rename(half, p):
        raise OSError(f"cannot write {path}")


def files(spark: SparkSession, folder: str, prefix: str) -> list[str]:
    """The files of a folder that begin with ``prefix``, by name."""
    fs, p = _at(spark, folder)
    return sorted(s.getPath().toString() for s in fs.listStatus(p) if s.getPath().getName().startswith(prefix))
