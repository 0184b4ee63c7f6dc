"""Line dedup over levelled sorted runs of line hashes.

A run is a table of (k1, k2, n): the 128-bit hash of a line's key and the documents that hold it,
sorted by hash.  A batch of documents first merge-anti-joins the runs of lines already known to be
frequent, whose count no longer matters, and adds what is left as a new run of level 0.  When a
level has ``fanout`` runs they are compacted into one of the next level by summing equal hashes;
those that have come to ``min_docs`` move to the frequent runs.  So a line is rewritten once a
level, however many batches come.

A line's key is the line without ASCII white space at its ends, A-Z lower-cased.

Cases: a null or empty text is one empty line; an empty key is never counted or dropped; each row
counts as a document, so repeated rows count each; an empty table gives an empty table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.llm.shared import BLANKS, ascii_lower, in_few, remove, text_or_empty, written, written_in_few

KEY = ["k1", "k2"]


def split_lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_hashes(text: Column) -> Column:
    """For each line the struct (k1, k2), a 128-bit hash of its key, null for an empty key."""

    def hashed(line: Column) -> Column:
        key = F.btrim(line, F.lit(BLANKS))
        return F.when(key != "", F.struct(F.xxhash64(F.lit(1), key).alias("k1"), F.xxhash64(F.lit(2), key).alias("k2")))

    return F.transform(split_lines(ascii_lower(text)), hashed)


def text_hash(text: Column) -> list[Column]:
    return [F.xxhash64(F.lit(3), text).alias("t1"), F.xxhash64(F.lit(4), text).alias("t2")]


class LineRuns:
    """Levelled sorted runs in the shared folder."""

    def __init__(self, min_docs: int, fanout: int = 4):
        self.min_docs, self.fanout = min_docs, fanout
        self.levels: list[list[DataFrame]] = []
        self.known: list[DataFrame] = []

    @staticmethod
    def _merged(runs: list[DataFrame]) -> DataFrame:
        return reduce(DataFrame.unionByName, runs).groupBy(*KEY).agg(F.sum("n").alias("n"))

    @staticmethod
    def _run(df: DataFrame) -> DataFrame:
        return written(in_few(df).sortWithinPartitions(*KEY))

    def add(self, batch: DataFrame) -> None:
        """``batch`` has a column ``keys``, one array of line hashes a document."""
        lines = batch.select(F.explode(F.array_distinct("keys")).alias("k")).where("k is not null").select("k.k1", "k.k2")
        # counted and written before the anti-join, which would otherwise go below the count and meet a
        # common line once for each document
        run = self._run(lines.groupBy(*KEY).agg(F.count("*").alias("n")))
        for known in self.known:
            rest = self._run(run.join(known.hint("merge"), KEY, "left_anti"))
            remove(run)
            run = rest
        self._add_run(0, run)

    def _add_run(self, level: int, run: DataFrame) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) == self.fanout:
            runs, self.levels[level] = self.levels[level], []
            merged = self._run(self._merged(runs))
            for old in runs:
                remove(old)
            self.known.append(self._run(merged.where(F.col("n") >= self.min_docs).select(*KEY)))
            self._add_run(level + 1, self._run(merged.where(F.col("n") < self.min_docs)))
            remove(merged)

    def frequent(self) -> DataFrame:
        """The hashes of lines that at least ``min_docs`` documents hold.  A run of known lines was
        never counted again, so the parts are disjoint."""
        runs = [r for level in self.levels for r in level]
        rest = [self._merged(runs).where(F.col("n") >= self.min_docs).select(*KEY)] if runs else []
        return reduce(DataFrame.unionByName, self.known + rest)


def dropped_positions(docs: DataFrame, min_docs: int, batches: int, fanout: int) -> DataFrame:
    """(t1, t2, dropped): the places of a text's frequent lines, for texts that have some.

    They depend on the text alone, so texts are named by a 128-bit hash; copies of a text collapse
    before the shuffle.
    """
    text = text_or_empty("text")
    hashes = written_in_few(docs.select(*text_hash(text), line_hashes(text).alias("keys")).withColumn("batch", F.pmod("t1", F.lit(batches)).cast("int")), "batch")
    runs = LineRuns(min_docs, fanout)
    for batch in range(batches):
        runs.add(hashes.where(F.col("batch") == batch))
    frequent = written_in_few(runs.frequent())
    places = hashes.select("t1", "t2", F.posexplode("keys").alias("place", "k")).where("k is not null").select("t1", "t2", "place", "k.k1", "k.k2")
    return written_in_few(places.join(frequent, KEY, "left_semi").groupBy("t1", "t2").agg(F.collect_set("place").alias("dropped")))


def drop_frequent_lines(docs: DataFrame, min_docs: int = 10, batches: int = 6, fanout: int = 4) -> DataFrame:
    """``docs`` with the lines of ``text`` dropped whose key at least ``min_docs`` documents hold;
    adds ``n_lines`` (before) and ``n_dropped``.  A null text with nothing dropped stays null."""
    dropped = dropped_positions(docs, min_docs, batches, fanout)
    text = text_or_empty("text")
    names = [F.col(f"`{c}`") for c in docs.columns if c not in ("n_lines", "n_dropped")]
    rows = docs.select(F.struct(*names).alias("row"), *text_hash(text))
    lines = split_lines(text_or_empty("row.text"))
    places = F.sequence(F.lit(0), F.size(lines) - 1)
    kept = F.array_join(F.transform(F.array_except(places, F.col("dropped")), lambda i: F.get(lines, i)), "\n")
    joined = rows.join(dropped, ["t1", "t2"], "left")
    return joined.select(
        F.col("row").withField("text", F.when(F.col("dropped").isNull(), F.col("row.text")).otherwise(kept)).alias("row"),
        F.size(lines).cast("long").alias("n_lines"),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
    ).select("row.*", "n_lines", "n_dropped")


def op4_levelled_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return drop_frequent_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode(text_or_empty("text"), "utf-8"), 256).alias("kept_sha256"))


OP4_SQL = r"""
WITH lines AS (
  SELECT doc_id, line, place, lower_key AS key FROM (
    SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS place,
           unnest(list_transform(l, lambda x: regexp_replace(regexp_replace(translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''))) AS lower_key
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents))),
frequent AS (SELECT key FROM lines WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(f.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE f.key IS NULL), '')) AS kept_sha256
FROM lines LEFT JOIN frequent f USING (key) GROUP BY doc_id
"""
