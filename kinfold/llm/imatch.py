"""I-Match fingerprints in DataFrame functions only.

Terms are the distinct words of a text.  The document frequency of every word is counted over all
documents; the words within a band of inverse document frequency form the lexicon.  A fingerprint
keeps a text's terms in the lexicon, distinct and sorted, and hashes those in each of several
randomised subsets of the lexicon.  A subset draws every word with probability 1 / 16 by a hash of
its own, so subsets overlap.  Equal term sets give equal hashes; the likeness of two fingerprints is
the share of subsets, among those that hold terms of either text, on which both agree.

The band bounds the lexicon: a word of it is in RARE of all documents, so there are at most 1 / RARE
times as many as a document has distinct words on average, however large the table is.  It travels as
a literal.

A text without terms in the lexicon is known by one hash of all its terms instead, so short texts
don't collapse into one fingerprint.

Cases: a null text counts as empty; an empty text has the fingerprint of no terms; repeated rows
count as documents each; the next document of the last is the first; a single one is its own next;
rows that share a doc_id follow by a hash of their texts, rows without one come last; an empty table
gives an empty table; columns beside doc_id and text don't come through, whatever their names.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinfold.llm.shared import WORD, ascii_lower, bucket_of, key_struct, range_bounds, text_or_empty

#: Lexicon subsets.
SUBSETS = 32
#: The band: a term is kept if it is in this share of all documents (idf = -log of the share).
RARE, COMMON = 0.02, 0.06
#: A band of the document frequency is cut from below at this many documents at least.
FEWEST = 2
#: What stands for a subset that holds none of a text's terms.
NONE = "-"


def words_of(text: Column) -> Column:
    """A text's words, repeats included."""
    return F.regexp_extract_all(ascii_lower(text), F.lit(f"({WORD})"), F.lit(1))


def lexicon(docs: DataFrame, column: str = "text") -> list[str]:
    """The words within the band, sorted by their bytes."""
    words = docs.select(F.explode(F.array_distinct(words_of(text_or_empty(column)))).alias("word"))
    n = docs.count()
    kept = words.groupBy("word").agg(F.count("*").alias("df")).where((F.col("df") >= max(FEWEST, RARE * n)) & (F.col("df") <= max(FEWEST, COMMON * n)))
    return sorted((r["word"] for r in kept.select("word").collect()), key=lambda w: w.encode())


def in_subset(k: int, word: str) -> bool:
    return hashlib.md5(f"{k} {word}".encode()).hexdigest()[0] == "0"


def literal(words: list[str]) -> Column:
    """An array literal; words hold no blanks."""
    return F.split(F.lit(" ".join(words)), " ")


def digest(words: Column) -> Column:
    return F.substring(F.md5(F.array_join(words, " ").cast("binary")), 1, 8)


def fingerprint(text: Column, known: list[str]) -> Column:
    """SUBSETS hashes joined by dots, NONE where a subset holds none of the text's terms."""
    subsets = F.array(*[literal([w for w in known if in_subset(k, w)]) for k in range(SUBSETS)])

    def hashes(words: Column) -> Column:
        def of(kept: Column) -> Column:
            each = F.transform(subsets, lambda s: F.array_intersect(s, kept))  # in the order of s, so sorted
            parts = F.transform(each, lambda x: F.when(F.size(x) > 0, digest(x)).otherwise(NONE))
            alone = F.concat(F.array(digest(F.array_sort(F.array_distinct(words)))), F.array_repeat(F.lit(NONE), SUBSETS - 1))
            return F.array_join(F.when(F.size(kept) > 0, parts).otherwise(alone), ".")

        return F.get(F.transform(F.array(F.array_intersect(literal(known), words)), of), 0)

    return F.get(F.transform(F.array(words_of(text)), hashes), 0)


def likeness(a: Column, b: Column) -> Column:
    """The share of subsets with equal hashes among those that either text has terms in."""
    both = F.zip_with(F.split(a, r"\."), F.split(b, r"\."), lambda x, y: F.when((x != NONE) | (y != NONE), (x == y).cast("int")))
    either = F.filter(both, lambda x: x.isNotNull())
    return F.when(F.size(either) == 0, F.lit(1.0)).otherwise(F.size(F.filter(either, lambda x: x == 1)) / F.size(either))


def with_next(rows: DataFrame, order: str, tie: str, value: Column, n: int) -> DataFrame:
    """Adds ``own``, the value of a row, and ``next``, that of the row that follows in descending (order,
    tie), nulls last; after the last row, that of the first.  ``n`` is how many rows there are, about.

    Rows are dealt out once, by ranges of (order, tie), so rows that share one id spread over ranges;
    inside a range a window looks one row ahead.  The last row of a range gets the first of the
    following range: ranges know each other's first keys, and only the values of these are worked out
    again.
    """
    key = key_struct([order, tie])
    placed = rows.withColumn("bucket", bucket_of(key, range_bounds(rows, [order, tie], n)))
    heads = placed.groupBy("bucket").agg(F.max(key).alias("head"))
    following = F.lead("head").over(Window.orderBy(F.col("bucket").desc()))  # one row a range, keys alone
    follow = heads.select("bucket", F.coalesce(following, F.max_by("head", "bucket").over(Window.partitionBy())).alias("head"))
    at_head = rows.join(F.broadcast(follow), F.col(order).eqNullSafe(F.col("head.v0")) & (F.col(tie) == F.col("head.v1")))
    after = at_head.dropDuplicates(["bucket"]).select("bucket", value.alias("after"))
    ahead = Window.partitionBy("bucket").orderBy(F.col(order).desc_nulls_last(), F.col(tie).desc())
    looked = placed.withColumn("own", value).withColumn("ahead", F.lead("own").over(ahead)).join(after.hint("merge"), "bucket", "left")
    return looked.withColumn("next", F.coalesce("ahead", "after")).drop("bucket", "ahead", "after")


def edited(text: Column, following: Column) -> Column:
    """The last floor(n / 3) code points replaced by the first as many of the following text."""
    n = F.char_length(text)
    cut = F.floor(n / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - cut), F.substring(following, F.lit(1), cut))


def compared(docs: DataFrame) -> DataFrame:
    """For each document of (doc_id, text): n_chars, the edited text, the fingerprints of both, and the
    likeness of its own to the edited text's and to the next document's."""
    docs = docs.select("doc_id", text_or_empty("text").alias("text"))
    known = lexicon(docs)
    own = F.struct("text", fingerprint(F.col("text"), known).alias("print"))
    rows = with_next(docs.withColumn("tie", F.xxhash64("text")), "doc_id", "tie", own, docs.count())
    rows = rows.select("doc_id", "own", F.col("next.print").alias("next_print"), edited(F.col("own.text"), F.col("next.text")).alias("edited"))
    rows = rows.withColumn("edited_print", fingerprint(F.col("edited"), known))
    return rows.select(
        "doc_id",
        F.char_length("own.text").cast("long").alias("n_chars"),
        "edited",
        F.col("own.print").alias("fingerprint"),
        F.col("edited_print").alias("edited_fingerprint"),
        likeness(F.col("own.print"), F.col("edited_print")).alias("near_edited"),
        likeness(F.col("own.print"), F.col("next_print")).alias("near_next"),
    )


def op7_imatch(spark, sf_dir: str) -> DataFrame:
    found = compared(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.withColumn("edited_sha256", F.sha2(F.encode("edited", "utf-8"), 256)).drop("edited")


OP7_SQL = r"""
WITH d AS MATERIALIZED (SELECT doc_id, coalesce(text, '') AS text FROM documents),
n AS (SELECT doc_id, text, length(text) AS n, coalesce(lead(text) OVER o, first_value(text) OVER o) AS nx, coalesce(lead(doc_id) OVER o, first_value(doc_id) OVER o) AS next_id FROM d WINDOW o AS (ORDER BY doc_id DESC)),
e AS MATERIALIZED (SELECT *, substring(text, 1, n - n // 3) || substring(nx, 1, n // 3) AS edited FROM n),
w AS MATERIALIZED (SELECT doc_id, kind, list_distinct(list_filter(regexp_split_to_array(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ 	-
]+'), lambda x: x <> '')) AS w
  FROM (SELECT doc_id, 'own' AS kind, text AS t FROM e UNION ALL SELECT doc_id, 'edited', edited FROM e)),
x AS MATERIALIZED (SELECT doc_id, kind, unnest(w) AS word FROM w),
lexicon AS (SELECT word FROM x WHERE kind = 'own' GROUP BY word HAVING count(*) BETWEEN greatest(2, 0.02 * (SELECT count(*) FROM d)) AND greatest(2, 0.06 * (SELECT count(*) FROM d))),
kept AS MATERIALIZED (SELECT x.* FROM x JOIN lexicon USING (word)),
parts AS (SELECT doc_id, kind, k, substr(md5(string_agg(word, ' ' ORDER BY word)), 1, 8) AS h FROM kept, range(32) r(k) WHERE substr(md5(k || ' ' || word), 1, 1) = '0' GROUP BY ALL),
alone AS (SELECT doc_id, kind, substr(md5(array_to_string(list_sort(w), ' ')), 1, 8) AS h FROM w ANTI JOIN kept USING (doc_id, kind)),
prints AS MATERIALIZED (SELECT w.doc_id, w.kind, list(coalesce(p.h, CASE WHEN r.k = 0 THEN a.h END, '-') ORDER BY r.k) AS f
  FROM w CROSS JOIN range(32) r(k) LEFT JOIN parts p ON p.doc_id = w.doc_id AND p.kind = w.kind AND p.k = r.k LEFT JOIN alone a ON a.doc_id = w.doc_id AND a.kind = w.kind GROUP BY ALL),
z AS (SELECT e.doc_id, e.n AS n_chars, sha256(e.edited) AS edited_sha256, o.f AS a, x.f AS b, y.f AS c FROM e JOIN prints o ON o.doc_id = e.doc_id AND o.kind = 'own'
  JOIN prints x ON x.doc_id = e.doc_id AND x.kind = 'edited' JOIN prints y ON y.doc_id = e.next_id AND y.kind = 'own')
SELECT doc_id, n_chars, edited_sha256, array_to_string(a, '.') AS fingerprint, array_to_string(b, '.') AS edited_fingerprint,
  LIKE(a, b) AS near_edited, LIKE(a, c) AS near_next FROM z
"""
for _b in "bc":
    _same = f"len(list_filter(range(1, 33), lambda i: a[i] = {_b}[i] AND a[i] <> '-'))"
    _either = f"len(list_filter(range(1, 33), lambda i: a[i] <> '-' OR {_b}[i] <> '-'))"
    OP7_SQL = OP7_SQL.replace(f"LIKE(a, {_b})", f"CASE WHEN {_either} = 0 THEN 1.0 ELSE {_same} / {_either} END")
