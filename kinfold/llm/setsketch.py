"""Near-duplicate documents by SetSketch registers.

(Ertl, "SetSketch: Filling the Gap between MinHash and HyperLogLog".)  Each register holds, on an
exponentially spaced and truncated scale, the minimum of one hash over a document's shingles.
Registers merge by maximum, and two documents agree in a register nearly as often as their sets'
Jaccard similarity says.  Bands of registers bring candidates together; how many registers are
larger, smaller and equal gives the most likely similarity of a pair, which sorts out what is far
below the threshold; what is left is confirmed on the full shingle sets.

Equal texts (by a 128-bit hash) are one node, whatever their ids.  In each bucket all members are
compared with one of them only, chosen anew in each bucket, so that large groups of copies never
give all their pairs.  What is left outside the bucket's largest component is compared with one
member of that component and one of the rest, STARS times over, each in time linear in the bucket.
What the links found so far still leave in different components of a bucket is then compared block
by block: by registers, whose size is fixed, and then, for the members that any register test let
through, on full sets, in blocks bounded in rows and bytes; so no candidate pair is lost, and no
group is capped.

Cases: texts without words (null, empty) have an empty set and link with nothing; repeated rows
are copies; rows that share an id with another text are documents of their own, and a component is
named by the smallest id in it; rows without id are kept and link with nothing; an empty table gives
an empty table; other columns don't come through, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.llm.components import components
from kinfold.llm.shared import slices, text_or_empty, tidy, written_in_few
from kinfold.llm.shingles import mixed, shingle_sets

REGISTERS, BANDS, ROWS = 128, 20, 4
#: The scale: register = 1 - log(x / SCALE) / log(SPACING), cut to 0 .. TOP.
SPACING, SCALE, TOP = 1.001, 64.0, 65_534
#: A pair is dropped before the exact test if its likeliest similarity is this far below the bound:
#: over four standard deviations of the estimate.
MARGIN = 0.16
#: Members of a bucket compared in one group, on either side, and bytes of their full sets, about.
BLOCK, BLOCK_BYTES = 256, 8_000_000
#: Rounds in which what is left of a bucket is compared with single members of it.
STARS = 1
#: Places at which a component's name can be looked up.
SALTS = 16
#: Shingles whose membership is laid out in one table.
COLUMNS = 4_096
#: Below so many candidate documents (8 bytes each), their ids are broadcast.
FEW = 500_000

_rng = np.random.default_rng(977)
_FACTORS = _rng.integers(0, 2**63, REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BAND = _rng.integers(0, 2**63, (BANDS, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SEED = _rng.integers(0, 2**63, BANDS, dtype=np.uint64)


def minima(shingles: np.ndarray) -> np.ndarray:
    """For each register the least hash; element-wise minima of two results are those of the union."""
    least = np.full(REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 2048):
        np.minimum(least, (_FACTORS[:, None] * shingles[None, at : at + 2048]).min(1), out=least)
    return least


def registers(least: np.ndarray) -> np.ndarray:
    """The exponentially spaced, truncated values of the minima."""
    x = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**64)
    return np.clip(np.floor(1 - np.log(np.maximum(x, 1e-300) / SCALE) / np.log(SPACING)), 0, TOP).astype("<u2")


def band_keys(values: np.ndarray) -> np.ndarray:
    used = values[: BANDS * ROWS].astype(np.uint64).reshape(BANDS, ROWS)
    return mixed((mixed(used + np.uint64(1)) * _BAND).sum(1, dtype=np.uint64) + _SEED).view(np.int64)


_GRID = np.linspace(0, 1, 201)


def likeliest(more: np.ndarray, less: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """The likeliest Jaccard similarity given in how many registers the first set of a pair is larger
    and smaller, and the sizes of the sets."""
    share = (n_a / (n_a + n_b))[:, None]
    j = np.minimum(_GRID[None], np.minimum(share / (1 - share), (1 - share) / share))
    tail = lambda x: -np.log1p(-np.maximum(x, 0) * (SPACING - 1) / SPACING) / np.log(SPACING)
    up, down = tail(share - (1 - share) * j), tail(1 - share - share * j)
    same = np.maximum(1 - up - down, 1e-12)
    fit = more[:, None] * np.log(np.maximum(up, 1e-12)) + less[:, None] * np.log(np.maximum(down, 1e-12)) + (REGISTERS - more - less)[:, None] * np.log(same)
    return j[np.arange(len(j)), fit.argmax(1)]


def _values(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), "<u2").reshape(-1, REGISTERS) if len(column) else np.empty((0, REGISTERS), "<u2")


def sketched(docs: DataFrame, words: int) -> DataFrame:
    """(id, t1, t2, n, bands, regs) of (id, t1, t2, text); bands and regs are null for empty sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            n, bands, regs = [], [], []
            for s in shingle_sets(batch.column(3).cast(pa.binary()).to_pylist(), words):
                values = registers(minima(s)) if len(s) else None
                n.append(len(s))
                regs.append(None if values is None else values.tobytes())
                bands.append(None if values is None else band_keys(values))
            columns = [pa.array(n, pa.int64()), pa.array(bands, pa.list_(pa.int64())), pa.array(regs, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), *columns], ["id", "t1", "t2", "n", "bands", "regs"])

    return docs.mapInArrow(tidy(run), "id long, t1 long, t2 long, n long, bands array<long>, regs binary")


def likely(pairs: DataFrame, nodes: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose likeliest similarity isn't far below ``least``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            a, b = _values(p.regs_a), _values(p.regs_b)
            near = likeliest((a > b).sum(1), (a < b).sum(1), p.n_a.to_numpy(float), p.n_b.to_numpy(float)) >= least - MARGIN
            yield p.loc[near, ["a", "b"]]

    side = lambda x: nodes.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("regs").alias(f"regs_{x}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").mapInPandas(tidy(run), "a long, b long")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have 100 * intersection >= percent * union."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            linked = []
            for x, y in zip(p.set_a, p.set_b, strict=True):
                x, y = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
                common = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * common >= percent * (len(x) + len(y) - common))
            yield p.loc[linked, ["a", "b"]]

    side = lambda x: sets.select(F.col("node").alias(x), F.col("packed").alias(f"set_{x}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").mapInPandas(tidy(run), "a long, b long")


def shingle_table(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(node, packed): the full sets of the wanted (node, t1, t2)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            packed = [s.astype("<u8").tobytes() for s in shingle_sets(batch.column(1).cast(pa.binary()).to_pylist(), words)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], ["node", "packed"])

    wanted = F.broadcast(wanted) if wanted.count() <= FEW else wanted
    texts = docs.join(wanted, ["t1", "t2"]).select("node", "text")
    return texts.mapInArrow(tidy(run), "node long, packed binary").dropDuplicates(["node"])


def common_counts(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """(len(a), len(b)): the intersection sizes of sorted sets, by products of membership tables over
    the shingles that both sides hold, some columns at a time."""
    shared = np.intersect1d(np.unique(np.concatenate(a)), np.unique(np.concatenate(b)), assume_unique=True)
    out = np.zeros((len(a), len(b)), np.float32)

    def places(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        values, rows = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        at = np.minimum(np.searchsorted(shared, values), max(len(shared) - 1, 0))
        met = shared[at] == values if len(shared) else np.zeros(len(values), bool)
        order = np.argsort(at[met], kind="stable")
        return at[met][order], rows[met][order]

    (at_a, row_a), (at_b, row_b) = places(a), places(b)
    for start in range(0, len(shared), COLUMNS):
        tables = []
        for at, row, n in ((at_a, row_a, len(a)), (at_b, row_b, len(b))):
            lo, hi = np.searchsorted(at, [start, start + COLUMNS])
            table = np.zeros((n, min(COLUMNS, len(shared) - start)), np.float32)
            table[row[lo:hi], at[lo:hi] - start] = 1
            tables.append(table)
        out += tables[0] @ tables[1].T
    return out


def open_buckets(members: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((key, node, component), (key, main, all, most)) of the buckets whose members are in different
    components so far; ``main`` is the largest component, with ``most`` of ``all`` members."""
    known = members.join(labels, "node", "left").select("key", "node", F.coalesce("component", "node").alias("component"))
    parts = known.groupBy("key", "component").agg(F.count("*").alias("size"))
    buckets = parts.groupBy("key").agg(F.max_by("component", F.struct("size", "component")).alias("main"), F.sum("size").alias("all"), F.max("size").alias("most"))
    return known, written_in_few(buckets.where(F.col("all") > F.col("most")))


def more_stars(known: DataFrame, buckets: DataFrame, turn: int) -> DataFrame:
    """Pairs (a, b) of each member outside its bucket's main component with one member of that
    component and with one of the others, chosen by a hash of the turn."""
    known = known.join(buckets, "key")
    outside = F.col("component") != F.col("main")
    pick = F.struct(F.xxhash64(F.lit(31 + turn), "key", "node"), "node")
    centres = known.groupBy("key").agg(F.min(F.when(~outside, pick)).alias("in"), F.min(F.when(outside, pick)).alias("out"))
    ends = F.explode(F.array("in.node", "out.node")).alias("centre")
    pairs = known.where(outside).select("key", "node").join(centres, "key").select("node", ends).where("node <> centre")
    return pairs.select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")).distinct()


def rest_of_buckets(known: DataFrame, buckets: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Confirmed links (a, b) between members of a bucket that are in different components so far.

    In each bucket the members outside its largest component ask all its members.  Both sides are
    cut into blocks by hash, so tasks are bounded and a bucket of any size is gone through whole.  A
    first pass sends registers alone and returns, for each pair of blocks, the members that any
    likely pair holds; the second sends the full sets of these and returns the links, so the pairs
    of a large group never become rows.  A pair is looked at in the first bucket it shares.
    """
    least = percent / 100
    rows = known.join(buckets, "key")
    sizes = rows.join(nodes.select("node", (F.col("n") * 8).alias("bytes")), "node")
    outside = F.col("component") != F.col("main")
    counted = sizes.groupBy("key").agg(F.first("main").alias("main"), F.count("*").alias("all"), F.sum("bytes").alias("all_bytes"), F.count_if(outside).alias("some"), F.sum(F.when(outside, F.col("bytes"))).alias("some_bytes"))
    cut = lambda n, b: F.greatest(F.ceil(F.col(n) / BLOCK), F.ceil(F.col(b) / BLOCK_BYTES)).cast("int")
    blocks = written_in_few(counted.select("key", "main", cut("all", "all_bytes").alias("held"), cut("some", "some_bytes").alias("asking")))
    rows = written_in_few(known.join(blocks, "key"))
    salt = lambda c: F.pmod(F.xxhash64(F.lit(13), "node"), F.col(c)).cast("int")
    span = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    asks = rows.where("component <> main").select("key", "node", "component", F.lit(True).alias("asks"), salt("asking").alias("x"), span("held").alias("y"))
    held = rows.select("key", "node", "component", F.lit(False).alias("asks"), span("asking").alias("x"), salt("held").alias("y"))
    sketches = written_in_few(nodes.select("node", "n", "bands", "regs").join(rows.select("node").distinct(), "node"))

    def likely_pairs(q: pd.DataFrame, h: pd.DataFrame) -> np.ndarray:
        """Which of the pairs are in different components, share this bucket first and are likely."""
        at = int(np.flatnonzero(q.bands.iloc[0] == q.key.iloc[0])[0])
        found = q.component.to_numpy()[:, None] != h.component.to_numpy()[None]
        q_bands, h_bands = np.stack(q.bands.to_numpy()), np.stack(h.bands.to_numpy())
        for band in range(at):
            found &= q_bands[:, band, None] != h_bands[None, :, band]
        q_regs, h_regs, q_sizes, h_sizes = _values(q.regs), _values(h.regs), q.n.to_numpy(float), h.n.to_numpy(float)
        for i in np.flatnonzero(found.any(1)):
            j = np.flatnonzero(found[i])
            more, less = (q_regs[i] > h_regs[j]).sum(1), (q_regs[i] < h_regs[j]).sum(1)
            found[i, j] = likeliest(more, less, np.full(len(j), q_sizes[i]), h_sizes[j]) >= least - MARGIN
        return found

    def likely_members(group: pd.DataFrame) -> pd.DataFrame:
        q, h = group[group.asks], group[~group.asks]
        if not len(q) or not len(h):
            return group.loc[[], ["key", "node", "component", "asks", "x", "y"]]
        found = likely_pairs(q, h)
        return pd.concat([q[found.any(1)], h[found.any(0)]])[["key", "node", "component", "asks", "x", "y"]]

    def linked_pairs(group: pd.DataFrame) -> pd.DataFrame:
        q, h = group[group.asks], group[~group.asks]
        found = likely_pairs(q, h)
        q_sets, h_sets = ([np.frombuffer(p, "<u8") for p in side.packed] for side in (q, h))
        common = common_counts(q_sets, h_sets)
        linked = found & (100 * common >= percent * (q.n.to_numpy(float)[:, None] + h.n.to_numpy(float)[None] - common))
        x, y = np.nonzero(linked)
        return pd.DataFrame({"a": q.node.to_numpy()[x], "b": h.node.to_numpy()[y]})

    place = "key long, node long, component long, asks boolean, x int, y int"
    some = written_in_few(asks.unionByName(held).join(sketches, "node").groupBy("key", "x", "y").applyInPandas(likely_members, place))
    full = some.join(sketches, "node").join(sets, "node")
    return full.groupBy("key", "x", "y").applyInPandas(linked_pairs, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, id_column: str = "doc_id", column: str = "text") -> DataFrame:
    """One row a document: id, n_shingles, component_id, kept (whether it stands for its group)."""
    text = text_or_empty(column)
    docs = docs.select(F.col(id_column).alias("id"), F.xxhash64(F.lit(21), text).alias("t1"), F.xxhash64(F.lit(22), text).alias("t2"), text.alias("text"))
    rows = written_in_few(sketched(docs, words))
    nodes = rows.where("n > 0 and id is not null").groupBy("t1", "t2").agg(F.min("id").alias("least_id"), F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("regs").alias("regs"))
    nodes = written_in_few(nodes.withColumn("node", F.monotonically_increasing_id()))  # numbers of their own, fixed by the write
    members = nodes.select("node", F.explode("bands").alias("key"))
    buckets = members.groupBy("key").agg(F.count("*").alias("size"), F.min(F.struct(F.xxhash64("key", "node").alias("h"), "node")).alias("first")).where("size > 1")
    buckets = written_in_few(buckets)
    members = written_in_few(members.join(buckets.select("key", F.col("first.node").alias("centre")), "key"))
    wanted = members.select("node").distinct().join(nodes.select("node", "t1", "t2"), "node")
    sets = written_in_few(shingle_table(docs, written_in_few(wanted), words))
    stars = members.where("node <> centre").select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")).distinct()
    members = members.select("key", "node")
    links = written_in_few(confirmed(likely(stars, nodes, percent / 100), sets, percent))
    labels = written_in_few(labelled(links))
    known, left = open_buckets(members, labels)
    for turn in range(STARS + 1):
        if not left.limit(1).count():
            break
        if turn < STARS:
            more = confirmed(likely(more_stars(known, left, turn), nodes, percent / 100), sets, percent)
        else:
            more = rest_of_buckets(known, left, nodes, sets, percent)
        links = links.unionByName(written_in_few(more))
        labels = written_in_few(labelled(links))
        known, left = open_buckets(members, labels) if turn < STARS else (known, left)
    groups = nodes.select("node", "t1", "t2", "least_id").join(labels, "node", "left")
    groups = written_in_few(groups.select("t1", "t2", "least_id", F.coalesce("component", "node").alias("component")))
    # a component may hold a third of all texts, so its members look its name up at SALTS places
    names = groups.groupBy("component").agg(F.min("least_id").alias("name")).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    of_text = groups.withColumn("salt", F.pmod("t1", F.lit(SALTS)).cast("int")).join(names, ["component", "salt"]).select("t1", "t2", "name")
    out = rows.select("id", "n", "t1", "t2").join(of_text, ["t1", "t2"], "left")
    component = F.when((F.col("n") > 0) & F.col("id").isNotNull(), F.coalesce("name", "id")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(id_column), F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def labelled(links: DataFrame) -> DataFrame:
    return components(links).select("node", "component")


def op5_setsketch(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), words=2)


OP5_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS MATERIALIZED (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) < 2 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END)) AS s
  FROM w WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
l AS MATERIALIZED (
  SELECT p.a, p.b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL) p
  JOIN n na ON na.doc_id = p.a JOIN n nb ON nb.doc_id = p.b WHERE 100 * p.c >= 80 * (na.n + nb.n - p.c)),
r(d, c) AS (SELECT a, a FROM l UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.d),
g AS (SELECT d, min(c) AS c FROM r GROUP BY d)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(g.c, d.doc_id) AS component_id, d.doc_id = coalesce(g.c, d.doc_id) AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN g ON g.d = d.doc_id
"""
