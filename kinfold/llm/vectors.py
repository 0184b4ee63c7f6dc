"""Near duplicates among embeddings by an inverted multi-index.

Each half of a unit vector has a codebook of its own; a pair of codes is a cell of the product
grid, and every vector is indexed in its nearest cell.  A query visits cells in the order of the
two halves' distances (the multi-sequence traversal), measured from its own nearest cell, until it
is past a bound; what lies in the visited cells is verified by the cosine in double precision.

The bound is fitted: a sample of queries is compared with *all* rows, and the bound is where the
wanted share of their true neighbours has been met, but never below the largest squared distance of
linked vectors.  Codebooks come from at most ``SAMPLE`` vectors, chosen by hash, and the bound from the
first ``QUERIES`` of them, or more while they meet fewer than ``ENOUGH`` neighbours; every row is
indexed and every row is a query.

Equal vectors are one node.  Cells are cut into blocks of rows and of visits, so a task compares
two blocks of bounded size; it returns each row's number of links and the block's spanning stars,
never its pairs.

Cases: vectors that are null, empty, zero, of another length than the longest, or hold null or
non-finite components link with nothing; repeated rows count as copies; an empty table stays empty.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.llm.components import components
from kinfold.llm.shared import written

#: Vectors that the codebooks are fitted on at most, queries that the bound is fitted on at first, and
#: neighbours that it wants; with fewer, four times as many queries are asked next, up to the sample.
SAMPLE, QUERIES, ENOUGH = 20_000, 1_000, 300
#: Rows of a cell and visits to it that one task compares, about.
BLOCK = 2_048
#: Rows a cell holds on average; so the grid grows with the table.
CELL_ROWS = 800
BINS, BIN = 800, 0.005
#: How far past the fitted bound a query goes on: neighbours that the sample doesn't show.
SLACK = 1.15


def kmeans(points: np.ndarray, k: int, rounds: int = 12, seed: int = 5) -> np.ndarray:
    """Lloyd's algorithm from ``k`` distinct points."""
    rng = np.random.default_rng(seed)
    centres = points[rng.choice(len(points), min(k, len(points)), replace=False)].copy()
    for _ in range(rounds):
        nearest = distances(points, centres).argmin(1)
        for c in range(len(centres)):
            if (mine := nearest == c).any():
                centres[c] = points[mine].mean(0)
    return centres


def distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of the rows of ``x`` to the centres."""
    return np.maximum((x**2).sum(1)[:, None] - 2 * x @ centres.T + (centres**2).sum(1)[None], 0)


def multi_sequence(first: np.ndarray, second: np.ndarray, bound: float) -> Iterator[tuple[int, int]]:
    """Cells (i, j) in ascending order of first[i] + second[j], up to ``bound``."""
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    x, y = first[a].tolist(), second[b].tolist()
    a, b = a.tolist(), b.tolist()
    heap = [(x[0] + y[0], 0, 0)]
    while heap:
        far, i, j = heapq.heappop(heap)
        if far > bound:
            return
        yield a[i], b[j]
        if j + 1 < len(y):
            heapq.heappush(heap, (x[i] + y[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(x):
            heapq.heappush(heap, (x[i + 1] + y[0], i + 1, 0))


class MultiIndex:
    """The two codebooks and the bound of the traversal."""

    def __init__(self, sample: np.ndarray, codes: int):
        self.half = sample.shape[1] // 2
        self.books = [kmeans(part, codes) for part in self._halves(sample)]
        self.bound = 0.0

    def _halves(self, unit: np.ndarray) -> list[np.ndarray]:
        return [unit[:, : self.half], unit[:, self.half :]] if self.half else [unit[:, :0], unit]

    def far(self, unit: np.ndarray) -> list[np.ndarray]:
        """For each half, how much farther than the nearest code each code is (squared)."""
        found = [distances(part, book) for part, book in zip(self._halves(unit), self.books, strict=True)]
        return [d - d.min(1, keepdims=True) for d in found]

    def cells(self, unit: np.ndarray) -> np.ndarray:
        first, second = (f.argmin(1) for f in self.far(unit))
        return first * len(self.books[1]) + second

    def visits(self, unit: np.ndarray) -> list[list[int]]:
        width = len(self.books[1])
        return [[i * width + j for i, j in multi_sequence(f, s, self.bound)] for f, s in zip(*self.far(unit), strict=True)]


def matrix(values, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(values), dtype="<f8").reshape(-1, dim) if len(values) else np.empty((0, dim))


def unit_rows(m: np.ndarray) -> np.ndarray:
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def usable(vector: Column) -> Column:
    """Whether a vector can have neighbours."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))
    return F.coalesce(F.forall(vector, fine) & F.exists(vector, lambda x: x != 0), F.lit(False))


def link_blocks(x_ids, x, y_ids, y, y_copies, least: float) -> pd.DataFrame:
    """The links between two blocks: (node, root, n_links), root being the smallest node of what the
    node is connected with inside the two blocks."""
    cosine = (x @ y.T) / (np.linalg.norm(x, axis=1)[:, None] * np.linalg.norm(y, axis=1)[None])
    linked = (cosine >= least) & (x_ids[:, None] != y_ids[None])
    xs, ys = linked.any(1), linked.any(0)
    links, part = linked[xs][:, ys], linked[xs] @ y_copies
    top = np.iinfo(np.int64).max
    x_root, y_root = x_ids[xs], y_ids[ys]
    while len(x_root):
        new_x = np.minimum(x_root, np.where(links, y_root[None], top).min(1))
        new_y = np.minimum(y_root, np.where(links, new_x[:, None], top).min(0))
        if (new_x == x_root).all() and (new_y == y_root).all():
            break
        x_root, y_root = new_x, new_y
    return pd.DataFrame({"node": np.r_[x_ids[xs], y_ids[ys]], "root": np.r_[x_root, y_root], "n_links": np.r_[part, np.zeros(ys.sum(), int)].astype(np.int64)})


def fit_index(nodes: DataFrame, dim: int, n: int, least: float, recall: float) -> MultiIndex:
    sample = nodes.select("node", "packed").orderBy(F.xxhash64(F.lit(9), "node")).limit(SAMPLE).toPandas()
    unit = unit_rows(matrix(sample.packed, dim))
    index = MultiIndex(unit, max(1, round((n / CELL_ROWS) ** 0.5)))
    width = len(index.books[1])
    met: Counter = Counter()
    asked, more = 0, QUERIES
    while asked < len(unit) and sum(met.values()) < ENOUGH:
        met.update(neighbour_bins(nodes, index, dim, least, unit[asked : asked + more], sample.node.to_numpy()[asked : asked + more], width))
        asked, more = asked + more, more * 4
    running, total = 0, sum(met.values())
    index.bound = floor = (1 - least) * 2
    for b in sorted(met):
        running += met[b]
        if running >= recall * total:
            index.bound = max(floor, (b + 1) * BIN * SLACK)
            break
    return index


def neighbour_bins(nodes: DataFrame, index: MultiIndex, dim: int, least: float, queries: np.ndarray, ids: np.ndarray, width: int) -> dict[int, int]:
    """How many neighbours of the queries lie how far past the queries' own cells, in steps of BIN."""
    far, step = index.far(queries), max(64, 4_096_000 // len(queries))

    def neighbours(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros(BINS, int)
        for batch in batches:
            rows, nodes_here = unit_rows(matrix(batch.packed, dim)), batch.node.to_numpy()
            for at in range(0, len(rows), step):
                part = rows[at : at + step]
                q, y = np.nonzero((queries @ part.T >= least) & (ids[:, None] != nodes_here[None, at : at + step]))
                cell = index.cells(part)[y]
                past = far[0][q, cell // width] + far[1][q, cell % width]
                counts += np.bincount(np.minimum((past / BIN).astype(int), BINS - 1), minlength=BINS)
        yield pd.DataFrame({"bin": np.nonzero(counts)[0], "n": counts[counts > 0]})

    found = nodes.select("node", "packed").mapInPandas(neighbours, "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n"))
    return {r.bin: r.n for r in found.collect()}


def near_duplicates(df: DataFrame, id_column: str = "vec_id", column: str = "embedding", least: float = 0.95, recall: float = 1.0) -> DataFrame:
    """One row a vector: the id, n_links, component_id and kept."""
    vector = F.col(column)
    rows = written(df.select(F.col(id_column).alias("id"), F.when(usable(vector), F.xxhash64(vector)).alias("node"), F.size(vector).alias("dim"), F.transform(vector, lambda x: x.cast("double")).alias("v")))
    shape = rows.where("node is not null").agg(F.max("dim").alias("dim")).first()
    dim = shape.dim or 0
    whole = rows.withColumn("node", F.when(F.col("dim") == dim, F.col("node")))

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"node": batch.node, "rep": batch.rep, "copies": batch.copies, "packed": [np.asarray(v, "<f8").tobytes() for v in batch.v]})

    nodes = whole.where("node is not null").groupBy("node").agg(F.min("id").alias("rep"), F.count("*").alias("copies"), F.first("v").alias("v"))
    nodes = written(nodes.mapInPandas(packed, "node long, rep long, copies long, packed binary"))
    n = nodes.count()
    labels = nodes.select("node", "rep", "copies")
    if n > 1:
        labels = labels.join(linked_nodes(nodes, fit_index(nodes, dim, n, least, recall), dim, least), "node", "left")
    else:
        labels = labels.withColumns({"n": F.lit(0), "component": F.lit(None).cast("long")})
    labels = written(labels.withColumn("component", F.coalesce("component", "node")))
    least_id = labels.groupBy("component").agg(F.min("rep").alias("component_id"))
    labels = labels.join(least_id, "component").select("node", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    out = whole.select("id", "node").join(labels, "node", "left")
    component = F.coalesce("component_id", "id")
    return out.select(F.col("id").alias(id_column), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def linked_nodes(nodes: DataFrame, index: MultiIndex, dim: int, least: float) -> DataFrame:
    """(node, n, component) of the nodes that have links; n counts the copies of linked nodes."""

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            unit = unit_rows(matrix(batch.packed, dim))
            yield pd.DataFrame({"node": batch.node, "copies": batch.copies, "packed": batch.packed, "home": index.cells(unit), "visits": index.visits(unit)})

    placed = written(nodes.mapInPandas(place, "node long, copies long, packed binary, home long, visits array<long>"))
    visits = placed.select("node", "packed", F.explode("visits").alias("cell"))
    rows_in = placed.groupBy(F.col("home").alias("cell")).agg(F.count("*").alias("rows"))
    visits_to = visits.groupBy("cell").agg(F.count("*").alias("visits"))
    cut = lambda c: F.ceil(F.col(c) / BLOCK).cast("int")
    cells = written(rows_in.join(visits_to, "cell").select("cell", cut("rows").alias("row_blocks"), cut("visits").alias("visit_blocks")))
    salt = lambda c: F.pmod(F.xxhash64(F.lit(11), "node"), F.col(c)).cast("int")
    span = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    asked = visits.join(cells, "cell").select("cell", span("row_blocks").alias("rb"), salt("visit_blocks").alias("vb"), F.lit(True).alias("asks"), "node", F.lit(0).cast("long").alias("copies"), "packed")
    held = placed.withColumnRenamed("home", "cell").join(cells, "cell").select("cell", salt("row_blocks").alias("rb"), span("visit_blocks").alias("vb"), F.lit(False).alias("asks"), "node", "copies", "packed")

    def verify(group: pd.DataFrame) -> pd.DataFrame:
        x, y = group[group.asks], group[~group.asks]
        if not len(x) or not len(y):
            return pd.DataFrame({"node": [], "root": [], "n_links": []}).astype("int64")
        return link_blocks(x.node.to_numpy(), matrix(x.packed, dim), y.node.to_numpy(), matrix(y.packed, dim), y.copies.to_numpy(), least)

    found = written(asked.unionByName(held).groupBy("cell", "rb", "vb").applyInPandas(verify, "node long, root long, n_links long"))
    counts = found.groupBy("node").agg(F.sum("n_links").alias("n"))
    return counts.join(components(found.select(F.col("node").alias("a"), F.col("root").alias("b"))), "node", "left")


def op1_multi_index(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


OP1_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
  WHERE list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.95),
r(n, c) AS (SELECT a, a FROM l UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.n),
c AS (SELECT n, min(c) AS c FROM r GROUP BY n),
k AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT vec_id, coalesce(k.n, 0) AS n_links, coalesce(c.c, vec_id) AS component_id, vec_id = coalesce(c.c, vec_id) AS kept
FROM embeddings LEFT JOIN c ON c.n = vec_id LEFT JOIN k ON k.a = vec_id
"""
