"""Masked pseudo-likelihood of documents by a small bidirectional network, in numpy.

Every token is predicted from the SIDE tokens before and the SIDE after it: their embeddings, each
through a matrix for its place, meet in one hidden layer, which gives the probabilities of the
token's class.  The summed log-probabilities of all tokens are a document's pseudo-log-likelihood.

Tokens are words (as in ``shingles``), by a 64-bit hash.  Words are counted over all documents; the
VOCABULARY most frequent ones have embeddings and classes of their own neighbourhoods; all others
share one embedding and the last class.  log p(word) = log p(class | both sides) + log p(word |
class), the latter from the counts of all words: the count table stays a Parquet table, which grows
with the corpus, and the words outside the vocabulary are joined with it.  Words that were never
counted share the place of UNSEEN counts, so probabilities in a class add up to one.

Texts are read twice: to count words, and to write them as numbers in the vocabulary; all else reads
these.  For training, documents are dealt by a hash of their row into parts of about PART tokens, and
lie sorted by it in a part, so the weights don't follow how the table is laid out.  In each round every part starts from the same weights, trains on one in ROUNDS
of its tokens, all documents taking part, and the weights are averaged by tokens seen, in a tree, so
no task holds those of more than FAN parts.  The rounds' tokens are disjoint and together all of
them.  What training reads and what it gathers grow with the input.

Cases: a null, empty or blank text has no tokens, log-likelihood 0 and no mean; repeated rows count
each; a very long text goes through in pieces; an empty table gives an empty table; other columns
stay, but for n_tokens, log_likelihood and per_token, which are replaced.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType, VariantType

from kinfold.llm.shared import text_or_empty, written
from kinfold.llm.shingles import word_hashes

VOCABULARY, CLASSES, WIDTH, HIDDEN, SIDE = 16_384, 64, 16, 24, 2
#: Rounds, each over its share of the tokens, so that all are trained on once; step size; tokens a step.
ROUNDS, STEP, BATCH = 2, 0.15, 2_048
#: Tokens of a part, and parts at most: larger tables have larger parts.
PART, PARTS = 2_000_000, 20_000
#: Parts whose weights one task averages.
FAN = 16
#: The count that all words stand for which were never counted.
UNSEEN = 0.5
#: Tokens worked on at once.
AT_ONCE = 200_000
#: Dimensions of the neighbours' vectors.
COMPANY = 32

#: Places around the token that is predicted.
PLACES = [p for p in range(-SIDE, SIDE + 1) if p]


def count_words(docs: DataFrame) -> DataFrame:
    """(word, n) over all documents; word is the hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(word_hashes(batch.column(0).cast(pa.binary()).to_pylist()))
            words, n = np.unique(np.concatenate(found), return_counts=True) if found else (np.empty(0, np.uint64), np.empty(0, int))
            yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n.astype(np.int64))], ["word", "n"])

    return docs.mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def runs(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A stable order of ids in the lexicon, which have 16 bits, the distinct ids, and where each begins."""
    order = np.argsort(ids.astype(np.uint16), kind="stable")
    laid = ids[order]
    first = np.flatnonzero(np.r_[True, laid[1:] != laid[:-1]])
    return order, laid[first], first


def row_max(x: np.ndarray) -> np.ndarray:
    """The greatest of each row, by halves."""
    while x.shape[1] % 2 == 0:
        half = x.shape[1] // 2
        x = np.maximum(x[:, :half], x[:, half:])
    return x[:, 0] if x.shape[1] == 1 else x.max(1)


class Lexicon:
    """The known words, their classes, and how likely each is in its class."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, total: int):
        order = np.argsort(words)
        self.words, self.counts, self.total = words[order], counts[order], total
        self.classify(np.arange(len(words)) % (CLASSES - 1))

    def classify(self, classes: np.ndarray) -> None:
        """Sets the classes of the known words; unknown ones have the last."""
        in_class = np.bincount(classes, self.counts, CLASSES)
        self.classes = np.r_[classes, CLASSES - 1]
        self.inside = np.r_[np.log(self.counts) - np.log(in_class[classes]), 0]  # others are joined in
        self.prior = (np.r_[in_class[:-1], max(0, self.total - self.counts.sum())] + 1) / (self.total + CLASSES)

    def others(self) -> float:
        """How many tokens are words outside the lexicon."""
        return max(0.0, self.total - self.counts.sum())

    def directions(self) -> np.ndarray:
        """A random vector for each word, unknown and no word included."""
        return np.random.default_rng(4).normal(0, 1, (len(self.words) + 2, COMPANY)).astype(np.float32)

    def company(self, tokens: np.ndarray, near: np.ndarray, directions: np.ndarray) -> np.ndarray:
        """For each known word the sum of its neighbours' vectors."""
        total = np.zeros((len(self.words), COMPANY))
        for at in range(0, len(tokens), 8192):
            mine = tokens[at : at + 8192]
            known = np.flatnonzero(mine < len(self.words))
            if not len(known):
                continue
            order, own, first = runs(mine[known])
            places = near[at : at + 8192].take(known[order], 0)
            around = directions.take(places[:, 0], 0)
            for i in range(1, places.shape[1]):
                around += directions.take(places[:, i], 0)
            total[own] += np.add.reduceat(around, first, axis=0)
        return total.astype(np.float32)

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """Places in the lexicon; one past the end for unknown words."""
        if not len(self.words):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        return np.where(self.words[at] == hashes, at, len(self.words))


def clusters(points: np.ndarray, weight: np.ndarray, k: int, rounds: int = 15) -> np.ndarray:
    """Weighted k-means from the heaviest points: a cluster number for each point."""
    if len(points) <= k:
        return np.arange(len(points))
    points = points / np.maximum(np.linalg.norm(points, axis=1, keepdims=True), 1e-9)
    centres = points[np.argsort(-weight, kind="stable")[:k]].copy()
    for _ in range(rounds):
        nearest = (points @ centres.T).argmax(1)
        for c in range(k):
            if (mine := nearest == c).any():
                centre = (points[mine] * weight[mine, None]).sum(0)
                centres[c] = centre / max(np.linalg.norm(centre), 1e-9)
    return nearest


class Network:
    """Embeddings (the last two rows: unknown word, no word), place matrices, and the output layer."""

    def __init__(self, lexicon: Lexicon, seed: int = 1):
        rng = np.random.default_rng(seed)
        n = len(lexicon.words) + 2
        self.lexicon = lexicon
        self.counts: DataFrame | None = None
        self.weights = [
            rng.normal(0, 0.3, (n, WIDTH)).astype(np.float32),
            rng.normal(0, 0.3, (len(PLACES) * WIDTH, HIDDEN)).astype(np.float32),
            np.zeros(HIDDEN, np.float32),
            np.zeros((HIDDEN, CLASSES), np.float32),
            np.log(lexicon.prior).astype(np.float32),
        ]

    def __getstate__(self) -> dict:
        return self.__dict__ | {"counts": None}  # a table stays on the driver

    def around(self, ids: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The tokens of some texts, and for each the ids of its neighbours, AT_ONCE tokens at a time."""
        lengths = np.array([len(x) for x in ids], int)
        at = np.arange(lengths.sum()) + np.repeat(np.arange(1, len(ids) + 1) * SIDE, lengths)
        flat = np.full(lengths.sum() + SIDE * (len(ids) + 1), len(self.lexicon.words) + 1, np.int32)
        flat[at] = np.concatenate(ids) if ids else 0
        for start in range(0, len(at), AT_ONCE):
            here = at[start : start + AT_ONCE]
            yield flat[here], flat[here[:, None] + np.array(PLACES)]

    def tables(self) -> list[np.ndarray]:
        """For each place the embeddings behind its matrix."""
        emb, mix = self.weights[0], self.weights[1]
        return [emb @ mix[i * WIDTH : (i + 1) * WIDTH] for i in range(len(PLACES))]

    def log_probability(self, tokens: np.ndarray, near: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
        """log p(token | both sides) for each token."""
        _, _, bias, out, prior = self.weights
        result, ones = np.empty(len(tokens)), np.ones(CLASSES, np.float32)
        for at in range(0, len(tokens), 8192):
            mine = slice(at, at + 8192)
            hidden = bias + tables[0].take(near[mine, 0], 0)
            for i in range(1, len(tables)):
                hidden += tables[i].take(near[mine, i], 0)
            logits = np.tanh(hidden) @ out + prior
            chosen = logits[np.arange(len(logits)), self.lexicon.classes[tokens[mine]]]
            logits -= (top := row_max(logits))[:, None]
            np.exp(logits, out=logits)
            result[mine] = chosen - top - np.log(logits @ ones)
        return result + self.lexicon.inside[tokens]

    def train(self, tokens: np.ndarray, near: np.ndarray, squares: list[np.ndarray]) -> None:
        """Adagrad steps over the tokens; ``squares`` is carried on."""
        emb, mix, bias, out, prior = self.weights
        ones = np.ones(CLASSES, np.float32)
        for at in range(0, len(tokens), BATCH):
            places, target = near[at : at + BATCH], self.lexicon.classes[tokens[at : at + BATCH]]
            n = len(target)
            x = emb.take(places.ravel(), 0).reshape(n, -1)
            hidden = np.tanh(x @ mix + bias)
            p = hidden @ out + prior
            p -= row_max(p)[:, None]
            np.exp(p, out=p)
            p /= (p @ ones)[:, None]
            p[np.arange(n), target] -= 1
            p /= n
            back = (p @ out.T) * (1 - hidden**2)
            flat = places.ravel()
            order, own, first = runs(flat)
            slope = np.add.reduceat((back @ mix.T).reshape(-1, WIDTH).take(order, 0), first, axis=0)
            steps = [x.T @ back, back.sum(0), hidden.T @ p, p.sum(0)]
            squared = squares[0].take(own, 0) + slope**2
            squares[0][own] = squared
            emb[own] -= STEP * slope / np.sqrt(squared + 1e-8)
            for w, s, g in zip((mix, bias, out, prior), squares[1:], steps, strict=True):
                s += g**2
                w -= STEP * g / np.sqrt(s + 1e-8)

    def packed(self) -> bytes:
        return np.concatenate([w.ravel() for w in self.weights]).astype("<f4").tobytes()

    def unpacked(self, flat: np.ndarray) -> list[np.ndarray]:
        cuts = np.cumsum([w.size for w in self.weights])[:-1]
        return [part.reshape(w.shape).copy() for part, w in zip(np.split(flat.astype(np.float32), cuts), self.weights, strict=True)]


def _grouped(texts: Iterator[np.ndarray]) -> Iterator[list[np.ndarray]]:
    """Some texts at a time."""
    group, size = [], 0
    for words in texts:
        group.append(words)
        size += len(words)
        if size >= AT_ONCE:
            yield group
            group, size = [], 0
    if group:
        yield group


def coded(docs: DataFrame, lexicon: Lexicon, column: str = "text", carry: list[str] | None = None) -> DataFrame:
    """The documents as numbers, written: ``doc`` (the columns ``carry``, or all), ``row``, ``spread`` (a
    hash of the row), ``ids`` (places in the lexicon, two bytes each) and ``others`` (the hashes of the
    words outside it)."""
    added = ("n_tokens", "log_likelihood", "per_token")
    kept = [c for c in (docs.columns if carry is None else carry) if c not in added]
    plain = [f.name for f in docs.schema.fields if f.name != column and not isinstance(f.dataType, (ArrayType, MapType, StructType, VariantType))]
    own = F.struct(*[F.col(f"`{c}`") for c in kept]) if kept else F.struct(F.lit(0).alias("none"))
    spread = F.xxhash64(F.lit(5), F.col(f"`{column}`"), *[F.col(f"`{c}`") for c in plain])
    rows = docs.select(own.alias("doc"), spread.alias("spread"), text_or_empty(F.col(f"`{column}`")).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)  # its size is fixed by VOCABULARY

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            ids, others = [], []
            for group in _grouped(word_hashes(batch.column(2).cast(pa.binary()).to_pylist())):
                flat = np.concatenate(group)
                places, cuts = known.ids(flat), np.cumsum([len(g) for g in group])[:-1]
                ids += [x.tobytes() for x in np.split(places.astype("<u2"), cuts)]
                others += [w[i == len(known.words)].view(np.int64) for w, i in zip(group, np.split(places, cuts), strict=True)]
            ends = np.cumsum([0, *map(len, others)])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.empty(0, np.int64), *others])))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ids, pa.binary()), lists], ["doc", "spread", "ids", "others"])

    found = rows.mapInArrow(run, f"doc {rows.schema['doc'].dataType.simpleString()}, spread long, ids binary, others array<long>")
    return written(found.withColumn("row", F.monotonically_increasing_id()))


def dealt(table: DataFrame, total: int) -> DataFrame:
    """(part, ids) of a coded table, each part whole and in the same order in one partition, whatever the
    layout of the table."""
    parts = min(PARTS, max(1, -(-total // PART)))
    rows = table.where(F.octet_length("ids") > 0).select(F.pmod("spread", F.lit(parts)).cast("int").alias("part"), "spread", "ids")
    return rows.repartitionByRange(parts, "part").sortWithinPartitions("part", "spread", "ids").select("part", "ids")


def by_part(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Iterator[list[np.ndarray]]]]:
    """Each part of a partition of (part, ids) with its texts, some at a time."""
    rows = ((part, ids) for batch in batches for part, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
    for part, mine in itertools.groupby(rows, key=lambda r: r[0]):
        yield part, _grouped(np.frombuffer(ids, "<u2").astype(np.int32) for _, ids in mine)


def averaged(parts: DataFrame) -> np.ndarray | None:
    """The mean of the parts' vectors (part, n, weights) by n, in a tree of FAN at a time."""

    def mean(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("part")
        n = group.n.sum()
        total = sum(np.frombuffer(w, "<f4").astype(float) * (k / n) for k, w in zip(group.n, group.weights, strict=True))
        return pd.DataFrame({"part": [key[0]], "n": [n], "weights": [total.astype("<f4").tobytes()]})

    parts = written(parts)
    left = parts.agg(F.max("part").alias("most")).first().most
    while left is not None and left > 0:
        left //= FAN
        parts = written(parts.groupBy((F.col("part") / FAN).cast("int").alias("group")).applyInPandas(mean, RESULT))
    last = parts.first()
    return None if last is None else np.frombuffer(last.weights, "<f4")


RESULT = "part int, n long, weights binary"


def _result(part: int, n: int, flat: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([n], pa.int64()), pa.array([flat], pa.binary())], ["part", "n", "weights"])


def _chosen(network: Network, groups: Iterator[list[np.ndarray]], turn: int = 0, turns: int = 1) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """One in ``turns`` of the tokens, from another start each turn, with their neighbours."""
    seen = turn
    for ids in groups:
        for tokens, near in network.around(ids):
            mine = slice(seen % turns, None, turns)
            seen += len(tokens)
            yield tokens[mine], near[mine]


def gather_company(training: DataFrame, network: Network) -> np.ndarray | None:
    shared = training.sparkSession.sparkContext.broadcast(network)  # its size is fixed by VOCABULARY

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        directions = net.lexicon.directions()
        for part, groups in by_part(batches):
            total = np.zeros((len(net.lexicon.words), COMPANY), np.float32)
            for tokens, near in _chosen(net, groups):
                total += net.lexicon.company(tokens, near, directions)
            yield _result(part, 1, total.tobytes())

    return averaged(training.mapInArrow(run, RESULT))


def one_round(training: DataFrame, network: Network, turn: int) -> list[np.ndarray]:
    """The weights after every part has trained on its tokens, averaged by tokens."""
    shared = training.sparkSession.sparkContext.broadcast(network)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, groups in by_part(batches):
            net, seen = Network(shared.value.lexicon), 0
            net.weights = [w.copy() for w in shared.value.weights]
            squares = [np.full(w.shape, 0.02, np.float32) for w in net.weights]
            for tokens, near in _chosen(net, groups, turn, ROUNDS):
                net.train(tokens, near, squares)
                seen += len(tokens)
            if seen:
                yield _result(part, seen, net.packed())

    flat = averaged(training.mapInArrow(run, RESULT))
    return network.weights if flat is None else network.unpacked(flat)


def train_coded(docs: DataFrame, column: str = "text", carry: list[str] | None = None) -> tuple[Network, DataFrame]:
    """Counts the words of all documents and trains the network on them; also the coded documents."""
    counts = written(count_words(docs.select(text_or_empty(F.col(f"`{column}`")).alias("text"))))
    total = counts.agg(F.sum("n")).first()[0] or 0
    top = counts.orderBy(F.col("n").desc(), "word").limit(VOCABULARY).toPandas()
    lexicon = Lexicon(top.word.to_numpy(np.int64).view(np.uint64), top.n.to_numpy(float), total)
    table = coded(docs, lexicon, column, carry)
    training = dealt(table, total)
    company = gather_company(training, Network(lexicon))
    if company is not None:
        lexicon.classify(clusters(company.reshape(-1, COMPANY), lexicon.counts, CLASSES - 1))
    network = Network(lexicon)
    for turn in range(ROUNDS):
        network.weights = one_round(training, network, turn)
    network.counts = counts
    return network, table


def train(docs: DataFrame, column: str = "text") -> Network:
    return train_coded(docs, column, [])[0]


def score_coded(table: DataFrame, network: Network) -> DataFrame:
    """The columns in ``doc`` of a coded table with n_tokens, log_likelihood and per_token, its mean (null
    without tokens)."""
    shared = table.sparkSession.sparkContext.broadcast(network)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        tables = net.tables()
        for batch in batches:
            sizes, sums = [], []
            for ids in _grouped(np.frombuffer(x, "<u2").astype(np.int32) for x in batch.column(2).to_pylist()):
                running = np.cumsum(np.concatenate([[0.0], *[net.log_probability(tokens, near, tables) for tokens, near in net.around(ids)]]))
                ends = np.cumsum([0, *map(len, ids)])
                sizes += np.diff(ends).tolist()
                sums += (running[ends[1:]] - running[ends[:-1]]).tolist()
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(sums, pa.float64())], ["doc", "row", "n_tokens", "log_likelihood"])

    types = f"doc {table.schema['doc'].dataType.simpleString()}, row long, n_tokens long, log_likelihood double"
    rows = table.select("doc", "row", "ids").mapInArrow(run, types)
    whole = float(network.lexicon.others() + UNSEEN)
    inside = F.log(F.coalesce("n", F.lit(UNSEEN)) / whole)
    words = table.select("row", F.explode("others").alias("word"))
    words = words.join(network.counts, "word", "left") if network.counts is not None else words.withColumn("n", F.lit(None).cast("long"))
    costs = words.groupBy("row").agg(F.sum(inside).alias("inside"))
    total = F.col("log_likelihood") + F.coalesce("inside", F.lit(0.0))
    found = rows.join(costs, "row", "left").select("doc", "n_tokens", total.alias("log_likelihood"))
    own = ["doc.*"] if table.schema["doc"].dataType.names != ["none"] else []
    return found.select(*own, "n_tokens", "log_likelihood", F.when(F.col("n_tokens") > 0, F.col("log_likelihood") / F.col("n_tokens")).alias("per_token"))


def score(docs: DataFrame, network: Network, column: str = "text", carry: list[str] | None = None) -> DataFrame:
    """``docs``, or its columns ``carry``, with n_tokens, log_likelihood and per_token."""
    return score_coded(coded(docs, network.lexicon, column, carry), network)


def op9_pseudo_likelihood(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    network, table = train_coded(docs, carry=["doc_id"])
    return score_coded(table, network)
