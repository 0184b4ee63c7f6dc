"""Toxicity by a subsequence string kernel and a support vector machine on Nystroem landmarks.

Units of a text are its words, lower-cased with all but letters taken out (so "id-i*ot" is one
word; digits that stand for letters, as in "1d10t", are read as these), and runs of single letters
joined ("i d i o t").  A unit's letters follow a mark for its start.  Its features are its
subsequences of three, each with weight DECAY ** span, up to SPAN apart: inserted letters lessen a
match, they don't lose it.  a-z have a code each; all other letters share OTHERS codes, so that those
of one alphabet or of one accented Latin block differ.  The kernel of two units is the product of
these features, each scaled by a length that depends on the number of letters only, which keeps it a
kernel.

Landmarks are units of the labelled sentences; the kernel with them gives the Nystroem features on
which a linear machine with squared hinge loss is trained.  Labels belong to texts, not to units:
a toxic text is toxic by its worst unit, so each round takes every toxic text's best-scoring units
as positives and units of clean texts, the worst-scoring ones among them, as negatives, each
weighted by how many texts hold it.  The
decision is linear in the features, so it folds into one table over letter triples, and a unit is
scored without going back to the landmarks.  A text's score is a logistic function of the margins
of its worst distinct units and of how many it has.

Training uses at most about TOXIC + CLEAN labelled texts, drawn by hash, one for each labelled id;
scoring covers all texts.  A unit longer than LONGEST
letters is trained on and scored by its overlapping pieces, of which the worst counts.

Cases: null and empty texts and texts without letters score as having no bad unit; without labels
of both classes every score is 0; repeated rows score alike; other columns stay, but for ``score``
and ``predicted``, which are replaced.
"""

from __future__ import annotations

import heapq
import math
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.llm.shared import hand_back, text_or_empty, tidy

DECAY, SPAN, LETTERS = 0.6, 6, 64
#: Codes: 0 past the end, 1 to 26 a-z, START before the first letter, then those of all other letters.
START, OTHERS = 27, 36
#: Worst units of a text that its score looks at.
WORST = 3
#: Letters of a unit looked at once; longer ones are cut into overlapping pieces.
LONGEST = 24
#: Labelled texts that are trained on, at most about, and landmarks of either kind.
TOXIC, CLEAN, LANDMARKS = 1_000, 2_200, 128
#: Margins that a worker keeps, in two generations, and characters that it scores at once.
MAX_UNITS, TEXTS_AT_ONCE = 120_000, 1_000_000
#: Training rows that are worked on at once.
ROWS_AT_ONCE = 2_048

_DROP = {i: None for i in range(128) if not chr(i).isalpha() and not chr(i).isspace()}
_SPELT = regex.compile(r"(?<!\S)\S(?:\s\S){2,}(?!\S)")
#: Signs that are read as letters beside letters.
_READ_AS = dict(zip("013457@$", "oieastas", strict=True))
_LOOKS = regex.compile(r"(?<=\p{L})[013457@$]+(?=\p{L})|(?<!\S)[013457](?=\p{L}[\p{L}013457@$]{2})")
_GAPS = [(j, k) for k in range(2, SPAN) for j in range(1, k)]


def units(text: str | None) -> list[str]:
    """The units of a text, repeats included."""
    if not text:
        return []
    plain = text.lower()
    if not plain.isascii():
        plain = unicodedata.normalize("NFC", plain)
    plain = _LOOKS.sub(lambda m: "".join(_READ_AS[c] for c in m[0]), plain).translate(_DROP)
    words = plain.split()
    return words + ["".join(run.split()) for run in _SPELT.findall(plain)]


def _codes(batch: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Units as rows of letter numbers behind START, 0 past the end, and their lengths with START."""
    lengths = np.array([len(u) for u in batch])
    points = np.frombuffer("".join(batch).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    table = np.zeros((len(batch), 1 + SPAN + int(lengths.max(initial=1))), np.int64)
    table[:, 0] = START
    rows = np.repeat(np.arange(len(batch)), lengths)
    columns = 1 + np.arange(len(points)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    table[rows, columns] = np.where((points >= 97) & (points <= 122), points - 96, START + 1 + points % OTHERS)
    return table, lengths + 1


def _triples(table: np.ndarray) -> Iterator[tuple[float, np.ndarray, np.ndarray]]:
    """For each pair of gaps the weight, the triples' numbers and whether they lie in the unit."""
    width = table.shape[1] - SPAN
    first = table[:, :width]
    for j, k in _GAPS:
        second, third = table[:, j : j + width], table[:, k : k + width]
        yield DECAY ** (k + 1), (first * LETTERS + second) * LETTERS + third, third > 0


def _scale(lengths: np.ndarray) -> np.ndarray:
    """The length of the features of a unit of so many letters, were its triples all different."""
    squares = sum(DECAY ** (2 * (k + 1)) * np.maximum(lengths - k, 0) for _, k in _GAPS)
    return np.sqrt(np.maximum(squares, DECAY**6))


def features(batch: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The triples that a few units hold, sorted, and the units' features over these."""
    table, lengths = _codes(batch)
    rows = np.broadcast_to(np.arange(len(batch))[:, None], (len(batch), table.shape[1] - SPAN))
    parts = [(weight, rows[inside], triple[inside]) for weight, triple, inside in _triples(table)]
    held = np.unique(np.concatenate([t for _, _, t in parts]))
    out = np.zeros((len(batch), len(held)), np.float32)
    for weight, row, triple in parts:
        np.add.at(out, (row, np.searchsorted(held, triple)), weight)
    return held, out / _scale(lengths)[:, None]


def _pieces(batch: list[str]) -> tuple[list[str], np.ndarray]:
    out, owner = [], []
    for i, u in enumerate(batch):
        for at in range(0, max(1, len(u) - LONGEST // 2), LONGEST // 2) if len(u) > LONGEST else (0,):
            out.append(u[at : at + LONGEST])
            owner.append(i)
    return out, np.array(owner)


def apply_table(batch: list[str], table: np.ndarray) -> np.ndarray:
    """The products of the units' features with ``table``, which holds nothing for triples that
    reach past a unit's end; of a long unit the largest over its pieces."""
    out = np.full(len(batch), -np.inf)
    pieces, owner = _pieces(batch)
    order = np.argsort([len(p) for p in pieces], kind="stable")  # alike lengths together: little padding
    table = table.astype(np.float32)
    for at in range(0, len(order), 8192):
        mine = order[at : at + 8192]
        codes, lengths = _codes([pieces[i] for i in mine])
        codes = codes.astype(np.int32)
        width = codes.shape[1] - SPAN
        first, seconds = codes[:, :width] * (LETTERS * LETTERS), codes * LETTERS
        sums = np.zeros(len(mine), np.float32)
        for j, k in _GAPS:
            sums += np.float32(DECAY ** (k + 1)) * table.take(first + seconds[:, j : j + width] + codes[:, k : k + width]).sum(1)
        np.maximum.at(out, owner[mine], sums / _scale(lengths))
    return out


def products(batch: list[str], held: np.ndarray, base: np.ndarray) -> np.ndarray:
    """(units, landmarks): the kernel of units of at most LONGEST letters with features ``base`` over
    the triples ``held``."""
    out, columns = [], np.ascontiguousarray(np.c_[base, np.zeros(len(base), base.dtype)].T)
    place = np.full(LETTERS**3, len(held), np.int32)  # all other triples: the column of zeros
    place[held] = np.arange(len(held))
    for at in range(0, len(batch), 256):
        codes, lengths = _codes(batch[at : at + 256])
        sums = np.zeros((len(codes), len(base)), np.float32)
        for weight, triple, inside in _triples(codes):
            rows, places = np.nonzero(inside)
            if len(rows):
                starts = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
                sums[rows[starts]] += np.float32(weight) * np.add.reduceat(columns[place[triple[rows, places]]], starts)
        out.append(sums / _scale(lengths)[:, None])
    return np.concatenate(out)


def with_insertion(unit: str, rng: np.random.Generator) -> str:
    """The unit with one letter put in."""
    at = int(rng.integers(1, len(unit)))
    return unit[:at] + chr(97 + int(rng.integers(26))) + unit[at:]


def summary(margins) -> list[float]:
    """What the logistic curve sees of a text: its WORST largest margins and the log of how many
    distinct units it has.  Missing margins are -1."""
    top = heapq.nlargest(WORST, margins)
    return [max(-2.0, min(2.0, m)) for m in top] + [-1.0] * (WORST - len(top)) + [math.log1p(len(margins))]


class Machine:
    """The folded machine: a table over triples and the bias, and the logistic curve of texts."""

    def __init__(self, table: np.ndarray, bias: float):
        self.table, self.bias = table.astype(np.float32), float(bias)
        self.curve = np.zeros(WORST + 2)
        self.young: dict[str, float] = {}
        self.old: dict[str, float] = {}

    def __getstate__(self):
        return {**self.__dict__, "young": {}, "old": {}}

    def margins(self, batch: list[str]) -> np.ndarray:
        return apply_table(batch, self.table) + self.bias if batch else np.empty(0)

    def probability(self, summaries: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(summaries @ self.curve[:-1] + self.curve[-1], -40, 40)))

    def scores(self, texts: list[str | None]) -> np.ndarray:
        found, group, size = [], [], 0
        for i, text in enumerate(texts):
            group.append(text)
            size += len(text or "")
            if size >= TEXTS_AT_ONCE or i + 1 == len(texts):
                found += self._summaries(group)
                group, size = [], 0
        return self.probability(np.array(found)) if found else np.empty(0)

    def _summaries(self, texts: list[str | None]) -> list[list[float]]:
        if len(self.young) >= MAX_UNITS:
            self.young, self.old = {}, self.young
        split, young, old = [set(units(t)) for t in texts], self.young, self.old
        unseen = []
        for u in set().union(*split):
            if u not in young:
                if u in old:
                    young[u] = old[u]
                else:
                    unseen.append(u)
        young.update(zip(unseen, self.margins(unseen).tolist(), strict=True))
        return [summary([young[u] for u in words]) for words in split]


def squared_hinge(x: np.ndarray, y: np.ndarray, weight: np.ndarray, cost: float) -> np.ndarray:
    """The linear machine (last number: bias) that minimises |w|^2 / 2 + cost * sum of weighted
    squared hinge losses, by Newton steps on the rows inside the margin, summed over blocks of rows."""
    w = np.zeros(x.shape[1] + 1)
    ridge = np.eye(len(w))
    ridge[-1, -1] = 1e-3
    for _ in range(25):
        left, right = ridge.copy(), np.zeros(len(w))
        for at in range(0, len(x), ROWS_AT_ONCE):
            block, goal = np.c_[x[at : at + ROWS_AT_ONCE], np.ones(len(x[at : at + ROWS_AT_ONCE]))], y[at : at + ROWS_AT_ONCE]
            inside = goal * (block @ w) < 1
            xi, ci = block[inside], (2 * cost * weight[at : at + ROWS_AT_ONCE][inside])[:, None]
            left += xi.T @ (xi * ci)
            right += (xi * ci).T @ goal[inside]
        new = np.linalg.solve(left, right)
        if np.abs(new - w).max() < 1e-6:
            break
        w = new
    return w


def _first_guess(toxic: list[tuple[str, ...]], clean: list[tuple[str, ...]]) -> dict[str, float]:
    """How much more often stretches of four and five letters stand in toxic than in clean texts."""
    def stretches(text: tuple[str, ...]) -> set[str]:
        return {u[i : i + n] for u in text for n in (4, 5) for i in range(len(u) - n + 1)}

    bad: Counter = Counter()
    for t in toxic:
        bad.update(stretches(t))
    bad = Counter({s: n for s, n in bad.items() if n > 1})
    good: Counter = Counter()
    for t in clean:
        good.update(stretches(t) & bad.keys())
    return {s: np.log((n + 0.05) / (len(toxic) + 1)) - np.log((good[s] + 0.5) / (len(clean) + 1)) + np.log(n) for s, n in bad.items()}


def guessed(unit: str, guess: dict[str, float]) -> float:
    return max((guess.get(unit[i : i + n], -9.0) for n in (4, 5) for i in range(len(unit) - n + 1)), default=-9.0)


def worst_pieces(batch: list[str], machine: Machine | None, guess: dict[str, float]) -> list[str]:
    """Of each long unit the piece that the machine, or before it the first guess, finds worst."""
    if not batch:
        return []
    pieces, owner = _pieces(batch)
    value = machine.margins(pieces) if machine else np.array([guessed(p, guess) for p in pieces])
    best = np.lexsort((-value, owner))
    return [pieces[i] for i in best[np.r_[True, owner[best][1:] != owner[best][:-1]]]]


def fit(toxic: Iterable[list[str]], clean: Iterable[list[str]], clean_weight: float = 1.0, rounds: int = 3, seed: int = 3) -> Machine | None:
    """Trains on the units of toxic and of clean texts."""
    rng = np.random.default_rng(seed)
    same: dict[str, str] = {}  # one string object for each unit, however many texts hold it
    bad, good = ([tuple(dict.fromkeys(same.setdefault(u, u) for u in t)) for t in texts if t] for texts in (toxic, clean))
    in_clean = Counter(u for t in good for u in t)
    pool, own = sorted(in_clean), sorted(set().union(*bad))
    del same
    guess = _first_guess(bad, good)
    value = {u: guessed(u, guess) for u in own}
    long_, machine = sorted(u for u in {*own, *pool} if len(u) > LONGEST), None
    ratio = len(bad) / len(good) if good else 1.0
    sample = [pool[i] for i in rng.choice(len(pool), min(len(pool), 12_000), replace=False)]
    common = sorted(pool, key=lambda u: (-in_clean[u], u))[:2_000]
    hard: list[str] = []
    for _ in range(rounds):
        positives = Counter(u for t in bad for u in sorted(t, key=lambda u: (-value[u], u))[:2])
        positives = Counter({u: n for u, n in positives.items() if in_clean[u] * ratio < n})
        if not positives:
            break
        negatives = [u for u in dict.fromkeys(common + sample + hard) if u not in positives]
        worst = dict(zip(long_, worst_pieces(long_, machine, guess), strict=True))
        shown = lambda u: worst.get(u, u)
        marks = list(dict.fromkeys(shown(u) for u in [*(u for u, _ in positives.most_common(LANDMARKS)), *hard[: LANDMARKS // 2], *sample[:LANDMARKS]]))
        held, base = features(marks)
        power, basis = np.linalg.eigh((base @ base.T).astype(float))
        keep = power > 1e-6 * power.max()
        to_features = basis[:, keep] / np.sqrt(power[keep])
        gapped = {with_insertion(shown(u), rng): n / 2 for u, n in positives.items() if len(u) > 3 for _ in range(2)}
        gapped = {u: n for u, n in gapped.items() if u not in positives and u not in in_clean}
        rows = [*positives, *gapped, *negatives]
        x = np.empty((len(rows), to_features.shape[1]))
        for at in range(0, len(rows), ROWS_AT_ONCE):
            x[at : at + ROWS_AT_ONCE] = products([shown(u) for u in rows[at : at + ROWS_AT_ONCE]], held, base) @ to_features
        y = np.r_[np.ones(len(positives) + len(gapped)), -np.ones(len(negatives))]
        weight = np.r_[list(positives.values()), list(gapped.values()), [max(0.3, in_clean[u] * ratio) for u in negatives]]
        w = squared_hinge(x, y, np.minimum(weight, 20.0), 1.0)
        del x
        table = np.zeros(LETTERS**3)
        table[held] = (to_features @ w[:-1]) @ base
        machine = Machine(table, w[-1])
        margin = dict(zip(pool, machine.margins(pool).tolist(), strict=True))
        hard = list(dict.fromkeys(hard + sorted(pool, key=lambda u: -margin[u])[:1500]))
        value = dict(zip(own, machine.margins(own).tolist(), strict=True))
    else:
        margin |= value
        x = np.array([summary([margin[u] for u in t]) for t in bad + good])
        machine.curve = logistic_curve(x, np.r_[np.ones(len(bad)), np.zeros(len(good))], np.r_[np.ones(len(bad)), np.full(len(good), clean_weight)])
        return machine
    return None


def logistic_curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weights and constant of the likeliest logistic curve, slightly drawn to flatness."""
    x = np.c_[x, np.ones(len(x))]
    line = np.zeros(x.shape[1])
    ridge = np.full(len(line), 0.5)
    ridge[-1] = 1e-6
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ line, -30, 30)))
        slope = x.T @ (weight * (p - y)) + ridge * line
        move = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(ridge), slope)
        line = line - np.clip(move, -3, 3)
        if np.abs(move).max() < 1e-8:
            break
    return line


def held_out(id_column: Column) -> Column:
    return F.pmod(F.crc32(id_column.cast("string").cast("binary")), F.lit(5)) == 0


def train(texts: DataFrame, labels: DataFrame) -> Machine | None:
    """A machine from (id, text) and (id, toxic): at most about TOXIC and CLEAN texts, drawn by a hash
    of id.  The drawn labels, so many at most, go to the texts, which stay where they are; of an id
    that several rows hold one text is taken, the least by its hash, before anything is gathered."""
    labels = labels.where(F.col("toxic").isin(0, 1) & F.col("id").isNotNull())
    sizes = {r["toxic"]: r["n"] for r in labels.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not sizes.get(0) or not sizes.get(1):
        return None
    draw = F.pmod(F.xxhash64(F.lit(17), "id"), F.lit(1_000_000)) / 1_000_000.0
    wanted = F.when(F.col("toxic") == 1, F.lit(TOXIC / sizes[1])).otherwise(F.lit(CLEAN / sizes[0]))
    drawn = labels.where(draw < wanted).select("id", F.col("toxic").cast("int").alias("toxic"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"id": batch.id, "toxic": batch.toxic, "units": [" ".join(sorted(set(units(t)))) for t in batch.text]})

    found = texts.join(F.broadcast(drawn), "id").select(F.col("id").cast("string").alias("id"), "text", "toxic").mapInPandas(tidy(run), "id string, toxic int, units string")
    one = found.groupBy("id", "toxic").agg(F.min(F.struct(F.xxhash64("units").alias("h"), "units")).alias("one"))
    rows = one.select("toxic", "one.units").toPandas().sort_values(["toxic", "units"])
    bad, good = ([u for u in rows.units[rows.toxic == t] if u] for t in (1, 0))
    if not bad or not good:
        return None
    share = sizes[0] / sizes[1] * len(bad) / len(good)
    machine = fit((u.split(" ") for u in bad), (u.split(" ") for u in good), clean_weight=share)
    del rows, bad, good
    hand_back()
    return machine


def probability_of(spark, machine: Machine | None, text: Column) -> Column:
    """The score of a text column.  Only the texts go to Python, and only numbers come back."""
    if machine is None:
        return F.lit(0.0)
    shared = spark.sparkContext.broadcast(machine)  # one table of LETTERS ** 3 numbers

    @F.arrow_udf("double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        here = shared.value
        for texts in batches:
            found = [here.scores(texts.slice(at, 500).to_pylist()) for at in range(0, len(texts), 500)]
            yield pa.array(np.concatenate([np.empty(0), *found]), pa.float64())
        here.young, here.old = {}, {}  # the worker lives on for other tasks
        hand_back()

    return run(text)


def score(docs: DataFrame, machine: Machine | None, column: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on)."""
    scored = docs.drop("predicted").withColumn("score", probability_of(docs.sparkSession, machine, F.col(column)))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def machine_from(spark, sf_dir: str) -> Machine | None:
    """Trained on the labels whose ids aren't held out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out(F.col("doc_id"))).groupBy(F.col("doc_id").alias("id")).agg(F.max("toxic").alias("toxic"))
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").alias("id"), text_or_empty("text").alias("text"))
    return train(texts, labels)


def op6_string_kernel(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    scored = score(docs, machine_from(spark, sf_dir))
    return scored.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", "predicted")
