"""Each operator against brute force or an exact round trip, and on awkward rows."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from kinfold.llm import bpe, components, imatch, licenses, lines, mixing, pseudo_lm, setsketch, sharding, shared, shingles, toxicity, vectors

SMALL = "/root/testdata/sf0.001"
TOKENIZER = "byte_bpe_multi_50k.tiktoken"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "lorem ipsum dolor " * 30_000
AWKWARD = [
    (1, None, "en", "b", 0), (2, "", None, None, 0), (3, "  \t\n ", "en", "a", 5), (4, "word", "en", "a", 4), (4, "word", "en", "a", 4),
    (5, "All rights reserved.\nÀ côté é", "fr", "b", 30), (None, "no id here at all, none", "en", "a", 20), (None, None, None, None, None),
    (6, LONG, "en", "c", len(LONG)), (7, "a b c d e f g", "en", "", 13), (8, "a b c d e f g", "en", "c", 13), (9, "a b c d e f g", "en", "c", 13),
]


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame([(*r, i) for i, r in enumerate(AWKWARD)], SCHEMA + ", score int")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words_of(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set())


def brute_components(ids, linked):
    root = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            m = min(root[a], root[b])
            changed |= (root[a], root[b]) != (m, m)
            root[a] = root[b] = m
    return root


# ---- op1


def test_multi_sequence_is_sorted_and_whole():
    rng = np.random.default_rng(0)
    a, b = rng.random(7), rng.random(5)
    met = list(vectors.multi_sequence(a, b, 1.1))
    sums = [a[i] + b[j] for i, j in met]
    assert sums == sorted(sums)
    assert set(met) == {(i, j) for i in range(7) for j in range(5) if a[i] + b[j] <= 1.1}


def test_vectors_against_brute_force(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(150, 16))
    rows = [(i, (base[i % 150] + rng.normal(scale=0.02 * (i // 150), size=16)).astype("float32").tolist()) for i in range(600)]
    rows += [(700 + i, rows[3][1]) for i in range(40)] + [(800, None), (801, []), (802, [0.0] * 16), (803, [1.0] * 15 + [float("nan")]), (804, [None] + [1.0] * 15), (805, [1.0] * 3), (806, [float("inf")] + [1.0] * 15)]
    got = {r.vec_id: r for r in vectors.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()}
    good = [(i, np.array(v, "f4").astype(float)) for i, v in rows if i < 800]
    m = np.array([v for _, v in good])
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    near = m @ m.T >= 0.95
    ids = [i for i, _ in good]
    links = [(ids[i], ids[j]) for i, j in zip(*np.nonzero(near), strict=True) if i != j]
    root = brute_components(ids, links)
    assert len(got) == len(rows)
    found = sum(got[i].n_links for i in ids)
    assert found <= len(links) and found >= 0.999 * len(links)
    assert all(got[i].component_id == root[i] and got[i].kept == (root[i] == i) for i in ids)
    assert all(got[i].n_links == 0 and got[i].component_id == i and got[i].kept for i in range(800, 807))


def test_vectors_with_few_links(spark, monkeypatch):
    """One link in the first queries, a tight one, mustn't narrow the search for the others."""
    monkeypatch.setattr(vectors, "QUERIES", 40)
    monkeypatch.setattr(vectors, "CELL_ROWS", 4)
    rng = np.random.default_rng(2)
    base = rng.normal(size=(900, 64))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    apart = rng.normal(size=(200, 64)) / 8
    apart -= (apart * base[:200]).sum(1, keepdims=True) * base[:200]
    apart /= np.linalg.norm(apart, axis=1, keepdims=True)
    cosine = rng.uniform(0.951, 0.97, (200, 1))
    m = np.r_[base, cosine * base[:200] + np.sqrt(1 - cosine**2) * apart, base[300:] + 1e-4]
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "vec_id long, embedding array<double>")
    got = {r.vec_id: r.n_links for r in vectors.near_duplicates(rows).collect()}
    unit = m / np.linalg.norm(m, axis=1, keepdims=True)
    want = (unit @ unit.T >= 0.95).sum(1) - 1
    assert sum(got.values()) >= 0.99 * want.sum()
    monkeypatch.setattr(vectors, "neighbour_bins", lambda *a: {0: 1})
    nodes = spark.createDataFrame([(i, v.astype("<f8").tobytes()) for i, v in enumerate(unit[:60])], "node long, packed binary")
    assert vectors.fit_index(nodes, 64, 60, 0.95, 1.0).bound >= 0.1 - 1e-9


def test_vectors_empty(spark):
    assert vectors.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


# ---- op2


def published_jump(key, n):
    key, b, j = key & (2**64 - 1), -1, 0
    while j < n:
        b, key = j, (key * 2862933555777941757 + 1) & (2**64 - 1)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


@pytest.mark.parametrize("n", [1, 2, 8, 63])
def test_jump_hash_is_the_published_one(spark, n):
    rows = spark.range(200).select(F.xxhash64("id").alias("k")).withColumn("w", sharding.jump_walk(F.col("k"), n)).collect()
    assert all((r.w.shard, r.w.grown) == (published_jump(r.k, n), published_jump(r.k, n + 1)) for r in rows)


def test_jump_draws_at_the_edge_of_a_step(spark):
    """States whose low 33 bits are all ones, or none, are where a rounded division would go wrong."""
    inverse = pow(2862933555777941757, -1, 2**64)
    states = [(h << 33) + low for h in (0, 1, 2, 5, 77, 2**30, 2**31 - 1) for low in (0, 2**33 - 1)]
    keys = [(k - 2**64 if k >= 2**63 else k,) for s in states for k in [(s - 1) * inverse % 2**64]]
    rows = spark.createDataFrame(keys, "k long").withColumn("w", sharding.jump_walk(F.col("k"), 50)).collect()
    assert all((r.w.shard, r.w.grown) == (published_jump(r.k, 50), published_jump(r.k, 51)) for r in rows)


def test_slots_do_not_follow_the_layout(spark):
    rows = [(7, f"t{i % 50}") for i in range(300)] + [(i, "x") for i in range(100)] + [(None, "y")] * 30
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("slot", F.lit("clash")).withColumn("shard", F.lit(0))
    slots = lambda d: sorted(map(str, sharding.with_slots(sharding.assign_shards(d, ["doc_id"], 4), ["doc_id", "text"]).collect()))
    assert slots(df.repartition(5)) == slots(df.coalesce(1)) and len(slots(df)) == len(rows)


def test_shards_and_slots(spark, docs, awkward):
    for df in (docs, awkward):
        placed = sharding.with_slots(sharding.assign_shards(df, ["doc_id"], 8), ["doc_id"]).collect()
        assert len(placed) == df.count()
        for s in range(8):
            slots = sorted(r.slot for r in placed if r.shard == s)
            assert slots == list(range(len(slots)))
        assert all(r.grown_shard in (r.shard, 8) for r in placed)
    out = sharding.op2_jump_shards(spark, SMALL)
    assert all(r.text_crc32 == zlib.crc32(t.encode()) and r.size == len(t.encode()) + 1 for r, t in ((r, r.text) for r in out.join(docs, "doc_id").collect()))


# ---- op3


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers

    return bpe.Tokenizer(*bpe.vocabulary(public_tokenizers.path(TOKENIZER)), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def encoding(tokenizer):
    tiktoken = pytest.importorskip("tiktoken")
    import public_tokenizers

    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokenizer.tokens)}, special_tokens={})


def test_bpe_equals_the_library(tokenizer, encoding):
    rng = random.Random(2)
    texts = ["".join(rng.choice("ab cé1\n zzщ的!'st 😀") for _ in range(rng.randint(0, 200))) for _ in range(400)] + ["a" * 5000, "ab" * 3000, "  \n" * 500, LONG[:20000]]
    for text, ids in zip(texts, tokenizer.encode(texts), strict=True):
        assert ids == encoding.encode_ordinary(text)
        assert tokenizer.decode(ids) == text.encode()


def test_bpe_appends_and_edits(tokenizer):
    rng = random.Random(3)
    table = bpe.PrefixTable(tokenizer.encoder, b"the quick brown fox jumps over the lazy dog " * 20)
    for _ in range(150):
        at = rng.randint(0, len(table.data))
        done = table.edit(at, min(len(table.data), at + rng.randint(0, 4)), rng.choice([b"", b"x", b"ing", "é".encode()]))
        assert table.ids() == bpe.PrefixTable(tokenizer.encoder, table.data).ids()
        assert done <= 8 * tokenizer.encoder.longest
    table.append(b" and more")
    assert table.ids() == bpe.PrefixTable(tokenizer.encoder, table.data).ids()


def test_bpe_in_spark(spark, awkward, empty, encoding):
    import public_tokenizers

    path = public_tokenizers.path(TOKENIZER)
    for r in bpe.digests(awkward, path, public_tokenizers.PATTERN).collect():
        ids = encoding.encode_ordinary(r.text or "")
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
    back = bpe.decode(bpe.encode(awkward, path, public_tokenizers.PATTERN), path, public_tokenizers.PATTERN)
    assert all(bytes(r.decoded) == (r.text or "").encode() for r in back.collect())
    assert bpe.digests(empty, path, public_tokenizers.PATTERN).count() == 0


# ---- op4


def brute_lines(texts, least):
    key = lambda x: re.sub("[A-Z]", lambda m: m[0].lower(), x.strip(" \t\n\x0b\x0c\r"))
    holds = {}
    for t in texts:
        for k in {key(x) for x in (t or "").split("\n")} - {""}:
            holds[k] = holds.get(k, 0) + 1
    out = []
    for t in texts:
        split = (t or "").split("\n")
        kept = [x for x in split if holds.get(key(x), 0) < least]
        out.append((len(split), len(split) - len(kept), "\n".join(kept)))
    return out


@pytest.mark.parametrize("least,batches,fanout", [(2, 5, 2), (3, 1, 4), (4, 9, 3)])
def test_line_dedup_against_brute_force(spark, least, batches, fanout):
    rng = random.Random(least)
    texts = ["\n".join(rng.choice(["A line", " a LINE\t", "b", "É", "é", "", "  ", f"own {i}", "c\r"]) for _ in range(rng.randint(0, 6))) for i in range(60)] + [None, "", "\n", "A line"] + ["copied\nA line"] * 5
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("keys", F.lit(1)).repartition(4)
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.text or "") for r in lines.drop_frequent_lines(df, least, batches, fanout).collect()}
    assert [got[i] for i in range(len(texts))] == brute_lines(texts, least)


def test_line_dedup_awkward(spark, awkward, empty):
    got = lines.drop_frequent_lines(awkward, 2).collect()
    want = sorted(brute_lines([r[1] for r in AWKWARD], 2))
    assert sorted((r.n_lines, r.n_dropped, r.text or "") for r in got) == want
    assert lines.drop_frequent_lines(empty).count() == 0


# ---- op5


@pytest.mark.parametrize("k", [2, 5])
def test_shingle_sets(k):
    texts = [r[1] or "" for r in AWKWARD] + ["A  b\x0bC " * 5, "x" * (1 << 21) + " y z"]
    sets = list(shingles.shingle_sets([t.encode() for t in texts], k))
    for t, s in zip(texts, sets, strict=True):
        assert len(s) == len(words_of(t, k))
    assert np.array_equal(*(next(iter(shingles.shingle_sets([t], k))) for t in (b"One two\tthree", b"one  TWO three\n")))


def test_workers_hold_little_and_hand_it_back(monkeypatch):
    batches = [pa.RecordBatch.from_pydict({"x": list(range(n))}) for n in (0, 3, 2 * shared.SLICE + 7)]
    cut = list(shared.slices(iter(batches)))
    assert max(b.num_rows for b in cut) <= shared.SLICE and [x for b in cut for x in b.column(0).to_pylist()] == [x for b in batches for x in b.column(0).to_pylist()]
    returned = []
    monkeypatch.setattr(shared, "hand_back", lambda: returned.append(1))
    assert list(shared.tidy(lambda rows: (2 * x for x in rows))(iter([1, 2]))) == [2, 4] and returned == [1]
    assert sum(len(p) for p in shingles._Powers().of(100)) * 8 <= 10_000_000  # a worker keeps them
    texts = [b"One two " * 90_000, b"", b"three  four five six seven eight"]
    assert [len(s) for s in shingles.shingle_sets(texts, 5)] == [2, 0, 2]


def test_small_tables_are_few_files(spark, docs, monkeypatch):
    held = {"spark.sql.shuffle.partitions": "24", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        most = shared.CORE_FILES * spark.sparkContext.defaultParallelism
        found = components.components(spark.range(2_000).select(F.col("id").alias("a"), (F.col("id") % 7).alias("b")))
        assert len(found.inputFiles()) <= most and found.agg(F.count("*"), F.sum("component")).first() == (2_000, sum(i % 7 for i in range(2_000)))
        assert len(lines.dropped_positions(docs, 2, 2, 4).inputFiles()) <= most
        for stage in (corpus_pipeline.drop_repeated_lines, corpus_pipeline.drop_near_duplicates, corpus_pipeline.mix_sources):
            assert stage(spark, docs, SMALL).rdd.getNumPartitions() <= most
        numbers = spark.range(0, 5_000, 1, 100)
        assert shared.in_few(numbers).rdd.getNumPartitions() == 1 and shared.in_few(numbers).agg(F.sum("id")).first()[0] == 4_999 * 2_500
        monkeypatch.setattr(shared, "FILE", 400)  # read in full: 40,000 bytes are 100 files
        assert shared.in_few(numbers).rdd.getNumPartitions() == 100
        assert shared.in_few(spark.createDataFrame(numbers.rdd, "id long")).rdd.getNumPartitions() == 100  # of unknown size
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(5)
    a, b = (rng.integers(0, 2**63, 900, dtype=np.uint64) for _ in range(2))
    both = np.minimum(setsketch.minima(a), setsketch.minima(b))
    assert np.array_equal(both, setsketch.minima(np.r_[a, b]))
    errors = []
    for share in (0.3, 0.6, 0.8, 0.95):
        for _ in range(30):
            n = int(900 * 2 * share / (1 + share))
            x = rng.integers(0, 2**63, 900, dtype=np.uint64)
            y = np.r_[x[:n], rng.integers(0, 2**63, 900 - n, dtype=np.uint64)]
            p, q = (setsketch.registers(setsketch.minima(v)).astype(int) for v in (x, y))
            j = setsketch.likeliest(np.array([(p > q).sum()]), np.array([(p < q).sum()]), np.array([900.0]), np.array([900.0]))[0]
            errors.append(j - n / (1800 - n))
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06 and max(map(abs, errors)) < setsketch.MARGIN


def test_common_counts():
    rng = np.random.default_rng(6)
    a, b = ([np.unique(rng.integers(0, 300, rng.integers(1, 200)).astype(np.uint64)) for _ in range(n)] for n in (7, 9))
    assert np.array_equal(setsketch.common_counts(a, b), [[len(np.intersect1d(x, y)) for y in b] for x in a])


def test_near_duplicates_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(setsketch, "BLOCK", 16)
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = []
    for group in range(40):
        base = [rng.choice(vocabulary) for _ in range(60)]
        for copy in range(rng.choice([1, 2, 5, 40 if group == 0 else 3])):
            w = list(base)
            for _ in range(copy % 9):
                w[rng.randrange(60)] = rng.choice(vocabulary)
            texts.append(" ".join(w))
    texts += [texts[3]] * 30 + ["", None, " \n", "one", "ONE", "one two", "One  two"]
    rng.shuffle(texts)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in setsketch.near_duplicates(df, words=2).collect()}
    sets = [words_of(t, 2) for t in texts]
    linked = [(i, j) for i in range(len(texts)) for j in range(i) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    root = brute_components(range(len(texts)), linked)
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in got.items()} == {i: (len(sets[i]), root[i], root[i] == i) for i in range(len(texts))}


def test_near_duplicates_with_shared_ids(spark, monkeypatch):
    """Rows that share an id are documents of their own: no text's links are lost."""
    a, b = (" ".join(f"{w}{i}" for i in range(60)) for w in "ab")
    got = setsketch.near_duplicates(spark.createDataFrame([(1, a), (1, b), (2, a + " x"), (3, b + " y"), (None, a)], "doc_id long, text string"), words=2).collect()
    assert sorted((r.doc_id, r.component_id, r.kept) for r in got if r.doc_id) == [(1, 1, True), (1, 1, True), (2, 1, False), (3, 1, False)]
    assert [(r.component_id, r.kept) for r in got if r.doc_id is None] == [(None, True)]
    monkeypatch.setattr(setsketch, "BLOCK", 8)
    monkeypatch.setattr(setsketch, "STARS", 0)
    rng = random.Random(17)
    texts = []
    for _ in range(25):
        base = [f"w{rng.randrange(300)}" for _ in range(50)]
        for _ in range(rng.choice([1, 2, 6, 20])):
            w = list(base)
            for _ in range(rng.randrange(7)):
                w[rng.randrange(50)] = f"w{rng.randrange(300)}"
            texts.append(" ".join(w))
    rows = [(rng.randrange(60), t) for t in texts]
    sets = [words_of(t, 2) for t in texts]
    linked = [(i, j) for i in range(len(texts)) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    root = brute_components(range(len(texts)), linked)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[root[i]] = min(d, least.get(root[i], d))
    got = setsketch.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=2).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted((d, len(sets[i]), least[root[i]]) for i, (d, _) in enumerate(rows))


def test_near_duplicates_awkward(spark, awkward, empty):
    got = setsketch.near_duplicates(awkward, words=2).collect()
    assert len(got) == len(AWKWARD)
    assert {r.doc_id: r.component_id for r in got if r.doc_id in (4, 7, 8, 9)} == {4: 4, 7: 7, 8: 7, 9: 9}
    assert all(r.kept for r in got if r.n_shingles == 0)
    assert setsketch.near_duplicates(empty).count() == 0


def test_components(spark):
    rng = random.Random(8)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(500 + i, 501 + i) for i in range(40)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    root = brute_components({x for e in links for x in e}, links)
    assert got == {n: r for n, r in root.items() if n in {x for a, b in links if a != b for x in (a, b)}}


# ---- op6


def test_kernel_of_gapped_units():
    def k(a, b):
        held, base = toxicity.features([a])
        return float(toxicity.products([b], held, base)[0, 0])

    assert k("moan", "moan") == pytest.approx(1, abs=1e-5)
    assert k("idiot", "idxiot") > 0.5 > k("idiot", "garden")
    assert k("achlich", "achlicher") > k("achlich", "bachlich") > k("achlich", "garten")  # the start counts
    assert k("\u00e4\u00df\u00e4\u00df", "\u00e9\u00e8\u00e9\u00e8") < 0.1  # accented letters differ
    assert toxicity.units("an id-i*ot, i d i o t!") == ["an", "idiot", "i", "d", "i", "o", "t", "idiot"]
    assert toxicity.units("1d10t 2015 e\u0301t\u00e9 sc$m$$$ 1mbecile") == ["idiot", "\u00e9t\u00e9", "scsm", "imbecile"]
    held, base = toxicity.features(["idiot", "worthless"])
    brute = np.zeros(toxicity.LETTERS**3)
    codes = [toxicity.START] + [ord(c) - 96 for c in "worthy"]
    for i, j, m in itertools.combinations(range(len(codes)), 3):
        if m - i < toxicity.SPAN:
            brute[(codes[i] * toxicity.LETTERS + codes[j]) * toxicity.LETTERS + codes[m]] += toxicity.DECAY ** (m - i + 1)
    brute /= toxicity._scale(np.array([7]))[0]
    assert np.allclose(toxicity.products(["worthy"], held, base)[0], base @ brute[held], atol=1e-6)
    table = np.arange(toxicity.LETTERS**3) / 1e5
    table[:: toxicity.LETTERS] = 0  # triples that reach past the end
    assert toxicity.apply_table(["worthy"], table)[0] == pytest.approx(brute @ table, rel=1e-4)


def test_long_units_are_learnt_from_their_worst_piece():
    rng = random.Random(3)
    harmless = lambda: "".join(rng.choice(["garden", "meadow", "window", "spring"]) for _ in range(5))
    bad = [[harmless() + "worthlessidiot", "the"] for _ in range(60)]
    machine = toxicity.fit(bad, [[harmless(), "the", "and"] for _ in range(200)], 1.0)
    assert machine.margins(["worthlessidiot"])[0] > 0 > max(machine.margins(["garden", "meadowwindow"]))


def test_toxicity_on_held_out_labels(spark):
    """Recall and precision on the labels that were not learnt from, by language."""
    found = toxicity.op6_string_kernel(spark, "/root/testdata/sf0.1").join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id").join(spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "lang"), "doc_id")
    rows = found.where("held_out").select("lang", "toxic", "predicted").collect()
    share = lambda part: np.mean([r.predicted == r.toxic for r in part])
    assert len(rows) > 800 and share(rows) >= 0.975 and share([r for r in rows if not r.toxic]) >= 0.99 and share([r for r in rows if r.toxic]) >= 0.85
    for lang, least in (("en", 0.88), ("fr", 0.9), ("es", 0.9), ("de", 0.6)):
        assert share([r for r in rows if r.toxic and r.lang == lang]) >= least, lang


def test_repeated_labelled_ids_are_gathered_once(spark):
    texts = spark.createDataFrame([(1, f"idiot {i}") for i in range(50)] + [(2 + i, "garden and word") for i in range(9)], "id long, text string")
    seen = []
    labels = texts.select("id", (F.col("id") == 1).cast("int").alias("toxic")).distinct()
    fit, toxicity.fit = toxicity.fit, lambda bad, good, **k: seen.append((list(bad), list(good)))
    try:
        toxicity.train(texts, labels)
    finally:
        toxicity.fit = fit
    assert (len(seen[0][0]), len(seen[0][1])) == (1, 9)


def test_toxicity_learns_insults():
    rng = random.Random(9)
    syllables = ["the", "on", "er", "ing", "ou", "tion", "ha", "ble", "st", "re"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
    bad_words = ["idiot", "scum", "moron", "stupid", "loser", "trash"]

    def text(bad, change=lambda w: w):
        w = [word() for _ in range(80)]
        for _ in range(3 * bad):
            w.insert(rng.randrange(len(w)), change(rng.choice(bad_words)))
        return " ".join(w)

    machine = toxicity.fit([toxicity.units(text(True)) for _ in range(150)], [toxicity.units(text(False)) for _ in range(600)], 2.0)
    tests = [text(i % 4 == 0) for i in range(400)]
    assert np.mean((machine.scores(tests) >= 0.5) == (np.arange(400) % 4 == 0)) > 0.98
    spaced = [text(True, lambda w: w[:2] + "-" + w[2:] + "!") for _ in range(50)]
    assert (machine.scores(spaced) >= 0.5).mean() > 0.95
    inserted = [text(True, lambda w: w[:3] + "x" + w[3:]) for _ in range(50)]
    assert machine.scores(inserted).mean() > 5 * machine.scores(tests[1::4]).mean()


def test_toxicity_in_spark(spark, awkward, empty):
    machine = toxicity.fit([["idiot", "the"]] * 20, [["the", "and", "garden", "word"]] * 60)
    got = toxicity.score(awkward, machine).collect()
    assert len(got) == len(AWKWARD) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert toxicity.score(empty, machine).count() == 0
    assert {r.score for r in toxicity.score(awkward, None).collect()} == {0.0}
    assert toxicity.train(awkward.select(F.col("doc_id").alias("id"), "text"), empty.select(F.col("doc_id").alias("id"), F.lit(1).alias("toxic"))) is None


# ---- op7


def test_imatch_against_brute_force(spark):
    rows = {r.doc_id: r for r in imatch.op7_imatch(spark, SMALL).collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    order = sorted(texts, reverse=True)
    edits = {}
    for i, d in enumerate(order):
        t, after = texts[d], texts[order[(i + 1) % len(order)]]
        cut = len(t) // 3
        edits[d] = t[: len(t) - cut] + after[:cut]
        assert (rows[d].n_chars, rows[d].edited_sha256) == (len(t), hashlib.sha256(edits[d].encode()).hexdigest())
    prints = {}
    for d, r in rows.items():
        assert prints.setdefault(texts[d], r.fingerprint) == r.fingerprint
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        a, b = r.fingerprint.split("."), r.edited_fingerprint.split(".")
        either = [(x, y) for x, y in zip(a, b, strict=True) if (x, y) != ("-", "-")]
        assert r.near_edited == pytest.approx(sum(x == y for x, y in either) / len(either) if either else 1.0)
    mean = lambda c: np.mean([r[c] for r in rows.values()])
    assert mean("near_edited") > 5 * mean("near_next")
    # the lexicon, the kept terms and the hashes anew
    words = {kind: {d: {" ".join(w) for w in words_of(t, 1)} for d, t in part.items()} for kind, part in (("own", texts), ("edited", edits))}
    holds = Counter(w for ws in words["own"].values() for w in ws)
    known = sorted(w for w, n in holds.items() if max(2, 0.02 * len(texts)) <= n <= max(2, 0.06 * len(texts)))
    short = lambda ws: hashlib.md5(" ".join(sorted(ws)).encode()).hexdigest()[:8]

    def brute(ws):
        kept = ws & set(known)
        if not kept:
            return [short(ws)] + ["-"] * 31
        return [short(s) if (s := {w for w in kept if hashlib.md5(f"{k} {w}".encode()).hexdigest()[0] == "0"}) else "-" for k in range(32)]

    for i, d in enumerate(order):
        a, b, c = brute(words["own"][d]), brute(words["edited"][d]), brute(words["own"][order[(i + 1) % len(order)]])
        assert (rows[d].fingerprint, rows[d].edited_fingerprint) == (".".join(a), ".".join(b))
        either = [x == y for x, y in zip(a, c, strict=True) if (x, y) != ("-", "-")]
        assert rows[d].near_next == pytest.approx(sum(either) / len(either) if either else 1.0)


def test_imatch_awkward(spark, awkward, empty):
    got = imatch.compared(awkward).collect()
    assert len(got) == len(AWKWARD) and all(r.near_edited is not None and r.near_next is not None for r in got)
    texts = {}
    for r in got:
        texts.setdefault(r.fingerprint, set()).add(r.n_chars)
    assert {r.fingerprint for r in got if r.doc_id in (7, 8)} == {next(r.fingerprint for r in got if r.doc_id == 7)}
    assert imatch.compared(empty).count() == 0
    single = imatch.compared(awkward.where("doc_id = 7")).first()
    assert (single.edited, single.near_next) == ("a b c d ea b ", 1.0)


def test_next_row(spark):
    rng = random.Random(4)
    for ids in ([5, 3, None, 9, 9, 1, 7, None], [8] * 300 + [None] * 200 + list(range(40)), ["b", "a", None, "b", "c"]):
        rows = [(i, rng.randrange(1 << 40)) for i in ids]
        df = spark.createDataFrame(rows, f"doc_id {'string' if 'a' in ids else 'long'}, tie long").repartition(3)
        got = imatch.with_next(df, "doc_id", "tie", F.col("tie"), len(rows)).collect()
        order = sorted(got, key=lambda r: (r.doc_id is not None, r.doc_id if r.doc_id is not None else 0, r.tie), reverse=True)
        assert [r.next for r in order] == [r.tie for r in order[1:]] + [order[0].tie]
        assert len(shared.range_bounds(df, ["doc_id", "tie"], len(rows))) == 3
    assert imatch.with_next(df.limit(0), "doc_id", "tie", F.col("tie"), 0).count() == 0


# ---- op8


def brute_targets(sizes, weights, share, most):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = share * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > most * sizes[s]}
        if not full:
            return out | {s: level * weight[s] for s in open_}
        for s in full:
            out[s] = most * sizes[s]
            left -= out[s]
        open_ -= full
    return out


def test_mix_targets_and_sums(spark, docs):
    rng = random.Random(10)
    odd = spark.createDataFrame([(i, " ".join(["w"] * rng.randint(0, 30)), rng.choice([None, "", "a", "a", "a", "b", "é", "z"])) for i in range(900)], "doc_id long, text string, source string")
    for df in (odd, docs.select("doc_id", "text", "source")):
        light = df.select("doc_id", "source", mixing.word_count().alias("size"), mixing.row_hash(7, F.col("doc_id"), F.col("text")).alias("hash"), F.monotonically_increasing_id().alias("__row"))
        rows = shared.written(mixing.distinct_hashes(shared.written(light)))
        got = mixing.mix_plan(rows, [3, 1, 2], 1.5, 2, 8, 7).collect()
        assert len(got) == df.count()
        sizes, taken, largest = {}, {}, {}
        for r in got:
            sizes[r.source] = sizes.get(r.source, 0) + r["size"]
            taken[r.source] = taken.get(r.source, 0) + r.copies * r["size"]
            largest[r.source] = max(largest.get(r.source, 0), r["size"])
            assert r.copies <= 2 and len(r.shards) == r.copies and all(0 <= s < 8 for s in r.shards)
        want = brute_targets(sizes, [3, 1, 2], 1.5, 2)
        for r in got:
            assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert all(abs(taken[s] - want[s]) <= largest[s] for s in sizes)
        again = mixing.mix_plan(rows.repartition(3), [3, 1, 2], 1.5, 2, 8, 7).collect()
        assert sorted(map(str, again)) == sorted(map(str, got))


def test_mix_of_repeated_rows(spark):
    """Rows alike in doc_id and text are taken one by one, so a source of copies meets its target."""
    rows = [(1, "w " * 20, "a")] * 100 + [(i, "w " * 10, "b") for i in range(300)] + [(5, None, None)] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("mix_shard", F.lit("clash")).withColumn("hash", F.lit(1)).repartition(7)
    got = mixing.mix(df, [3, 1, 2]).collect()
    want = brute_targets({"a": 2000, "b": 3000, None: 0}, [3, 1, 2], 1.5, 2)
    for s, size in (("a", 20), ("b", 10)):
        assert abs(sum(r.source == s for r in got) * size - want[s]) <= size / 2
    assert list(got[0].asDict()) == ["doc_id", "text", "source", "hash", "mix_shard"] and {r.mix_shard for r in got} == set(range(8)) and {r.hash for r in got} == {1}
    counts = lambda rows: sorted(Counter(r.source for r in rows).items())
    assert counts(mixing.mix(df.coalesce(1), [3, 1, 2]).collect()) == counts(got)


def test_too_many_sources(spark, docs, monkeypatch):
    monkeypatch.setattr(mixing, "MAX_SOURCES", 2)
    with pytest.raises(ValueError, match="sources"):
        mixing.mix(docs, [1])


def test_hypergeometric_draws(spark):
    draws = spark.range(4000).selectExpr(f"{mixing.hypergeometric('30L', '70L', '20L', '((id + 0.5D) / 4000)')} as x").toPandas().x
    assert draws.mean() == pytest.approx(6, abs=0.02) and draws.var() == pytest.approx(20 * 0.3 * 0.7 * 80 / 99, abs=0.05)
    edge = spark.range(1).selectExpr(*[f"{mixing.hypergeometric(*a, '0.7D')} as x{i}" for i, a in enumerate([("0L", "5L", "3L"), ("5L", "0L", "3L"), ("4L", "4L", "0L"), ("4L", "4L", "8L")])]).first()
    assert list(edge) == [0, 3, 0, 4]


def test_splitting_tree_is_exact(spark):
    quotas = {1: 17, 2: 0, 3: 400, 4: 1}
    for shards in (1, 3, 8):
        got = mixing.splitting_tree(spark.createDataFrame(list(quotas.items()), "rank int, blocks long"), shards, 5).collect()
        ends = {r["rank"]: r.ends for r in got}
        assert all(ends[r][-1] == n and ends[r] == sorted(ends[r]) and len(ends[r]) == shards for r, n in quotas.items())
        totals = [sum(ends[r][j] - (ends[r][j - 1] if j else 0) for r in quotas) for j in range(shards)]
        assert sum(totals) == 418 and max(totals) - min(totals) <= 1


def test_mixed_rows(spark, awkward, empty):
    got = mixing.mix(awkward, [3, 1, 2]).collect()
    assert {r.score for r in got} <= set(range(len(AWKWARD)))
    assert all(sum(r.score == i for r in got) <= 4 for i in range(len(AWKWARD)))
    assert mixing.mix(empty, [1]).count() == 0


# ---- op9


def test_gradient_of_the_network():
    words = np.arange(1, 41, dtype=np.uint64)
    net = pseudo_lm.Network(pseudo_lm.Lexicon(words, np.arange(40, 0, -1.0), 900))
    rng = np.random.default_rng(11)
    net.weights[3] = rng.normal(0, 0.3, net.weights[3].shape).astype(np.float32)
    ids = [np.array([3, 7, 40, 1, 0]), np.array([], int), np.array([5])]
    ((tokens, near),) = net.around(ids)
    assert tokens.tolist() == [3, 7, 40, 1, 0, 5] and near[0].tolist() == [41, 41, 7, 40] and near[-1].tolist() == [41] * 4
    total = lambda: net.log_probability(tokens, near, net.tables()).mean()
    before, old = total(), [w.copy() for w in net.weights]
    squares = [np.full(w.shape, 1e6, np.float32) for w in net.weights]  # tiny steps along the gradient
    net.train(tokens, near, squares)
    scale = pseudo_lm.STEP / 1e3
    for w, o in zip(net.weights, old, strict=True):
        step = (w - o).astype(float) / scale
        at = np.unravel_index(np.abs(step).argmax(), step.shape)
        if abs(step[at]) < 1e-3:
            continue
        w[...] = o
        w[at] += 1e-2
        up = total()
        w[at] -= 2e-2
        slope = (up - total()) / 2e-2
        w[...] = o
        assert step[at] == pytest.approx(slope, rel=0.2, abs=2e-3)
    assert before == pytest.approx(total())


def test_company_of_words():
    """Neighbours' vectors are summed in runs of equal words; known words without a token, and no token that is known."""
    lexicon = pseudo_lm.Lexicon(np.arange(1, 31, dtype=np.uint64), np.arange(30, 0, -1.0), 900)
    rng, directions = np.random.default_rng(3), lexicon.directions()
    tokens, near = rng.integers(0, 31, 500).astype(np.int32), rng.integers(0, 32, (500, 4)).astype(np.int32)
    tokens[tokens == 7] = 8
    want = np.zeros((30, pseudo_lm.COMPANY))
    for t, around in zip(tokens, near, strict=True):
        if t < 30:
            want[t] += directions[around].sum(0)
    got = lexicon.company(tokens, near, directions)
    assert got.shape == want.shape and np.allclose(got, want, atol=1e-3) and not got[7].any()
    assert not lexicon.company(np.full(3, 30, np.int32), near[:3], directions).any()
    order, own, first = pseudo_lm.runs(tokens)
    assert order.tolist() == np.argsort(tokens, kind="stable").tolist() and own.tolist() == np.unique(tokens).tolist() and (tokens[order][first] == own).all()


def test_pseudo_likelihood_learns(spark):
    rng = random.Random(12)
    pairs = [("sun", "shines"), ("rain", "falls"), ("wind", "blows"), ("snow", "melts")]
    text = lambda: " ".join(x for _ in range(40) for x in rng.choice(pairs))
    df = spark.createDataFrame([(i, text()) for i in range(400)], "doc_id long, text string").repartition(2)
    net = pseudo_lm.train(df)
    good, probe = text(), [x for _ in range(40) for x in rng.choice(pairs)]
    rng.shuffle(probe)
    odd = [(1, good), (2, " ".join(probe)), (3, None), (4, ""), (5, " \n"), (6, "unheard of words"), (1, good)]
    got = pseudo_lm.score(spark.createDataFrame(odd, "doc_id long, text string").withColumn("n_tokens", F.lit("clash")), net).collect()
    by = {r.doc_id: r for r in got}
    assert by[1].per_token > by[2].per_token > by[6].per_token
    assert all((by[i].n_tokens, by[i].log_likelihood, by[i].per_token) == (0, 0.0, None) for i in (3, 4, 5))
    assert by[1].log_likelihood == pytest.approx(by[1].per_token * by[1].n_tokens) and len(got) == len(odd)


def test_every_token_is_trained_on_once(monkeypatch):
    texts = [" ".join(f"w{i * 50 + j}" for j in range(i % 7 * 9)) for i in range(60)]
    words = np.unique(np.concatenate(list(shingles.word_hashes([t.encode() for t in texts]))))
    net = pseudo_lm.Network(pseudo_lm.Lexicon(words, np.ones(len(words)), len(words)))
    ids = [net.lexicon.ids(w).astype("<u2").tobytes() for w in shingles.word_hashes([t.encode() for t in texts])]
    monkeypatch.setattr(pseudo_lm, "AT_ONCE", 70)
    batches = [pa.RecordBatch.from_arrays([pa.array([1] * len(ids[at : at + 25]), pa.int32()), pa.array(ids[at : at + 25], pa.binary())], ["part", "ids"]) for at in range(0, 60, 25)]
    turn = lambda *a: [t for _, groups in pseudo_lm.by_part(iter(batches)) for tokens, _ in pseudo_lm._chosen(net, groups, *a) for t in tokens.tolist()]
    assert sorted(turn()) == list(range(len(words)))
    assert sorted(x for i in range(pseudo_lm.ROUNDS) for x in turn(i, pseudo_lm.ROUNDS)) == list(range(len(words)))


def test_words_outside_the_vocabulary_cost_by_their_counts(spark, monkeypatch):
    monkeypatch.setattr(pseudo_lm, "VOCABULARY", 4)
    common = "a a a a a a a a b b b b b b b b c c c c c c c c d d d d d d d d "
    df = spark.createDataFrame([(i, common + "often " * 5 + ("once" if i == 0 else "")) for i in range(10)], "doc_id long, text string").repartition(2)
    net = pseudo_lm.train(df)
    probe = spark.createDataFrame([(1, "often"), (2, "once"), (3, "never"), (4, "once often")], "doc_id long, text string")
    got = {r.doc_id: r.log_likelihood for r in pseudo_lm.score(probe, net).collect()}
    assert got[1] - got[2] == pytest.approx(np.log(50)) and got[2] - got[3] == pytest.approx(np.log(1 / pseudo_lm.UNSEEN))


def test_scores_against_brute_force_and_layouts(spark, monkeypatch):
    """Every probability anew, word by word; they add up to one; and weights don't follow the layout."""
    monkeypatch.setattr(pseudo_lm, "VOCABULARY", 30)
    monkeypatch.setattr(pseudo_lm, "PART", 900)
    rng = random.Random(13)
    texts = [" ".join(f"w{min(rng.randrange(60), rng.randrange(60))}" for _ in range(rng.randrange(40))) for _ in range(150)] + ["w1 w2 w3"] * 9
    df = spark.createDataFrame([(i % 150, t, {"k": 1}) for i, t in enumerate(texts)], "doc_id long, text string, extra map<string,int>")
    nets = [pseudo_lm.train(df.repartition(n)) for n in (1, 7)]
    assert all(np.array_equal(a, b) for a, b in zip(nets[0].weights, nets[1].weights, strict=True))
    net, lex = nets[0], nets[0].lexicon
    counts = Counter(w for t in texts for w in t.split())
    place = {w: int(lex.ids(next(iter(shingles.word_hashes([w.encode()]))))[0]) for w in [*counts, "unheard"]}
    emb, mix, bias, out, prior = (w.astype(float) for w in net.weights)
    n, rest = len(lex.words), sum(c for w, c in counts.items() if place[w] == len(lex.words))
    assert n == 30 and rest == lex.others()

    def logits_of(around):
        hidden = bias + sum(emb[place[w] if w else n + 1] @ mix[i * pseudo_lm.WIDTH : (i + 1) * pseudo_lm.WIDTH] for i, w in enumerate(around))
        return np.tanh(hidden) @ out + prior

    def log_p(word, around):
        logits, c = logits_of(around), lex.classes[place[word]]
        mates = sum(counts[w] for w in counts if place[w] < n and lex.classes[place[w]] == c) if place[word] < n else rest + pseudo_lm.UNSEEN
        return logits[c] - np.log(np.exp(logits).sum()) + np.log(counts.get(word, pseudo_lm.UNSEEN) / mates)

    around = [None, "w1", "w50", "unheard"]
    empty = sorted({*range(pseudo_lm.CLASSES)} - {*lex.classes.tolist()})  # fewer words than classes here
    spare = np.exp(logits_of(around)[empty]).sum() / np.exp(logits_of(around)).sum()
    assert sum(np.exp(log_p(w, around)) for w in place) + spare == pytest.approx(1, abs=1e-4)
    asked = [*texts[:25], "w1 unheard w2", None]
    got = {r.i: r for r in pseudo_lm.score(spark.createDataFrame(list(enumerate(asked)), "i int, text string").repartition(3), net).collect()}
    for i, t in enumerate(asked):
        w = (t or "").split()
        pad = [None, None, *w, None, None]
        want = sum(log_p(x, [pad[j], pad[j + 1], pad[j + 3], pad[j + 4]]) for j, x in enumerate(w))
        assert got[i].n_tokens == len(w) and got[i].log_likelihood == pytest.approx(want, rel=1e-4, abs=1e-4) and got[i].text == t


def test_weights_are_averaged_in_a_tree(spark):
    rows = [(i, 1 + i % 5, np.full(3, i, "<f4").tobytes()) for i in range(300)]
    got = pseudo_lm.averaged(spark.createDataFrame(rows, pseudo_lm.RESULT))
    assert got == pytest.approx(np.full(3, sum(i * n for i, n, _ in rows) / sum(n for _, n, _ in rows)), rel=1e-5)


def test_pseudo_likelihood_awkward(spark, awkward, monkeypatch):
    monkeypatch.setattr(pseudo_lm, "AT_ONCE", 5_000)  # the long text has 90,000 words
    net, table = pseudo_lm.train_coded(awkward)
    got = {r.score: r for r in pseudo_lm.score_coded(table, net).collect()}
    assert {i: r.n_tokens for i, r in got.items()} == {i: len(words) for i, row in enumerate(AWKWARD) for words in [re.findall(r"[^\x20\x09-\x0D]+", row[1] or "")]}
    assert all((r.per_token is None) == (r.n_tokens == 0) for r in got.values())


def test_pseudo_likelihood_empty(spark, empty):
    assert pseudo_lm.score(empty, pseudo_lm.train(empty)).count() == 0


# ---- op10


def test_license_scan(spark, awkward, empty):
    mit, apache = licenses.TEMPLATES["mit-text"], licenses.TEMPLATES["apache-2.0"]
    changed = mit.split()
    changed[10] = "CHANGED"
    texts = ["x y z " * 50 + mit + " q" * 100, " ".join(changed), " ".join(mit.split()[:20]), "lorem\n" + apache.upper() + "\nipsum", None, "", "all rights", "All  rights -- reserved", "Licensed under"]
    got = licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), licenses.TEMPLATES).collect()
    found = {r.doc_id: {m.template: (round(m.containment, 3), m.first_word) for m in r.matches} for r in got}
    assert found[0] == {"mit-text": (1.0, 151)} and list(found[1]) == ["mit-text"] and 0.8 < found[1]["mit-text"][0] < 1
    assert found[3] == {"apache-2.0": (1.0, 2)} and found[7] == {"all-rights-reserved": (1.0, 1)}
    assert all(not found[i] for i in (2, 4, 5, 6, 8))
    assert [m.template for r in licenses.scan(awkward, licenses.TEMPLATES).collect() for m in r.matches] == ["all-rights-reserved"]
    assert licenses.scan(empty, licenses.TEMPLATES).count() == 0


def test_license_bands_meet_changed_windows(spark):
    """How often a window with one changed shingle agrees with the old one in a band."""
    shingle = lambda *x: F.xxhash64("id", *[F.lit(y) for y in x])
    old = F.array(*[shingle(i) for i in range(licenses.WINDOW)])
    new = F.array(*[shingle(i) for i in range(licenses.WINDOW - 1)], shingle(9, 9))
    met = F.arrays_overlap(licenses.band_keys(F.col("old"), 1), licenses.band_keys(F.col("new"), 1))
    share = spark.range(40_000).select(old.alias("old"), new.alias("new")).select(F.avg(met.cast("int"))).first()[0]
    assert 0.97 < share < 0.995


# ---- pipeline


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The stages over a small table, each with its input."""
    out, rows = {}, spark.read.parquet(f"{SMALL}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, rows, SMALL).write.parquet(path)
        out[name] = rows, spark.read.parquet(path)
        rows = out[name][1]
    return out


def test_stages_keep_the_columns(spark, docs, stages):
    assert [s for s, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "mix", "encode"]
    for name, (_, after) in stages.items():
        assert name == "encode" or after.columns == docs.columns


def test_stages_against_brute_force(stages):
    before, after = stages["line_dedup"]
    old = {r.doc_id: r.text for r in before.collect()}
    want = dict(zip(old, brute_lines(list(old.values()), 10), strict=True))
    kept = {d: t for d, (n, dropped, t) in want.items() if not dropped or dropped < n}
    assert {r.doc_id: r.text for r in after.collect()} == kept
    before, after = stages["near_dedup"]
    sets = {r.doc_id: words_of(r.text, 5) for r in before.collect()}
    linked = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    root = brute_components(sets, linked)
    assert {r.doc_id for r in after.collect()} == {d for d in sets if root[d] == d}
    before, after = stages["mix"]
    copies = [r.doc_id for r in after.collect()]
    assert set(copies) <= {r.doc_id for r in before.collect()} and max(map(copies.count, copies)) <= 2
    before, after = stages["encode"]
    assert sorted(r.decoded_sha256 for r in after.collect()) == sorted(hashlib.sha256((r.text or "").encode()).hexdigest() for r in before.collect())


def test_stages_on_awkward_rows(spark, awkward, empty):
    for rows in (awkward, empty):
        for name, stage in corpus_pipeline.STAGES:
            after = stage(spark, rows, SMALL)
            assert name == "encode" or after.columns == rows.columns
            assert after.count() <= 2 * max(1, rows.count())


def test_one_of_each_group_of_copies_stays(spark):
    block = lambda name: "\n".join(f"{name} line {i} has some words of its own {i * 7}" for i in range(5))
    texts = [block("plain")] * 12 + [block("blank") + "\n\n"] * 12 + ["a common line"] * 12 + [f"a common line\nrow {i} alone" for i in range(3)]
    rows = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in enumerate(texts)], SCHEMA)
    after = corpus_pipeline.drop_repeated_lines(spark, rows, SMALL)
    assert {r.doc_id: (r.text, r.n_chars) for r in after.collect()} == {i: (t, len(t)) for i, t in enumerate(texts[:36])} | {36 + i: (f"row {i} alone", 11) for i in range(3)}
    kept = corpus_pipeline.drop_near_duplicates(spark, after, SMALL)
    assert {r.doc_id for r in kept.collect()} == {0, 12, 24, 36, 37, 38}
