"""The record-linkage engine: views, retrieval, fusion, features, metrics, sinks, whole runs."""

import hashlib
import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests import fixtures
from kinfold import queries as registered
from kinfold.functions import indic, terms
from kinfold.functions import similarity as S
from kinfold.functions import text as T
from kinfold.operators import features, fuse, graph, index, metrics, model, records, retrieve, spelling
from kinfold.plans.run import core_run, infer_from
from kinfold.sources import tsv
from kinfold.streaming import arriving_records


N = 250


def one(spark, expr, *values):
    rows = [(i, v) for i, v in enumerate(values)]
    out = spark.createDataFrame(rows, "i int, v string").select("i", expr(F.col("v")).alias("x")).orderBy("i").collect()
    return [r.x for r in out]


@pytest.fixture(scope="module")
def sample(spark, tmp_path_factory):
    folder = fixtures.write_sources(str(tmp_path_factory.mktemp("train")), "train", N)
    recs = records.ingest({s: tsv.read_tsv(spark, f"{folder}/train_source{s}.tsv", places=True) for s in (1, 2, 3)}).cache()
    queries, truth = records.load_truth(recs, tsv.read_tsv(spark, f"{folder}/train_ground_truth.tsv", tsv.TRUTH_COLUMNS))
    return recs, queries.cache(), truth.cache()


def test_cleaning(spark):
    assert one(spark, T.missing_clean, None, "<NULL>", " < none >,a", "None Such Ltd", "nullable;|") == ["", "", "a", "Such Ltd", "nullable"]
    assert one(spark, T.clean_name, "#hanumaneducational", "#98587", "** A & B|c  LLC llc", "x www.y.z LTD ltd Ltd end") == ["hanumaneducational", "98587", "A and B c LLC", "x LTD end"]
    assert one(spark, T.clean_address, "Opp. Mall, B/H Park Rd.", "## 1 Main St, Nr lake ;", "stop adjust") == ["opposite Mall, behind Park road", "1 Main St, near lake", "stop adjust"]


def test_unicode_views(spark):
    assert one(spark, T.tokens, "ग्लोबल Straße-2", "a_b ́c") == [["ग्लोबल", "strasse", "2"], ["a", "b", "c"]]
    assert one(spark, T.fold_accents, "frères ñ", "ग्लोबल", "ά") == ["freres n", "ग्लोबल", "ά"]
    assert one(spark, T.unicode_view, "ﬁ①", None) == ["fi1", None]
    (a, b) = one(spark, T.script_profile, "Sun पावर", "12")
    assert a.indic == pytest.approx(3 / 6) and a.latin == pytest.approx(3 / 6) and (b.indic, b.latin, b.other) == (0, 0, 0)


def test_transliteration_is_that_of_icu(spark):
    icu = spark._jvm.com.ibm.icu.text.Transliterator.getInstance("Any-Latin")
    for word in ("ग्लोबल", "குளோபல்", "पावर", "दिल्ली", "మార్కెట్", "ಬೆಂಗಳೂರು", "কলকাতা", "ગુજરાત", "ਪੰਜਾਬ"):
        ours = one(spark, T.fold_accents, indic.transliterate(word))[0]
        assert ours.replace("m", "n") == one(spark, T.fold_accents, icu.transliterate(word))[0].replace("m", "n"), word
    assert indic.transliterate("Sun-9") == "Sun-9"


def test_core_and_legal(spark):
    got = one(spark, lambda c: F.struct(*[x.alias(n) for x, n in zip(T.core_and_legal(c), "cl", strict=True)]), "private limited", "acme pvt private ltd", "acme", "", "co op co llc co", "inc x")
    assert [(r.c, r.l) for r in got] == [("private limited", "private limited"), ("acme", "private limited"), ("acme", ""), ("", ""), ("co op", "company llc company"), ("inc x", "")]


def test_address_parts(spark):
    (r,) = one(spark, T.address_parts, "12b behind 7 Mall a12 near 12B")
    assert (r.tokens, r.numbers, r.landmarks) == (["12b", "behind", "7", "mall", "a12", "near"], ["12b", "7"], ["behind", "near"])


def brute_grams(text):
    out = []
    for w in text.lower().split():
        w = f" {w} "
        for n in (3, 4, 5):
            out += [w[i : i + n] for i in range(len(w) - n + 1)] if len(w) > n else [w][: 1 if n == 3 or len(w) >= n else 0]
    return out


def test_char_grams(spark):
    texts = ["ab", "abc de", "a", "", "hello  world"]
    for got, text in zip(one(spark, terms.char_grams, *texts), texts, strict=True):
        assert sorted(got) == sorted(brute_grams(text))


@settings(max_examples=300, deadline=None)
@given(st.text("abcd ", max_size=14), st.text("abcd ", max_size=14))
def test_ratio_against_a_table(a, b):
    rows = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            rows[i + 1][j + 1] = rows[i][j] + 1 if x == y else max(rows[i][j + 1], rows[i + 1][j])
    assert S.lcs_length(a, b) == rows[-1][-1]
    assert S.ratio(a, b) == S.ratio(b, a) and 0 <= S.token_set_ratio(a, b) <= 100


def test_token_ratios():
    assert S.token_sort_ratio("b a", "a  b") == 100 and S.token_set_ratio("a b", "a b c d") == 100
    assert S.token_set_ratio("", "a") == 0 and S.token_set_ratio("xy", "zw") == 0


def test_reading_rejects_bad_files(spark, tmp_path):
    header = tsv.SOURCE_COLUMNS
    good = ("S1-1", "n", "a", "US")
    for name, head, rows in (("order", header[::-1], [good]), ("short", header, [good, ("S1-2", "x")])):
        fixtures.write_tsv(f"{tmp_path}/{name}.tsv", head, rows)
        with pytest.raises(Exception):  # noqa: B017
            tsv.read_tsv(spark, f"{tmp_path}/{name}.tsv").collect()
    for rows, said in (([("S1-1", "x" * 4097, "", "")], "too long"), ([("S2-1", "n", "", "")], "prefix"), ([good, good], "duplicate"), ([("", "n", "", "")], "id missing")):
        fixtures.write_tsv(f"{tmp_path}/bad.tsv", header, rows)
        with pytest.raises(ValueError, match=said):
            records.ingest({1: tsv.read_tsv(spark, f"{tmp_path}/bad.tsv")})
    fixtures.write_tsv(f"{tmp_path}/two.tsv", header, [("S1-1", "a\nb", "", "")])
    with pytest.raises(Exception):  # noqa: B017
        tsv.read_tsv(spark, f"{tmp_path}/two.tsv").collect()
    assert tsv.read_tsv(spark, f"{tmp_path}/two.tsv", multi_line=True).first().business_name == "a\nb"
    with open(f"{tmp_path}/bom.tsv", "w", encoding="utf-8-sig") as f:
        f.write("\t".join(header) + '\nS1-1\t"a ""b"""\t\tUS\n')
    row = records.ingest({1: tsv.read_tsv(spark, f"{tmp_path}/bom.tsv")}).first()
    assert (row.eid, row.name.raw, row.address.raw, row.country, row.missing) == ("S1-1", 'a "b"', "", "us", 1)


def test_places_do_not_follow_the_splits(spark, tmp_path):
    rows = [(f"S1-{(i * 37) % 900}", f"name {i}", "x" * (i % 50), "US") for i in range(900)]
    fixtures.write_tsv(f"{tmp_path}/s.tsv", tsv.SOURCE_COLUMNS, rows)
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("128m", "4k"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            read = tsv.read_tsv(spark, f"{tmp_path}/s.tsv", places=True)
            assert {r.entity_id: r.row for r in read.collect()} == {r[0]: i for i, r in enumerate(rows)}
        assert spark.read.csv(f"{tmp_path}/s.tsv").rdd.getNumPartitions() > 4
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)
    plain = spark.createDataFrame(rows, tsv.schema(tsv.SOURCE_COLUMNS))
    rids = lambda d: {r.entity_id: r.rid - records.SOURCE_STEP for r in records.number(d, 1).collect()}
    assert rids(plain.repartition(5)) == rids(plain.coalesce(1)) == {e: i for i, e in enumerate(sorted(r[0] for r in rows))}


def test_truth_is_checked(spark, sample):
    recs, queries, truth = sample
    assert queries.count() == N and truth.count() == 2 * sum(not fixtures.alone(i) for i in range(N))
    rows = [(f"S1-{i}", "") for i in range(N)]
    for change, said in (([], "without truth"), ([("S1-0", "S2-1,S2-1")], "duplicate"), ([("S1-0", "S1-1")], "target"), ([("S9-0", "")], "query")):
        given_ = rows[1:] + change if said != "without truth" else rows[1:]
        with pytest.raises(ValueError, match=said):
            records.load_truth(recs, spark.createDataFrame(given_, "source1_entity_id string, matched_entity_ids string"))


def test_shared_targets_share_a_split(spark, sample):
    recs, queries, truth = sample
    ids = {r.eid: r.rid for r in recs.select("eid", "rid").collect()}
    extra = truth.unionByName(spark.createDataFrame([(ids["S1-2"], ids["S2-1"]), (ids["S1-9"], ids["S3-2"])], "q long, t long"))
    got = {r.q: (r.component, r.split) for r in graph.assign_splits(queries, extra).collect()}
    assert got[ids["S1-1"]] == got[ids["S1-2"]] == got[ids["S1-9"]] and got[ids["S1-1"]][0] == ids["S1-1"]
    assert got[ids["S1-3"]][0] == ids["S1-3"] and len(got) == N
    splits = graph.assign_splits(queries, truth)
    picked = [r.q for r in graph.select_queries(splits, "fit", 20).collect()]
    assert len(set(picked)) == 20 and picked == [r.q for r in graph.select_queries(splits, "fit", 20).collect()]


def test_long_chains_connect(spark):
    n = 70
    truth = [(q, 1000 + q) for q in range(n)] + [(q, 1000 + q + 1) for q in range(n - 1)]
    got = graph.query_components(spark.range(n).withColumnRenamed("id", "q"), spark.createDataFrame(truth, "q long, t long")).collect()
    assert {r.component for r in got} == {0}


def brute_top(recs, channel, budget):
    view, kind = terms.CHANNEL_VIEWS[channel]
    field, part = view.split(".")
    bag = {r.rid: (brute_grams(r[field][part]) if kind == "grams" else r[field][part].split()) for r in recs}
    out = {}
    for country, source in {(r.country, r.source) for r in recs if r.source > 1}:
        mine = [r.rid for r in recs if (r.country, r.source) == (country, source)]
        n, df = len(mine), {}
        for t in mine:
            for term in set(bag[t]):
                df[term] = df.get(term, 0) + 1

        def vector(rid, n=n, df=df):
            w = {}
            for term in set(bag[rid]):
                d = df.get(term, 0)
                i = 0 if channel in terms.PRUNED and d > 0.2 * max(n, 1) else math.log((1 + n) / (1 + d)) + 1
                w[term] = math.log1p(bag[rid].count(term)) * i
            size = math.sqrt(sum(x * x for x in w.values())) or 1
            return {k: x / size for k, x in w.items() if x}

        vectors = {t: vector(t) for t in mine}
        for q in (r.rid for r in recs if r.source == 1):
            v = vector(q)
            scores = [(round(sum(v[k] * w.get(k, 0) for k in v), 9), t) for t, w in vectors.items()]
            out |= {(q, t): s for s, t in sorted(((s, t) for s, t in scores if s > 0), key=lambda x: (-x[0], x[1]))[:budget]}
    return out


@pytest.mark.parametrize("channel", ["rare", "char", "address", "translit"])
def test_top_k_against_brute_force(spark, sample, channel):
    recs = sample[0].where("cast(substring(eid, 4) as int) < 45")
    got = {(r.q, r.t): r.score for r in index.top_k(recs.where("source = 1"), index.Index(recs, (channel,)), {channel: 7}).collect()}
    want = brute_top(recs.collect(), channel, 7)
    assert set(got) == set(want) and all(got[k] == pytest.approx(want[k], abs=2e-9) for k in got)


HEADER = "rid long, entity_id string, business_name string, business_address string, country string"


def copied_records(spark, copies=12):
    """Three wordings of names, each ``copies`` times in the targets and twice in the queries."""
    first, second = "blue green old red small tall".split(), "bakery mill press forge dairy tannery".split()
    names = [f"{first[j % 6]} {second[(j + j // 6) % 6]}" for j in range(12)]
    rows = lambda s, n: spark.createDataFrame([(s * 1000 + 12 * i + j, f"S{s}-{12 * i + j}", x, f"{j} Elm Road", "US") for i in range(n) for j, x in enumerate(names)], HEADER)
    return records.normalised(rows(1, 2), 1).unionByName(records.normalised(rows(2, copies), 2)).unionByName(records.normalised(rows(3, 1), 3)), rows


@pytest.mark.parametrize("channel", ["rare", "char", "address"])
def test_equal_texts_are_indexed_once(spark, channel):
    recs = copied_records(spark)[0].cache()
    made = index.Index(recs, (channel,))
    assert made.vectors.where("source = 2").count() == 12 and made.members.where("source = 2").agg(F.max(F.size("ts"))).first()[0] == 12
    got = {(r.q, r.t): r.score for r in index.top_k(recs.where("source = 1"), made, {channel: 7}).collect()}
    want = brute_top(recs.collect(), channel, 7)
    assert set(got) == set(want) and all(got[k] == pytest.approx(want[k], abs=2e-9) for k in got)
    assert made.of_records(recs).select("t").distinct().count() > made.vectors.count()
    with pytest.raises(ValueError):
        index.top_k(recs.where("source = 1"), made, {channel: index.KEEP + 1})


@pytest.mark.parametrize("verified", [False, True])
@pytest.mark.parametrize("dense", [0, 10**9])
def test_whole_parts_agree_with_terms(spark, sample, monkeypatch, dense, verified):
    """A part scored as a whole, over all terms or over postings and in small blocks, and one met by terms."""
    recs = copied_records(spark)[0].unionByName(sample[0].where("cast(substring(eid, 4) as int) < 30")).cache()
    made, budgets = index.Index(recs, ("rare", "char")), {"rare": 7, "char": 5}
    found = lambda: {(r.channel, r.q, r.t): r.score for r in index.top_k(recs.where("source = 1"), made, budgets, verified).collect()}
    monkeypatch.setattr(index, "WHOLE", 0)
    want = found()
    monkeypatch.setattr(index, "WHOLE", 16_384)
    monkeypatch.setattr(index, "by_terms", None)
    monkeypatch.setattr(index, "ASKED", 9)
    got = found()
    assert len(want) > 100 and set(got) == set(want) and all(got[k] == pytest.approx(want[k], abs=2e-9) for k in got)
    # blocks of one query, either way
    monkeypatch.setattr(index, "DENSE", dense)
    entries = ([0, 0, 1, 3, 3], [0, 2, 1, 0, 1], [0.5, 0.25, 1.0, 0.125, 2.0]), ([0, 0, 1, 2], [0, 1, 2, 1], [1.0, 2.0, 4.0, 0.5])
    full = [np.zeros((4, 3)), np.zeros((3, 3))]
    for m, (r, t, w) in zip(full, entries, strict=True):
        m[r, t] = w
    for cells in (5, 10**6):
        monkeypatch.setattr(index, "CELLS", cells)
        blocks = list(index.part_scores(*[tuple(map(np.array, e)) for e in entries], 4, 3, 3))
        assert len(blocks) == (4 if cells == 5 else 1) and np.concatenate([b for _, b in blocks]).tolist() == (full[0] @ full[1].T).tolist()


@pytest.mark.parametrize("mode", ["name", "joint"])
def test_equal_word_sets_are_sketched_once(spark, mode, monkeypatch):
    recs, rows = copied_records(spark)
    if mode == "name":
        recs = recs.where("source = 1").unionByName(records.normalised(rows(2, 12).withColumn("business_address", F.lit("")), 2))
    recs, seen, banded = recs.cache(), [], retrieve.banded
    monkeypatch.setattr(retrieve, "banded", lambda df: seen.append(df.count()) or banded(df))
    got = {(r.q, r.t): r.score for r in retrieve.minhash_hits(recs, mode, 15).collect()}
    assert seen == [12 if mode == "name" else 24, 12]
    sets = {r.rid: (r.source, set(r.words), set(r.bands)) for r in retrieve.sketches(recs, mode).collect()}
    want = {}
    for q in (q for q, v in sets.items() if v[0] == 1):
        for source in (2, 3):
            met = [(-len(sets[q][1] & v[1]) / len(sets[q][1] | v[1]), t) for t, v in sets.items() if v[0] == source and sets[q][2] & v[2]]
            want |= {(q, t): -s for s, t in sorted(met)[:15]}
    assert got == pytest.approx(want)


@pytest.mark.parametrize("mode, verified", [("name", False), ("joint", True)])
def test_whole_parts_agree_with_bands(spark, sample, monkeypatch, mode, verified):
    """Parts met as a whole, in blocks of few queries and cells, and parts met by a join of bands: the same rows."""
    recs = copied_records(spark)[0].unionByName(sample[0]).cache()
    found = lambda: {(r.q, r.t, r.source): r.score for r in retrieve.minhash_hits(recs, mode, 4, verified).collect()}
    monkeypatch.setattr(index, "WHOLE", 0)
    want = found()
    monkeypatch.setattr(index, "WHOLE", 16_384)
    monkeypatch.setattr(retrieve, "met_by_bands", None)
    monkeypatch.setattr(index, "ASKED", 150)
    monkeypatch.setattr(index, "CELLS", 300)
    assert found() == want and len(want) > 50


def test_queries_that_are_alike_are_asked_once(spark):
    recs = copied_records(spark)[0].cache()
    channels, queries = ("rare", "address", "minhash_joint"), recs.where("source = 1")
    hits, same = retrieve.first_hits(recs, channels)
    assert same.count() == 24 and {r.q for r in hits.select("q").distinct().collect()} == set(range(1000, 1012))
    found = lambda df: sorted((r.q, r.t, r.mask, r.position) for r in df.collect())
    later = retrieve.retrieve(recs.where("source <> 1").unionByName(queries.where("rid >= 1012")), channels, 5)
    assert found(retrieve.retrieve(recs, channels, 5).where("q >= 1012")) == found(later)
    universe, truth = queries.select(F.col("rid").alias("q")), spark.createDataFrame([(1000 + i, 2000 + i) for i in range(20)], "q long, t long")
    whole, none = retrieve.for_all(hits, same), recs.select("rid").limit(0).withColumnRenamed("rid", "q")
    report = lambda h, *more: metrics.retrieval_report(universe, truth, fuse.fuse(h, 5), h, none, *more).collect()
    assert report(hits, same) == report(whole)
    assert sorted(map(str, metrics.budget_curve(universe, truth, hits, (2, 5), same).collect())) == sorted(map(str, metrics.budget_curve(universe, truth, whole, (2, 5)).collect()))


def test_equal_records_are_normalised_once(spark):
    recs, rows = copied_records(spark)
    plain = records.normalise(rows(2, 12), 2)
    assert sorted(map(str, recs.where("source = 2").collect())) == sorted(map(str, plain.collect()))
    odd = spark.createDataFrame([(i, f"S2-{i}", None if i % 2 else "A", None, None if i % 3 else "") for i in range(40)], HEADER)
    assert sorted(map(str, records.normalised(odd, 2).collect())) == sorted(map(str, records.normalise(odd, 2).collect()))


def test_few_texts_are_sent_to_the_rows(spark, monkeypatch):
    """Views that are few go to the rows, only those that are asked for, and either way the records are the same."""
    rows = {s: copied_records(spark)[1](s, 12) for s in (1, 2, 3)}
    views = {"name": ("core", "script"), "address": ("corrected",)}
    want = sorted(str(r) for s in rows for r in records.narrowed(records.normalise(rows[s], s), views).collect())
    few = records.all_normalised(rows, views=views)
    assert sorted(few.schema["name"].dataType.names) == ["core", "script"] and sorted(map(str, few.collect())) == want
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert plan(few).count("strategy=broadcast") == 3
    monkeypatch.setattr(records, "SENT", 0)
    many = records.all_normalised(rows, views=views)
    assert "strategy=broadcast" not in plan(many) and sorted(map(str, many.collect())) == want


def test_parts_need_no_python_workers(spark):
    parts = [("rare", "us", 2, 3), ("address", "", 3, 1)]
    made = index.part_rows(spark, parts)
    assert [tuple(r) for r in made.collect()] == parts and made.columns == [*index.PART, "blocks"]
    assert "RDD" not in made._jdf.queryExecution().optimizedPlan().toString()
    assert index.part_rows(spark, []).collect() == [] and index.part_rows(spark, []).schema.simpleString() == made.schema.simpleString()


def test_records_of_pairs(spark, monkeypatch):
    """Records are found by numbers that were sent to them, or by a shuffle if there are many; the features are the same."""
    recs = copied_records(spark)[0].cache()
    found, table = retrieve.retrieve(recs, ("rare", "address"), 5).cache(), index.word_idf(recs)
    made = lambda: features.pair_features(found, recs, table)
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    few = made()
    assert "strategy=broadcast" in plan(few.select("name_exact"))
    monkeypatch.setattr(features, "NAMED", 0)
    many = made()
    assert plan(many).count("strategy=broadcast") < plan(few).count("strategy=broadcast")
    assert few.count() == found.count() and sorted(map(str, few.collect())) == sorted(map(str, many.collect()))


def test_retrieval_finds_the_truth(spark, sample):
    recs, queries, truth = sample
    whole = retrieve.retrieve(recs, ("char", "rare", "translit", "address"), k=40)
    assert truth.join(whole, ["q", "t"], "left_anti").count() == 0
    first, again = (retrieve.retrieve(recs.repartition(n), ("rare",), k=40) for n in (2, 5))
    assert sorted(map(str, first.collect())) == sorted(map(str, again.collect()))
    assert first.groupBy("q").count().agg(F.max("count")).first()[0] <= 40


def test_saved_index(spark, sample, tmp_path):
    recs = sample[0].where("cast(substring(eid, 4) as int) < 30")
    made = index.Index(recs, ("rare", "char"))
    made.save(f"file://{tmp_path}/index")
    again = index.Index.load(spark, f"file://{tmp_path}/index")
    best = lambda i: sorted(map(str, index.top_k(recs.where("source = 1"), i, {"rare": 5, "char": 5}).select("q", "t", "source", "channel", "score").collect()))
    assert best(made) == best(again)


def test_routes(spark):
    queries = spark.createDataFrame([(1, "france"), (2, ""), (3, "peru")], "rid long, country string")
    parts = spark.createDataFrame([("france",), ("india",), ("",)], "country string")
    got = index.routes(queries, parts, True).groupBy("q").agg(F.sort_array(F.collect_list("country")).alias("c"))
    assert {r.q: r.c for r in got.collect()} == {1: ["", "france"], 2: ["", "france", "india"], 3: [""]}
    assert index.routes(queries, parts, False).count() == 9


def test_exact_overflow(spark):
    rows = [(1, 1, "us", "acme")] + [(10 + i, 2, "us", "acme") for i in range(21)] + [(99, 3, "us", ""), (2, 1, "us", "")]
    recs = spark.createDataFrame(rows, "rid long, source int, country string, name_key string")
    assert sorted(r.t for r in retrieve.exact_hits(recs).collect()) == list(range(10, 30))
    assert [r.q for r in retrieve.exact_overflow(recs).collect()] == [1]


def test_minhash_modes(spark, sample):
    recs = sample[0]
    ids = {r.eid: r.rid for r in recs.select("eid", "rid").collect()}
    name = retrieve.minhash_hits(recs, "name").where(F.col("q") == ids["S1-7"]).collect()
    assert ids["S2-7"] in {r.t for r in name} and all(r.t in {ids[f"S2-{i}"] for i in range(N) if fixtures.without_address(i)} for r in name)
    joint = retrieve.minhash_hits(recs, "joint").where(F.col("q") == ids["S1-8"]).collect()
    assert ids["S2-8"] in {r.t for r in joint} and max(joint, key=lambda r: r.score).score == 1.0
    index_, out = retrieve.minhash_index(recs, "joint", 1)
    assert out.count() > 0 and index_.join(out, "t").count() == 0


def test_minhash_with_a_name_past_a_full_bucket(spark):
    make = lambda s, names: records.normalise(spark.createDataFrame([(s * 1000 + i, f"S{s}-{i}", n, "", "US") for i, n in enumerate(names)], "rid long, entity_id string, business_name string, business_address string, country string"), s)
    recs = make(1, ["blue river bakery", "blue river bakery shop"]).unionByName(make(2, ["Blue River Bakery"] * 300 + ["Blue River Bakery Shop"])).cache()
    got = {(r.q, r.t): r.score for r in retrieve.all_hits(recs, ("minhash_name",)).where("channel = 'minhash_name'").collect()}
    assert got[1001, 2300] == 1.0 and {t for q, t in got if q == 1000} == set(range(2000, 2010))
    whole, few = retrieve.minhash_index(recs, "name", None)[0], retrieve.minhash_index(retrieve.first_of_words(recs, "name", 10), "name", None)[0]
    assert whole.select("t").distinct().count() == 301 and few.select("t").distinct().count() == 11


def brute_fuse(hits, k, coverage=2):
    groups = {}
    for t, s, c, x in hits:
        g = groups.setdefault((c, s), {})
        g[t] = max(g.get(t, -1), x)
    ranked = {g: sorted(d, key=lambda t: (-d[t], t))[: fuse.BUDGETS[g[0]]] for g, d in groups.items()}
    cover = min(coverage, k // max(1, len(ranked)))
    rrf, mask, keep = {}, {}, set()
    for (c, _), ts in ranked.items():
        for rank, t in enumerate(ts, 1):
            rrf[t] = rrf.get(t, 0) + 1 / (60 + rank)
            mask[t] = mask.get(t, 0) | 1 << fuse.CHANNELS[c]
            if rank <= cover:
                keep.add(t)
    order = sorted(rrf, key=lambda t: (-round(rrf[t], 12), -mask[t].bit_count(), t))
    keep |= set([t for t in order if t not in keep][: k - len(keep)])
    return [(t, mask[t]) for t in order if t in keep]


@pytest.mark.parametrize("k", [1, 3, 10, 60])
def test_fusion_against_brute_force(spark, k):
    rng = random.Random(k)
    hits = {q: [(t := rng.randrange(40), 2 + t % 2, rng.choice(list(fuse.CHANNELS)), rng.randrange(5) / 4) for _ in range(rng.randrange(1, 90))] for q in range(25)}
    rows = [(q, *h) for q, v in hits.items() for h in v]
    got = {}
    for r in fuse.fuse(spark.createDataFrame(rows, "q long, t long, source int, channel string, score double"), k).orderBy("q", "position").collect():
        got.setdefault(r.q, []).append((r.t, r.mask))
    assert got == {q: brute_fuse(v, k) for q, v in hits.items()}


def test_features(spark):
    header = "rid long, entity_id string, business_name string, business_address string, country string"
    q = records.normalise(spark.createDataFrame([(1, "S1-1", "Acme Foods Pvt Ltd", "12 Mall Rd near Lake", "US")], header), 1)
    t = records.normalise(spark.createDataFrame([(2, "S2-1", "ACME Food Private Limited", "12 Mall Road", "us"), (3, "S2-2", "ग्लोबल", "<null>", "")], header), 2)
    recs = q.unionByName(t)
    cands = spark.createDataFrame([(1, 2, 5, 0.03), (1, 3, 2, 0.01)], "q long, t long, mask int, rrf double")
    got = {r.t: r for r in features.pair_features(cands, recs, index.word_idf(recs)).collect()}
    a, b = got[2], got[3]
    assert list(a.asDict()) == ["q", "t", *features.FEATURES]
    assert (a.name_exact, a.core_exact, a.legal_equal, a.country_equal, a.source3, a.channels, a.retrieved_exact, a.retrieved_rare, a.retrieved_char) == (0, 0, 1, 1, 0, 2, 1, 1, 0)
    assert a.name_jaccard == pytest.approx(1 / 3) and a.numeric_overlap == 1 and a.numeric_conflict == 0 and a.addr_jaccard == pytest.approx(3 / 5)
    assert a.name_ratio == pytest.approx(S.ratio("acme foods pvt ltd", "acme food private limited") / 100) and a.name_length_ratio == pytest.approx(0.9)
    known, unseen = math.log(2 / 2) + 1, math.log(2) + 1
    assert a.rare_overlap == pytest.approx(known / (2 * known + unseen))
    assert (b.addr_missing, b.addr_ratio, b.cross_script, b.indic_fraction, b.name_jaccard) == (1, 0, 1, 1, 0)


def test_spelling_rules(spark):
    header = "rid long, entity_id string, business_name string, business_address string, country string"
    make = lambda s, f: records.normalise(spark.createDataFrame([(s * 1000 + i, f"S{s}-{i}", f(i), "1 Main Road", "India") for i in range(80)], header), s)
    recs = make(1, lambda i: f"Global {i} Retail").unionByName(make(2, lambda i: f"குளோபல் {i} Retail")).cache()
    truth = spark.createDataFrame([(1000 + i, 2000 + i) for i in range(80)], "q long, t long")
    splits = spark.createDataFrame([(1000 + i, "fit" if i < 50 else "tune") for i in range(80)], "q long, split string")
    rules = spelling.rule_map(spelling.learn_spelling(recs, truth, splits))
    assert rules == {"kulopal": "global"}
    fixed = spelling.apply_spelling(recs, rules).where("rid = 2000").first()
    assert (fixed.name.corrected, fixed.name_key) == ("global 0 retail", "global 0 retail")
    assert spelling.learn_spelling(recs, truth, splits, min_support=51).count() == 0


def test_spelling_rules_come_from_all_pairs(spark):
    """Also from those past the first 100,000; the records are those of two pairs, so all others only
    count towards a limit."""
    header = "rid long, entity_id string, business_name string, business_address string, country string"
    make = lambda s, names: records.normalise(spark.createDataFrame([(s * 1_000_000 + i, f"S{s}-{i}", n, "1 Main Road", "India") for i, n in names], header), s)
    recs = make(1, [(0, "Global 1"), (100_000, "Delhi 1")]).unionByName(make(2, [(0, "குளோபல் 1"), (100_000, "दिल्ली 1")])).cache()
    truth = spark.range(100_001).selectExpr("id + 1000000 as q", "id + 2000000 as t")
    got = spelling.learn_spelling(recs, truth, truth.selectExpr("q", "'fit' as split"), min_support=1).collect()
    assert sorted((r.x, r.y, r.n) for r in got) == [("dilli", "delhi", 1), ("kulopal", "global", 1)]
    assert spelling.learn_spelling(recs, truth, truth.selectExpr("q", "'fit' as split"), limit=100_000, min_support=1).count() == 1


def frames(spark, rows):
    universe = spark.createDataFrame([(q,) for q, _, _ in rows], "q long")
    truth = spark.createDataFrame([(q, t) for q, true, _ in rows for t in true], "q long, t long")
    scored = spark.createDataFrame([(q, t, p) for q, _, s in rows for t, p in s], "q long, t long, p double")
    return universe, truth, scored


def brute_f05(rows, tau):
    total = 0
    for _, true, scored in rows:
        pred = {t for t, p in scored if p >= tau}
        total += 1.0 if not true and not pred else 1.25 * len(pred & true) / (len(pred) + 0.25 * len(true))
    return total / len(rows)


def test_metric_identities(spark):
    rows = [(1, {1, 2, 3}, [(1, 0.9), (2, 0.8)]), (2, set(), []), (3, {7}, [])]
    universe, truth, scored = frames(spark, rows)
    assert metrics.evaluate(universe, truth, scored, 0.5).first().macro_f05 == pytest.approx((10 / 11 + 1) / 3)
    report = metrics.evaluate(universe, truth, scored, 0.5).first()
    assert report.n == 3 and report.pair_recall == pytest.approx(2 / 4) and report.complete_recall == 0
    empty = metrics.evaluate(universe.where("q = 2"), truth, scored, 0.5).first()
    assert empty.pair_recall is None and empty.complete_recall is None and empty.oracle == 1


def test_retrieval_report_sends_no_table_through_the_driver(spark):
    """Not even with tables that seem small enough to Spark."""
    rng = random.Random(3)
    universe, same = spark.range(40).withColumnRenamed("id", "q"), spark.range(40).selectExpr("id as q", "id % 20 as first")
    truth = spark.createDataFrame([(q, t) for q in range(36) for t in rng.sample(range(30), q % 3)], "q long, t long")
    hits = spark.createDataFrame([(q, t) for q in range(20) for t in rng.sample(range(30), 9) for _ in range(2)], "q long, t long")
    cut = hits.where("t % 2 = 0").distinct()
    found = metrics.retrieval_report(universe, truth, cut, hits, universe.where("q < 5"), same)
    # the one row of counts may go through it
    assert found._jdf.queryExecution().sparkPlan().toString().count("BroadcastHashJoin") == 0
    rows, before = (metrics.reached(universe, truth, x, same).agg(F.avg("oracle"), F.sum("candidates"), F.try_divide(F.sum("hit"), F.sum("m"))).first() for x in (cut, hits))
    got = found.first()
    assert (got.oracle, got.pairs, got.pair_recall, got.precap_oracle, got.queries, got.exact_overflows) == pytest.approx((*rows, before[0], 40, 5))


def test_threshold_sweep_against_brute_force(spark):
    rng = random.Random(42)
    rows = [(q, {t for t in range(6) if rng.random() < 0.35}, [(t, rng.choice([0.0, 0.1, 0.5, 0.9, 1.0])) for t in range(8) if rng.random() < 0.65]) for q in range(150)]
    universe, truth, scored = frames(spark, rows)
    curve = metrics.threshold_curve(universe, truth, scored, 20).collect()
    assert len(curve) == 22
    for r in curve:
        assert r.score == pytest.approx(brute_f05(rows, r.tau), abs=1e-9)
    tau, score = metrics.threshold_search(universe, truth, scored)
    best = max(brute_f05(rows, x / 1000) for x in range(1001))
    assert score == pytest.approx(max(best, brute_f05(rows, 1.1))) and brute_f05(rows, tau) == pytest.approx(score)
    for bad in ([(1, 1, 0.5), (1, 1, 0.6)], [(1, 1, 1.5)], [(1, 1, float("nan"))]):
        with pytest.raises(ValueError):
            metrics.threshold_search(universe, truth, spark.createDataFrame(bad, "q long, t long, p double"))


def test_fetching_records(spark, sample):
    recs, _, truth = sample
    ids = {r.eid: r.rid for r in recs.select("eid", "rid").collect()}
    wanted = spark.createDataFrame([(ids["S2-3"],), (ids["S2-3"],), (ids["S1-8"],)], "rid long")
    assert sorted(r.eid for r in records.fetch(recs, wanted).collect()) == ["S1-8", "S2-3"]
    assert sorted(r.eid for r in records.external_ids(recs, wanted).collect()) == ["S1-8", "S2-3", "S2-3"]
    with pytest.raises(ValueError, match="missing record"):
        records.fetch(recs, spark.createDataFrame([(5,)], "rid long"))
    splits = spark.createDataFrame([(1, 1), (2, 1), (7, 7)], "q long, component long")
    got = graph.pair_groups(spark.createDataFrame([(1, 10), (2, 11), (2, 12)], "q long, t long"), splits).collect()
    assert sorted((r.q, r.t, r.component) for r in got) == [(1, 10, 1), (2, 11, 1), (2, 12, 1)]


def test_sketches_against_brute_force(spark, sample):
    """Least values of (a x + b) mod p over a word's md5, in bands, by hand."""
    rows = retrieve.sketches(sample[0].where("source = 1 and rid % 29 = 0"), "name").collect()
    for r in rows:
        xs = [int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % retrieve.PRIME for w in r.words]
        least = [min((a * x + b) % retrieve.PRIME for x in xs) for a, b in retrieve.factors()]
        assert r.bands == ["-".join(map(str, [b, *least[4 * b : 4 * b + 4]])) for b in range(16)]
    assert len(rows) > 5 and len(set(retrieve.factors())) == 64


def test_training_sample(spark):
    cands = spark.createDataFrame([(1, t, 1 / (t + 1)) for t in range(22)], "q long, t long, rrf double")
    got = graph.sample_candidates(cands, spark.createDataFrame([(1, 3), (1, 20)], "q long, t long")).collect()
    assert len(got) == 12 and {r.t for r in got if r.y} == {3, 20} and {0, 1, 2, 4, 5} <= {r.t for r in got if not r.y}


def test_calibration(spark):
    rng = random.Random(1)
    rows = [(q, q, (p := rng.random()), int(rng.random() < p * p)) for q in range(800)]
    df = spark.createDataFrame(rows, "q long, t long, p double, y int").cache()
    chosen, losses = model.choose_calibrator(df.where("q < 500"), df.where("q >= 500"))
    assert set(losses) == {"platt", "isotonic"} and losses[chosen.kind] == min(losses.values())
    assert losses[chosen.kind] < df.where("q >= 500").agg(model.brier(df)).first()[0]
    with pytest.raises(ValueError):
        model.Calibrator("platt").fit(df.where("y = 0"))


def test_out_of_fold_scores_take_all_trees(spark, monkeypatch):
    rows = spark.createDataFrame([(i, i, i % 2, float(i % 2), i // 2) for i in range(40)], "q long, t long, y int, like double, component long").cache()
    grouped, train, seen = model.grouped_oof, model.train_model, []
    monkeypatch.setattr(registered, "_labelled", lambda s, d: rows)
    monkeypatch.setattr(model, "train_model", lambda df, stop, trees, *more: seen.append(trees) or train(df, stop, 2, *more))
    monkeypatch.setattr(model, "grouped_oof", lambda df, *more, **named: grouped(df, *more, features=["like"], leaf=1, **named))
    got = {r.q: (r.y, r.p) for r in registered.oof_scores(spark, "").collect()}
    assert seen == [model.FOLD_TREES] * 3 == [250] * 3
    assert len(got) == 40 and all((p > 0.5) == (y == 1) for y, p in got.values())


def test_hard_negatives(spark):
    scored = spark.createDataFrame([(1, 1, 0.9), (1, 2, 0.8), (1, 3, 0.8), (2, 4, 0.1)], "q long, t long, p double")
    truth = spark.createDataFrame([(1, 1)], "q long, t long")
    splits = spark.createDataFrame([(1, "fit"), (2, "fit"), (3, "tune")], "q long, split string")
    assert [(r.q, r.t) for r in model.hard_negatives(scored, truth, splits).collect()] == [(1, 2), (2, 4)]
    with pytest.raises(ValueError):
        model.hard_negatives(scored, truth, splits.where("q = 1"))


def test_outputs_and_their_checks(spark, sample, tmp_path):
    recs = sample[0]
    none = spark.createDataFrame([], "q long, t long, p double")
    tsv.write_outputs(recs, none, 0.5, str(tmp_path))
    tsv.validate_outputs(spark, recs, str(tmp_path))
    with open(tmp_path / "matching_results.tsv") as f:
        lines = f.read().split("\n")
    assert lines[0] == "source1_entity_id\tmatched_entity_ids" and lines[1] == "S1-0\t" and lines[11] == "S1-10\t" and len(lines) == N + 2
    ids = {r.eid: r.rid for r in recs.select("eid", "rid").collect()}
    scored = spark.createDataFrame([(ids["S1-1"], ids[t], p) for t, p in (("S3-1", 0.9), ("S2-1", 0.8), ("S2-10", 0.1))], "q long, t long, p double")
    matches, candidates = tsv.outputs(recs, scored, 0.5)
    row = matches.join(candidates, ["q", "source1_entity_id"]).where("source1_entity_id = 'S1-1'").first()
    assert (row.matched_entity_ids, row.candidate_entity_ids) == ("S2-1,S3-1", "S2-1,S2-10,S3-1")
    bad = lambda name, c: c.withColumn(name, F.when(F.col("source1_entity_id") == "S1-3", F.lit("S2-1,S2-1,S1-4")).otherwise(F.col(name)))
    found = {r.check: r.violations for r in tsv.output_violations(recs, matches.where("source1_entity_id <> 'S1-5'"), bad("candidate_entity_ids", candidates)).collect()}
    assert found == {"row in one file only": 1, "repeated query": 0, "unknown query": 0, "missing query": 1, "duplicate targets": 1, "matches outside candidates": 0, "unknown or wrong-source target": 1}
    with pytest.raises(MemoryError):
        tsv.write_pairs(scored, f"file://{tmp_path}/pairs.parquet", 2)
    assert tsv.write_pairs(scored, f"file://{tmp_path}/pairs.parquet") == tsv.read_pairs(spark, f"file://{tmp_path}/pairs.parquet").count() == 3
    with pytest.raises(MemoryError):
        tsv.read_pairs(spark, f"file://{tmp_path}/pairs.parquet", 2)


def test_arriving_records(spark, tmp_path):
    fixtures.write_tsv(f"{tmp_path}/a.tsv", tsv.SOURCE_COLUMNS, [("S2-1", "Acme LLC LLC", "", "US")])
    stream = arriving_records(spark, str(tmp_path), 2).select("eid", "name_key").writeStream.format("memory").queryName("arrived").start()
    stream.processAllAvailable()
    stream.stop()
    assert [tuple(r) for r in spark.table("arrived").collect()] == [("S2-1", "acme")]


def test_whole_run(spark, tmp_path):
    train = fixtures.write_sources(f"{tmp_path}/train", "train", N)
    test = fixtures.write_sources(f"{tmp_path}/test", "test", 16)
    report = core_run(spark, train, test, f"{tmp_path}/work", f"{tmp_path}/out", kinds=("rare", "char"), k=20, trees=5)
    assert report["final"]["all"]["oracle"] == 1 and report["final"]["all"]["macro_f05"] > 0.5
    with open(f"{tmp_path}/out/candidate_pairs.tsv") as f:
        assert len(f.read().strip().split("\n")) == 17
    infer_from(spark, f"{tmp_path}/work", test, f"{tmp_path}/again")
    for name in ("candidate_pairs.tsv", "matching_results.tsv"):
        with open(f"{tmp_path}/out/{name}") as a, open(f"{tmp_path}/again/{name}") as b:
            assert a.read() == b.read()
