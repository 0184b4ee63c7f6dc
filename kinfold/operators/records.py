"""Record store: validated, normalised records of three sources, and the truth between them.

A record is (rid, eid, source, country, name_key, missing, name, address); name and address are
structs of views, so that a query reads only the views it needs.  ``rid`` follows the order of
source and row and breaks every tie.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinfold.functions import text as T
from kinfold.functions.indic import transliterated
from kinfold.operators.store import saved

#: Longest text and id that are taken.
TEXT_LIMIT, ID_LIMIT = 4096, 128
#: Records of one source have numbers from source * SOURCE_STEP on.
SOURCE_STEP = 1 << 48
#: Bytes of views, by an estimate, that are sent to all tasks at most.
SENT = 32 << 20


def number(rows: DataFrame, source: int) -> DataFrame:
    """Adds ``rid`` in the order of the rows: from ``row``, a row's place in its source, or if the rows
    have none, in the order of entity_id.  Neither follows how the rows are dealt to partitions."""
    if "row" not in rows.columns:
        rows = placed(rows.orderBy("entity_id").withColumn("block", F.lit(0)).withColumn("at", F.monotonically_increasing_id()), by_partition=True)
    return rows.withColumn("rid", F.lit(source * SOURCE_STEP) + F.col("row")).drop("row")


def placed(rows: DataFrame, by_partition: bool = False) -> DataFrame:
    """``row``, from 0, of rows with (block, at): blocks in order, and inside a block the rows in order of
    ``at``, increasing numbers of one partition.  Blocks are counted, rows aren't sorted."""
    rows = saved(rows.withColumn("block", F.shiftright("at", 33)) if by_partition else rows)
    blocks = rows.groupBy("block").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # one row a block of a file
    starts = blocks.select("block", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return rows.join(F.broadcast(starts), "block").withColumn("row", F.col("start") + F.col("at") - F.col("first")).drop("block", "at", "first", "start")


def normalise(rows: DataFrame, source: int, rules: dict[str, str] | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Records of rows (rid, entity_id, business_name, business_address, country), with the columns ``keep``.

    One step a projection: a step reads its text more than once, so nested steps would multiply.
    """
    table = F.create_map(*[F.lit(x) for pair in rules.items() for x in pair]) if rules else None
    fields = ("name", "address")
    both = lambda new, made: {f"{f}_{new}": made(f) for f in fields}
    col = lambda f, view: F.col(f"{f}_{view}")
    words = lambda f, view: F.array_join(T.tokens(col(f, view)), " ")
    steps = rows.select(
        "rid", *keep, F.col("entity_id").alias("eid"), F.lit(source).alias("source"), T.unicode_view(T.missing_clean(F.col("country"))).alias("land"),
        *[F.coalesce(F.col(f"business_{f}"), F.lit("")).alias(f"{f}_raw") for f in fields],
    )
    steps = steps.withColumns({"country": F.array_join(T.tokens(F.col("land")), " "), **both("uni", lambda f: T.unicode_view(col(f, "raw")))})
    steps = steps.withColumns(both("cleaned", lambda f: T.clean_name(col(f, "uni")) if f == "name" else T.clean_address(col(f, "uni"))))
    steps = steps.withColumns(both("latin", lambda f: transliterated(col(f, "cleaned"))))
    steps = steps.withColumns({**both("cleaned", lambda f: T.unicode_view(col(f, "cleaned"))), **both("latin", lambda f: T.unicode_view(col(f, "latin")))})
    steps = steps.withColumns({**both("cons", lambda f: words(f, "cleaned")), **both("translit", lambda f: words(f, "latin"))})
    steps = steps.withColumns({**both("folded", lambda f: T.fold_accents(col(f, "cons"))), **both("roman", lambda f: T.fold_accents(col(f, "translit")))})
    steps = steps.withColumns(both("corrected", lambda f: T.respelt(col(f, "roman"), table if f == "name" else None)))
    core, legal = T.core_and_legal(F.col("name_corrected"))
    steps = steps.withColumns({"name_core": core, "name_legal": legal, "address_core": F.col("address_corrected"), "address_legal": F.lit("")})

    def field(f: str) -> Column:
        views = {"raw": "raw", "uni": "unicode", "cons": "conservative", "translit": "transliterated", "folded": "accent_folded", "roman": "roman", "corrected": "corrected", "core": "core", "legal": "legal"}
        return F.struct(*[col(f, v).alias(n) for v, n in views.items()], (col(f, "cons") != "").alias("has"), T.script_profile(col(f, "uni")).alias("script")).alias(f)

    made = steps.select("rid", *keep, "eid", "source", "country", *[field(f) for f in fields])
    return made.select("rid", *keep, "eid", "source", "country", F.col("name.core").alias("name_key"), (~F.col("address.has")).cast("int").alias("missing"), "name", "address")


def narrowed(records: DataFrame, views: dict[str, tuple[str, ...]] | None) -> DataFrame:
    """``records`` with only these ``views`` of name and address, or all."""
    if views is None:
        return records
    of = lambda f: F.struct(*[F.col(f"{f}.{v}").alias(v) for v in views[f]]).alias(f)
    return records.select(*[of(c) if c in views else F.col(c) for c in records.columns])


def normalised(rows: DataFrame, source: int, rules: dict[str, str] | None = None, share: float = 0.5) -> DataFrame:
    return all_normalised({source: rows}, rules, share)


def all_normalised(sources: dict[int, DataFrame], rules: dict[str, str] | None = None, share: float = 0.5, views: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """``normalise`` of all sources: where less than ``share`` of a source's rows have texts of their own, by an
    estimate in one pass, equal texts are normalised once and joined to their rows; if they are few, their
    views go to the rows and not the rows to them."""
    fields = ("business_name", "business_address", "country")
    texts = [f"said_{f}" for f in fields]
    plain = {s: rows.select("rid", F.col("entity_id").alias("eid"), *[F.coalesce(F.col(f), F.lit("")).alias(f"said_{f}") for f in fields]) for s, rows in sources.items()}
    size = sum((F.octet_length(t) for t in texts), F.lit(0))
    counted = [rows.agg(F.lit(s).alias("source"), F.count("*").alias("n"), F.approx_count_distinct(F.xxhash64(*texts)).alias("own"), F.avg(size).alias("bytes")) for s, rows in plain.items()]
    seen = {r.source: r for r in reduce(DataFrame.unionByName, counted).collect()}

    def of(s: int) -> DataFrame:
        if seen[s].own >= share * seen[s].n:
            return narrowed(normalise(sources[s], s, rules), views)
        once = plain[s].select(*texts).distinct().select(*texts, F.lit(0).cast("long").alias("rid"), F.lit("").alias("entity_id"), *[F.col(t).alias(t.removeprefix("said_")) for t in texts])
        made = narrowed(normalise(once, s, rules, tuple(texts)).drop("rid", "eid"), views)
        held = 2 + (sum(map(len, views.values())) if views else 20)
        made = F.broadcast(made) if seen[s].own * (held * (seen[s].bytes or 0) + 400) <= SENT else made
        return plain[s].join(made, texts).select("rid", "eid", "source", "country", "name_key", "missing", "name", "address")

    return reduce(DataFrame.unionByName, [of(s) for s in sources])


def row_violations(rows: DataFrame, source: int) -> DataFrame:
    """(check, violations) of source rows, in one pass."""
    eid = F.coalesce("entity_id", F.lit(""))
    long = reduce(lambda a, c: a | (F.length(F.coalesce(c, F.lit(""))) > TEXT_LIMIT), ["business_name", "business_address"], F.lit(False))
    checks = {"field too long": long, "id missing or too long": (eid == "") | (F.length(eid) > ID_LIMIT), "wrong id prefix": ~eid.startswith(f"S{source}-")}
    counted = rows.agg(*[F.coalesce(F.sum(c.cast("long")), F.lit(0)).alias(k) for k, c in checks.items()])
    return counted.unpivot([], list(checks), "check", "violations")


def require_none(violations: DataFrame) -> None:
    found = violations.where("violations > 0").collect()
    if found:
        raise ValueError("; ".join(f"{r['check']}: {r['violations']}" for r in found))


def ingest(sources: dict[int, DataFrame], rules: dict[str, str] | None = None) -> DataFrame:
    """All sources as one table of records; raises on any violation."""
    for source, rows in sources.items():
        require_none(row_violations(rows, source))
    records = all_normalised({s: number(rows, s) for s, rows in sources.items()}, rules)
    require_none(duplicate_ids(records))
    return records


def duplicate_ids(records: DataFrame) -> DataFrame:
    twice = records.groupBy("eid").agg(F.count("*").alias("n")).where("n > 1")
    return twice.agg(F.lit("duplicate id").alias("check"), F.count("*").alias("violations"))


def fetch(records: DataFrame, wanted: DataFrame) -> DataFrame:
    """The records of the wanted (rid); raises if one is missing."""
    wanted = wanted.select("rid").distinct()
    require_none(wanted.join(records, "rid", "left_anti").agg(F.lit("missing record").alias("check"), F.count("*").alias("violations")))
    return records.join(wanted, "rid", "left_semi")


def lookup(records: DataFrame, eids: DataFrame, allowed: tuple[int, ...]) -> DataFrame:
    """(eid, rid) of the ids asked for; rid is null for unknown ids and those of other sources."""
    held = records.where(F.col("source").isin(*allowed)).select("eid", "rid")
    return eids.select("eid").join(held, "eid", "left")


def external_ids(records: DataFrame, rids: DataFrame) -> DataFrame:
    return rids.join(records.select("rid", "eid"), "rid", "left")


def truth_rows(rows: DataFrame) -> DataFrame:
    """(q_eid, t_eid) of rows (source1_entity_id, matched_entity_ids)."""
    ids = F.filter(F.split(F.coalesce("matched_entity_ids", F.lit("")), ","), lambda x: x != "")
    return rows.select(F.col("source1_entity_id").alias("q_eid"), F.explode(ids).alias("t_eid"))


def load_truth(records: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((q), (q, t)) as record numbers; raises unless every source-1 record has one row, all ids are
    known in their source, and no row repeats an id."""
    queries = lookup(records, rows.select(F.col("source1_entity_id").alias("eid")), (1,))
    pairs = truth_rows(rows).join(records.where("source = 1").select(F.col("eid").alias("q_eid"), F.col("rid").alias("q")), "q_eid", "left").join(
        records.where("source in (2, 3)").select(F.col("eid").alias("t_eid"), F.col("rid").alias("t")), "t_eid", "left"
    )
    count = lambda df, name: df.agg(F.lit(name).alias("check"), F.count("*").alias("violations"))
    checks = [
        count(queries.where("rid is null"), "unknown or wrong-source query"),
        count(pairs.where("t is null"), "unknown or wrong-source target"),
        count(pairs.groupBy("q_eid", "t_eid").count().where("count > 1"), "duplicate truth id"),
        count(queries.groupBy("eid").count().where("count > 1"), "repeated query"),
        count(records.where("source = 1").join(queries, "eid", "left_anti"), "query without truth"),
    ]
    require_none(reduce(DataFrame.unionByName, checks))
    return queries.select(F.col("rid").alias("q")), pairs.select("q", "t")


def count_noise(rows: DataFrame) -> DataFrame:
    """(noise, n): how many rows show each kind of noise."""
    flags = T.noise_flags(F.col("business_name"), F.col("business_address"))
    flagged = rows.select(*[c.cast("long").alias(k) for k, c in flags.items()])  # ICU calls may not stand in an aggregate
    counted = flagged.agg(*[F.coalesce(F.sum(k), F.lit(0)).alias(k) for k in flags])
    return counted.unpivot([], list(flags), "noise", "n")


def suffix_counts(records: DataFrame) -> DataFrame:
    """(suffix, n): legal words at the very end of source-1 names."""
    last = F.element_at(F.split("name.conservative", " "), -1)
    return records.where("source = 1").select(last.alias("suffix")).where(F.col("suffix").isin(*T.LEGAL)).groupBy("suffix").agg(F.count("*").alias("n"))
