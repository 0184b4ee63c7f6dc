"""Mixes sources to target weights by a multivariate-hypergeometric splitting tree.

Every row has a 64-bit hash, whose first BLOCK_BITS say which of its source's blocks it is in, so
blocks are disjoint random sets of whole documents and need no sort.  A source's blocks are permuted,
and its target in words becomes an exact quota: so many of the permuted blocks, the last of them up
to a hash.  Targets above a source's own size take its blocks again in a second pass.

The tree splits the vector of block quotas among the output shards: at each node the left half gets
a multivariate-hypergeometric draw of what the node holds, exactly as if all blocks had been shuffled
together, but from counts alone.  Each leaf draws its disjoint run of each source's permuted blocks;
a row is taken as often as a leaf holds its block.  One row a source is then taken once more or less
to come closer still.  Inside a shard, rows are ordered by a second hash.

Only the table of counts (sources x blocks) is ever gathered by source; no document leaves its
partition except for the light rows (source, size, hash) of the blocks that a quota cuts through.
Targets and tree run over one row a source, so there may be MAX_SOURCES of them; more are an error.

Cases: a null text has size 0; a null source is a source of its own, last in order; rows alike in
doc_id and text get hashes of their own by their number, so they are taken one by one; an empty table
gives an empty table; other columns stay, but for ``mix_shard``, which is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinfold.llm.shared import WORD, hash64, in_few, numbered, written_in_few

#: Hash blocks a source: 2**BLOCK_BITS.
BLOCK_BITS = 12
#: An odd factor, which permutes the blocks, and a step by which sources' permutations differ.
STRIDE, STEP = 1_000_003, 7_919
#: Sources of one mix, at most.
MAX_SOURCES = 20_000
#: Below so many hashes of repeated rows (8 bytes each) they are broadcast.
FEW = 500_000


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: list[int], share: float, most: float) -> DataFrame:
    """Adds ``target`` to (source, source_size): ``share`` times all sizes by weight, none above
    ``most`` times its own size, the excess reshared by weight until none is above.

    In order of size over weight, the sources that stop at their bound are a first run; behind it
    all have one level, target over weight.  The windows run over one row a source.
    """
    everything = Window.partitionBy()
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    by_bound = Window.orderBy("bound_level", "rank")
    before = by_bound.rowsBetween(Window.unboundedPreceding, -1)
    behind = by_bound.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") - 1) % len(weights) + 1)
    rows = (
        sizes.withColumn("rank", F.row_number().over(in_order))
        .withColumn("weight", weight)
        .withColumn("bound", F.col("source_size") * F.lit(float(most)))
        .withColumn("bound_level", F.col("bound") / F.col("weight"))
        .withColumn("all", F.least(F.sum("source_size").over(everything) * F.lit(float(share)), F.sum("bound").over(everything)))
        .withColumn("level", (F.col("all") - F.coalesce(F.sum("bound").over(before), F.lit(0.0))) / F.sum("weight").over(behind))
        .withColumn("level", F.max(F.when(F.col("level") <= F.col("bound_level"), F.col("level"))).over(everything))
        .withColumn("target", F.least(F.col("bound"), F.coalesce(F.col("level"), F.col("bound_level")) * F.col("weight")))
    )
    return rows.select("source", "source_size", "rank", "target")


def hypergeometric(good: str, bad: str, draws: str, u: str) -> str:
    """SQL for one hypergeometric number by inversion of its distribution: of ``draws`` from
    ``good`` + ``bad``, how many are good, for a uniform ``u``.

    Ratios of neighbouring probabilities are multiplied up from the low end of the support; outside
    12 standard deviations and 40 the mass is below what a double can add, so it is left out.
    """
    known = f"named_struct('k', {good}, 'b', {bad}, 'n', {draws}, 'u', {u})"
    mode = "cast(floor((v.n + 1.0D) * (v.k + 1.0D) / (v.k + v.b + 2.0D)) as bigint)"
    spread = "cast(12 * sqrt(greatest(0.0D, v.n * 1.0D * v.k * v.b / greatest(1.0D, (v.k + v.b) * 1.0D * (v.k + v.b)))) as bigint) + 40"
    low = f"greatest(0L, v.n - v.b, {mode} - ({spread}))"
    high = f"least(v.k, v.n, {mode} + ({spread}))"
    ratio = "((w.k - x) * 1.0D * (w.n - x)) / ((x + 1.0D) * (w.b - w.n + x + 1.0D))"
    total = f"aggregate(sequence(w.low, w.high), named_struct('p', 1.0D, 'sum', 0.0D), (a, x) -> named_struct('p', a.p * {ratio}, 'sum', a.sum + a.p), a -> a.sum)"
    pick = (
        "aggregate(sequence(w.low, w.high), named_struct('p', 1.0D, 'sum', 0.0D, 'x', cast(null as bigint)), "
        f"(a, x) -> named_struct('p', a.p * {ratio}, 'sum', a.sum + a.p, 'x', coalesce(a.x, if(a.sum + a.p >= w.u * w.total, x, null))), a -> coalesce(a.x, w.high))"
    )
    step1 = f"transform(array({known}), v -> named_struct('k', v.k, 'b', v.b, 'n', v.n, 'u', v.u, 'low', {low}, 'high', {high}))"
    step2 = f"transform({step1}, w -> named_struct('k', w.k, 'b', w.b, 'n', w.n, 'u', w.u, 'low', w.low, 'high', w.high, 'total', {total}))"
    return f"transform({step2}, w -> {pick})[0]"


def splitting_tree(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """(rank, ends): for each source, how many of its permuted blocks the shards up to and with
    each one hold.  ``quotas`` has (rank, blocks); one row a source, so the tree is one row."""
    tree = quotas.groupBy().agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "blocks"))), lambda x: x.blocks).alias("q"))
    tree = tree.where(F.size("q") > 0).selectExpr(
        "q", f"array(named_struct('lo', 0, 'hi', {shards}, 'q', q)) as nodes", "aggregate(q, 0L, (a, x) -> a + x) as total"
    )
    left = f"(((n.lo + n.hi) div 2) * total div {shards} - n.lo * total div {shards})"
    u = f"((shiftrightunsigned(xxhash64({seed}, n.lo, n.hi, i), 11) + 0.5D) / 9007199254740992.0D)"
    draw = hypergeometric("n.q[i]", "(a.rest - n.q[i])", "a.need", u)
    drawn = (
        f"aggregate(sequence(0, size(n.q) - 1), named_struct('need', {left}, 'rest', aggregate(n.q, 0L, (s, y) -> s + y), 'out', cast(array() as array<bigint>)), "
        f"(a, i) -> transform(array({draw}), d -> named_struct('need', a.need - d, 'rest', a.rest - n.q[i], 'out', array_append(a.out, d)))[0], a -> a.out)"
    )
    split = (
        f"if(n.hi - n.lo < 2, array(n), transform(array({drawn}), d -> array(named_struct('lo', n.lo, 'hi', (n.lo + n.hi) div 2, 'q', d), "
        "named_struct('lo', (n.lo + n.hi) div 2, 'hi', n.hi, 'q', zip_with(n.q, d, (x, y) -> x - y))))[0])"
    )
    split = split.replace("(n.lo + n.hi) div 2,", "cast((n.lo + n.hi) div 2 as int),")
    width = shards
    while width > 1:
        tree = tree.selectExpr("q", "total", f"flatten(transform(nodes, n -> {split})) as nodes")
        width = (width + 1) // 2
    ends = f"transform(sequence(0, {shards - 1}), j -> aggregate(slice(nodes, 1, j + 1), 0L, (a, n) -> a + n.q[s.pos]))"
    return tree.selectExpr("nodes", "posexplode(q) as (pos, blocks)").selectExpr("nodes", "named_struct('pos', pos) as s").selectExpr("s.pos + 1 as rank", f"{ends} as ends")


def mix_plan(rows: DataFrame, weights: list[int], share: float, most: int, shards: int, seed: int) -> DataFrame:
    """What the mix takes of each row of (source, size, hash, ...), hashes being distinct:
    ``source_size``, ``target``, ``copies`` and ``shards``, the shard of each copy.

    In pass p a source's quota ends where the middle of a row, on the line of words in order of
    (permuted block, hash), reaches target - p * source_size: sums miss a target by half a row at
    most.  Inside one block that is a hash to stay below, so rows decide by themselves; only the rows
    of the block that the quota cuts are lined up.
    """
    blocks = 1 << BLOCK_BITS
    place = F.pmod(F.col("block") * STRIDE + F.col("rank") * STEP, F.lit(blocks))
    rows = rows.withColumn("block", F.shiftrightunsigned("hash", 64 - BLOCK_BITS))
    counts = written_in_few(rows.groupBy("source", "block").agg(F.sum("size").alias("words")))
    sizes = written_in_few(counts.groupBy("source").agg(F.sum("words").alias("source_size")))
    if sizes.count() > MAX_SOURCES:
        raise ValueError(f"a mix has at most {MAX_SOURCES} sources")
    goals = written_in_few(targets(sizes, weights, share, most))
    before = Window.partitionBy("rank").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    line = counts.alias("c").join(goals.alias("g"), F.expr("c.source <=> g.source")).select("g.rank", "c.block", "c.words").withColumn("place", place)
    line = line.withColumn("start", F.coalesce(F.sum("words").over(before), F.lit(0)))
    passes = goals.select("*", F.explode(F.sequence(F.lit(0), F.lit(most - 1))).alias("pass")).withColumn(
        "cut", F.greatest(F.lit(0.0), F.col("target") - F.col("pass") * F.col("source_size"))
    )
    passes = written_in_few(passes)
    whole = line.join(passes, "rank").select("source", "rank", "pass", "cut", "block", "place", "start", "words")
    cut_blocks = whole.where("start < cut and cut <= start + words")
    in_cut = rows.alias("r").join(cut_blocks.alias("c"), F.expr("r.source <=> c.source and r.block = c.block")).select("c.rank", "c.pass", "c.cut", "c.place", "c.start", "r.hash", "r.size")
    ahead = Window.partitionBy("rank", "pass").orderBy("hash").rowsBetween(Window.unboundedPreceding, -1)
    middles = in_cut.withColumn("middle", F.col("start") + F.coalesce(F.sum("size").over(ahead), F.lit(0)) + F.col("size") / 2)
    limits = middles.groupBy("rank", "pass").agg(F.first("place").alias("cut_place"), F.max(F.when(F.col("middle") < F.col("cut"), F.col("hash"))).alias("last_hash"))
    quota = F.when(F.col("cut") > 0, F.coalesce(F.col("cut_place") + 1, F.lit(blocks))).otherwise(0).cast("long")
    ends = written_in_few(passes.join(limits, ["rank", "pass"], "left").withColumn("quota", quota))
    earlier = Window.partitionBy("rank").orderBy("pass").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.withColumn("first", F.coalesce(F.sum("quota").over(earlier), F.lit(0)))
    of_source = ends.groupBy("source", "rank", "source_size", "target").agg(
        F.array_sort(F.collect_list(F.struct("pass", "first", "quota", "cut_place", "last_hash"))).alias("passes"), F.sum("quota").alias("blocks")
    )
    of_source = written_in_few(of_source)
    plan = written_in_few(of_source.join(splitting_tree(of_source.select("rank", "blocks"), shards, seed), "rank", "left"))
    planned = rows.alias("r").join(plan.alias("s"), F.expr("r.source <=> s.source"), "left").select("r.*", "s.source_size", "s.target", "s.passes", "s.blocks", "s.ends", "s.rank").withColumn("place", place)
    leaf = lambda index: F.size(F.filter("ends", lambda e: e <= index))

    def held(p: Column) -> Column:
        """Whether the row's block is in the quota that the leaves share out, and the row before its cut."""
        uncut = F.col("place") + 1 < p["quota"]
        return (leaf(p["first"] + F.col("place")) < shards) & (uncut | ((F.col("place") + 1 == p["quota"]) & (p["cut_place"].isNull() | (F.col("hash") <= p["last_hash"]))))

    planned = planned.withColumn("taken", F.filter("passes", held))
    change = one_change(planned.select("source", "target", "hash", "size", F.size("taken").alias("copies")), most)
    joined = planned.alias("p").join(change.alias("c"), F.expr("p.source <=> c.source"), "left").select("p.*", F.when(F.col("p.hash") == F.col("c.hash"), F.col("c.sign")).otherwise(0).alias("sign"))
    passes_taken = F.when(F.col("sign") < 0, F.slice("taken", 1, F.greatest(F.size("taken") - 1, F.lit(0)))).when(F.col("sign") > 0, F.slice("passes", 1, F.size("taken") + 1)).otherwise(F.col("taken"))
    # the one row that is taken beside the quota goes to the leaf of its place in the run of all blocks
    shard = lambda p: F.least(F.lit(shards - 1), leaf(F.pmod(p["first"] + F.col("place"), F.greatest(F.col("blocks"), F.lit(1)))))
    out = joined.withColumn("shards", F.transform(passes_taken, shard)).withColumn("copies", F.size("shards"))
    return out.drop("passes", "taken", "sign", "blocks", "ends", "rank", "block", "place")


def one_change(planned: DataFrame, most: int) -> DataFrame:
    """(source, hash, sign): for each source the one row to take once more or less that brings its sum
    nearest to the target, if any does.  Of all rows one is left a source, so this is a minimum."""
    got = planned.groupBy("source", "target").agg(F.sum(F.col("copies") * F.col("size")).alias("got"))
    need = written_in_few(got.select("source", (F.col("target") - F.col("got")).alias("need")))
    each = planned.where("size > 0").alias("a").join(need.alias("n"), F.expr("a.source <=> n.source")).select("a.source", "a.hash", "a.copies", "a.size", "n.need")
    sign = F.when((F.col("need") > 0) & (F.col("copies") < most), 1).when((F.col("need") < 0) & (F.col("copies") > 0), -1)
    left = F.abs(F.col("need") - F.col("sign") * F.col("size"))
    better = each.withColumn("sign", sign).withColumn("left", left).where(F.col("left") < F.abs("need"))
    best = better.groupBy("source").agg(F.min(F.struct("left", "hash", "sign")).alias("best"))
    return written_in_few(best.select("source", "best.hash", "best.sign"))


def row_hash(seed: int, doc_id: Column, text: Column) -> Column:
    """64 bits of an md5, which other engines have too."""
    parts = [F.lit(str(seed)), F.coalesce(doc_id.cast("string"), F.lit("-")), F.coalesce(text, F.lit(""))]
    return hash64(F.md5(F.concat_ws("|", *parts).cast("binary")))


def distinct_hashes(rows: DataFrame) -> DataFrame:
    """Written rows (hash, __row, ...) with a hash each: the first of those alike keeps theirs, others get
    one of hash and number."""
    own = hash64(F.md5(F.concat(F.hex("hash"), F.lit(":"), F.col("__number").cast("string")).cast("binary")))
    return numbered(rows, "hash").withColumn("hash", F.when(F.col("__number") == 0, F.col("hash")).otherwise(own)).drop("__number", "__row")


def mix(docs: DataFrame, weights: list[int], share: float = 1.5, most: int = 2, shards: int = 8, seed: int = 7) -> DataFrame:
    """The mixed documents: every row as often as it is taken, with ``mix_shard``, shuffled inside
    each shard (sorted by a hash in its partition).  Other columns stay as they are."""
    names = [f"`{c}`" for c in docs.columns if c != "mix_shard"]
    rows = docs.select(F.struct(*names).alias("row"), F.col("source"), word_count().alias("size"), row_hash(seed, F.col("doc_id"), F.col("text")).alias("hash"))
    light = written_in_few(rows.select("source", "size", "hash", F.monotonically_increasing_id().alias("__row")))
    repeated = written_in_few(light.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash"))
    n, whole = repeated.count(), rows.select("row", "hash")
    if n:
        some = F.broadcast(repeated) if n <= FEW else repeated
        many = written_in_few(whole.join(some, "hash", "left_semi").withColumn("__row", F.monotonically_increasing_id()))
        whole = whole.join(some, "hash", "left_anti").select("row", "hash").unionByName(distinct_hashes(many).select("row", "hash"))
    plan = mix_plan(written_in_few(distinct_hashes(light)), weights, share, most, shards, seed).where("copies > 0").select("hash", "shards")
    copies = whole.join(plan, "hash").select("row", "hash", F.posexplode("shards").alias("copy", "mix_shard"))
    return in_few(copies.withColumn("order", F.xxhash64("hash", "copy", F.lit(seed)))).sortWithinPartitions("mix_shard", "order").select("row.*", "mix_shard")


def op8_splitting_tree_mix(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    light = docs.select("doc_id", "source", word_count().alias("size"), row_hash(7, F.col("doc_id"), F.col("text")).alias("hash"), F.monotonically_increasing_id().alias("__row"))
    plan = mix_plan(written_in_few(distinct_hashes(written_in_few(light))), [3, 1, 2], 1.5, 2, 8, 7)
    return plan.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


OP8_SQL = r"""
WITH r0 AS (SELECT doc_id, source, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[ 	-
]+'), lambda x: x <> '')) AS size,
  ('0x' || substr(md5('7|' || coalesce(doc_id::VARCHAR, '-') || '|' || coalesce(text, '')), 1, 16))::UBIGINT AS h0 FROM documents),
r1 AS (SELECT *, row_number() OVER (PARTITION BY h0) - 1 AS nr FROM r0),
r AS MATERIALIZED (SELECT doc_id, source, size, h, h >> 52 AS block FROM (SELECT *, CASE WHEN nr = 0 THEN h0 ELSE ('0x' || substr(md5(printf('%X', h0) || ':' || nr), 1, 16))::UBIGINT END AS h FROM r1)),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM r GROUP BY source),
b AS (SELECT *, [3.0::DOUBLE, 1.0, 2.0][(rank - 1) % 3 + 1] AS weight, source_size * 2.0::DOUBLE AS bound FROM s),
l AS (SELECT *, (least((SELECT sum(source_size) FROM s) * 1.5::DOUBLE, (SELECT sum(bound) FROM b)) - coalesce(sum(bound) OVER (ORDER BY bound / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
  / sum(weight) OVER (ORDER BY bound / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM b),
g AS MATERIALIZED (SELECT source, rank, source_size, least(bound, coalesce((SELECT max(level) FROM l WHERE level <= bound / weight), bound / weight) * weight) AS target FROM l),
o AS (SELECT r.*, g.rank, source_size, target, (block * 1000003 + g.rank * 7919) % 4096 AS place FROM r JOIN g ON g.source IS NOT DISTINCT FROM r.source),
m AS MATERIALIZED (SELECT *, coalesce(sum(size) OVER (PARTITION BY rank ORDER BY place, h ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + size / 2 AS middle FROM o),
c AS MATERIALIZED (SELECT *, (target > 0 AND middle < target)::INT + (target > source_size AND middle < target - source_size)::INT AS copies FROM m),
need AS (SELECT rank, any_value(target) - sum(copies * size)::BIGINT AS need FROM c GROUP BY rank),
e AS (SELECT rank, h, need, size, CASE WHEN need > 0 AND copies < 2 THEN 1 WHEN need < 0 AND copies > 0 THEN -1 END AS sign FROM c JOIN need USING (rank) WHERE size > 0),
x AS (SELECT rank, h, sign FROM e WHERE abs(need - sign * size) < abs(need) QUALIFY row_number() OVER (PARTITION BY rank ORDER BY abs(need - sign * size), h >= 9223372036854775808 DESC, h, sign) = 1)
SELECT doc_id, size::BIGINT AS size, source_size, target, ((copies + coalesce(sign, 0)) * size)::BIGINT AS taken, (copies + coalesce(sign, 0))::INT AS copies FROM c LEFT JOIN x ON x.rank = c.rank AND x.h = c.h
"""
