"""DuckDB SQL for the queries, written apart from the engine: from the meaning of each operator."""

from __future__ import annotations

STEP = 1_000_000_000

_BRAND = "replace(p_brand, '#', ' ')"
_RAW = f"""raw AS (
  SELECT p_partkey::BIGINT AS k, 1 AS source, p_name || ' ' || {_BRAND} || ' ' || p_type || ' Ltd.' AS n, p_size || ' ' || p_type || ' Rd.' AS a, p_size FROM part JOIN supplier ON s_suppkey = p_partkey
  UNION ALL SELECT p_partkey, 2, '** ' || upper(p_name) || ' & ' || {_BRAND} || ' ' || p_type || ' Pvt LTD ltd', '##' || p_size || ' ' || p_type || ' Rd', p_size FROM part
  UNION ALL SELECT p_partkey, 3, p_name || ' ' || {_BRAND} || ' | ' || p_type || ' LLC LLC', CASE WHEN p_size % 7 = 0 THEN '<NULL>' ELSE p_size || ' ' || p_type || ' Road, nr ' || {_BRAND} END, p_size FROM part),
base AS (SELECT source * {STEP}::BIGINT + k AS rid, 'S' || source || '-' || k AS eid, source, n, a, CASE p_size % 3 WHEN 0 THEN 'us' WHEN 1 THEN 'india' ELSE '' END AS country FROM raw)"""


def _sub(x: str, *rules: tuple[str, str]) -> str:
    for pattern, by in rules:
        x = f"regexp_replace({x}, '{pattern}', '{by}', 'gi')"
    return x


def _missing(x: str) -> str:
    return "trim(" + _sub(x, (r"<\s*(?:null|nan|none)\s*>", " "), (r"\b(?:null|nan|none)\b", " "), (r"\s+", " ")) + ", ' ,;|')"


_STUTTER = [(rf"\b({w})(?:\s+{w})+\b", r"\1") for w in ("LLC", "Pvt", "Ltd", "Private", "Inc", "Corp", "Limited", "Corporation", "Company")]
_NAME = "trim(" + _sub(_missing("n"), (r"^\s*[-*<>#~]+\s*", ""), (r"(?:https?://|www\.)\S+", " "), (r"#(\w)", r"\1"), (r"\|", " "), *_STUTTER, (r"\s*&\s*", " and "), (r"\s+", " ")) + ")"
_SHORT = [(r"\bb\s*/\s*h\b", "behind"), (r"\bopp\b\.?", "opposite"), (r"\bnr\b\.?", "near"), (r"\badj\b\.?", "adjacent"), (r"\brd\b\.?", "road"), (r"\bave\b\.?", "avenue"), (r"\bblvd\b\.?", "boulevard"), (r"\bln\b\.?", "lane"), (r"\bhwy\b\.?", "highway"), (r"\bste\b\.?", "suite")]
_ADDRESS = "trim(" + _sub(_missing("a"), (r"^\s*##+", ""), (r"(?:https?://|www\.)\S+", " "), *_SHORT, (r"\s+", " ")) + ", ' ,;|')"
_WORDS = lambda x: f"regexp_extract_all(lower({x}), '[a-z0-9]+')"
_LEGAL = "incorporated|inc|corporation|corp|pvt|private|ltd|limited|llc|co|company"
_ENDING = f"'^(.*?)((?:(?:^| )(?:{_LEGAL}))+)$'"
_FORM = "CASE x WHEN 'incorporated' THEN 'inc' WHEN 'corporation' THEN 'corp' WHEN 'pvt' THEN 'private' WHEN 'ltd' THEN 'limited' WHEN 'co' THEN 'company' ELSE x END"

_REC = f"""{_RAW},
cleaned AS (SELECT *, {_NAME} AS cn, {_ADDRESS} AS ca FROM base),
views AS (SELECT *, array_to_string({_WORDS("cn")}, ' ') AS cons, array_to_string({_WORDS("ca")}, ' ') AS address FROM cleaned),
ended AS (SELECT *, regexp_extract(cons, {_ENDING}, 1) AS head, trim(regexp_extract(cons, {_ENDING}, 2)) AS tail FROM views),
forms AS (SELECT *, list_transform(list_filter(string_split(tail, ' '), lambda x: x <> ''), lambda x: {_FORM}) AS f FROM ended),
rec AS (SELECT rid, eid, source, n, a, cn, ca, country, cons, address, CASE WHEN tail = '' OR head = '' THEN cons ELSE head END AS core,
  array_to_string(list_filter(f, lambda x, i: i = 1 OR x <> f[i - 1]), ' ') AS legal, (address = '')::INT AS missing FROM forms)"""
_TRUTH = f"""truth AS (SELECT s_suppkey::BIGINT + {STEP} AS q, s_suppkey + m * {STEP}::BIGINT AS t FROM supplier, (VALUES (2), (3)) v(m) WHERE s_suppkey % 11 <> 0
  UNION SELECT s_suppkey + {STEP}::BIGINT, s_suppkey - 1 + 2 * {STEP}::BIGINT FROM supplier WHERE s_suppkey % 5 = 1)"""
_UNIVERSE = f"universe AS (SELECT s_suppkey::BIGINT + {STEP} AS q FROM supplier WHERE s_suppkey IN (SELECT p_partkey FROM part))"


def _grams(x: str) -> str:
    """All stretches of three to five characters of the padded words; here no word is shorter than one."""
    padded = f"list_transform(list_filter(string_split(lower({x}), ' '), lambda w: w <> ''), lambda w: ' ' || w || ' ')"
    one = "flatten(list_transform(range(3, greatest(3, least(5, length(w))) + 1), lambda k: list_transform(range(1, greatest(1, length(w) - k + 1) + 1), lambda i: substring(w, i, k))))"
    return f"flatten(list_transform({padded}, lambda w: {one}))"


def _terms(channel: str) -> str:
    x = {"char": _grams("cons"), "translit": _grams("cons"), "rare": _WORDS("core"), "address": _WORDS("address")}[channel]
    return f"SELECT '{channel}' AS channel, country, source, rid, term, count(*) AS tf FROM (SELECT country, source, rid, unnest({x}) AS term FROM rec) GROUP BY ALL"


def _index(*channels: str) -> str:
    return f"""tf AS MATERIALIZED ({" UNION ALL ".join(map(_terms, channels))}),
sizes AS (SELECT country, source, count(*) AS n FROM rec WHERE source > 1 GROUP BY ALL),
idf AS MATERIALIZED (SELECT channel, country, source, term, df, CASE WHEN channel IN ('rare', 'address') AND df > 0.2 * greatest(n, 1) THEN 0 ELSE ln((1 + n) / (1 + df)) + 1 END AS idf
  FROM (SELECT channel, country, source, term, count(*) AS df FROM tf WHERE source > 1 GROUP BY ALL) JOIN sizes USING (country, source)),
w0 AS (SELECT tf.*, ln(1 + tf) * idf AS w FROM tf JOIN idf USING (channel, country, source, term) WHERE idf > 0),
w AS MATERIALIZED (SELECT channel, country, source, rid AS t, term, w / sqrt(sum(w * w) OVER (PARTITION BY channel, rid)) AS w FROM w0)"""


_TOP = """qt AS (SELECT channel, rid AS q, term, ln(1 + tf) AS l FROM tf WHERE source = 1),
qp AS (SELECT qt.*, s.country, s.source, coalesce(i.idf, ln(1 + s.n) + 1) AS qi FROM qt CROSS JOIN sizes s LEFT JOIN idf i ON i.channel = qt.channel AND i.country = s.country AND i.source = s.source AND i.term = qt.term),
ql AS (SELECT channel, q, country, source, sqrt(sum((l * qi) ** 2)) AS len FROM qp GROUP BY ALL),
dots AS (SELECT channel, q, country, source, t, sum(l * qi * w) AS dot FROM qp JOIN w USING (channel, country, source, term) GROUP BY ALL),
sims AS (SELECT channel, q, country, source, t, round(dot / len, 9) AS score FROM dots JOIN ql USING (channel, q, country, source)),
top AS MATERIALIZED (SELECT q, t, source, channel, score FROM sims WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY channel, q, country, source ORDER BY score DESC, t)
  <= CASE channel WHEN 'char' THEN 20 WHEN 'translit' THEN 15 ELSE 10 END)"""


def _exact(limit: int) -> str:
    return f"""same AS (SELECT q.rid AS q, t.rid AS t, t.source, row_number() OVER (PARTITION BY q.rid, t.country, t.source ORDER BY t.rid) AS rank
  FROM rec q JOIN rec t ON q.core = t.core AND q.source = 1 AND t.source > 1 WHERE q.core <> ''),
exact AS (SELECT q, t, source FROM same WHERE rank <= {limit})"""


_HITS = f"""{_REC}, {_index("rare", "address")}, {_TOP}, {_exact(20)},
hits AS MATERIALIZED (SELECT * FROM top UNION ALL SELECT q, t, source, 'exact', 1.0 FROM exact)"""


def _fuse(k: int, name: str) -> str:
    return f"""{name}_g AS (SELECT q, channel, source, t, max(score) AS score FROM hits GROUP BY ALL),
{name}_r AS (SELECT *, row_number() OVER (PARTITION BY q, channel, source ORDER BY score DESC, t) AS rank FROM {name}_g
  QUALIFY rank <= CASE channel WHEN 'exact' THEN 20 WHEN 'char' THEN 20 WHEN 'translit' THEN 15 ELSE 10 END),
{name}_v AS (SELECT q, least(2, {k} // count(DISTINCT (channel, source))) AS cover FROM {name}_r GROUP BY q),
{name}_c AS (SELECT q, t, any_value(source) AS source, round(sum(1.0::DOUBLE / (60 + rank)), 12) AS rrf, bit_or(1 << CASE channel WHEN 'exact' THEN 0 WHEN 'char' THEN 1 WHEN 'rare' THEN 2 WHEN 'translit' THEN 3 ELSE 4 END) AS mask,
  max((rank <= cover)::INT) AS res FROM {name}_r JOIN {name}_v USING (q) GROUP BY q, t),
{name}_o AS (SELECT *, row_number() OVER o AS position, sum(res) OVER (PARTITION BY q) AS nres, sum(1 - res) OVER o AS npos FROM {name}_c WINDOW o AS (PARTITION BY q ORDER BY rrf DESC, bit_count(mask) DESC, t)),
{name} AS MATERIALIZED (SELECT q, t, source, mask, rrf, position FROM {name}_o WHERE res = 1 OR npos <= {k} - nres)"""


_FUSED = f"{_HITS}, {_fuse(10, 'fused')}, {_TRUTH}, {_UNIVERSE}"
_SCORED = f"{_FUSED}, scored AS MATERIALIZED (SELECT q, t, round(least(1.0, rrf * 25), 3) AS p FROM fused)"
_F05 = "CASE WHEN predicted + 0.25 * m = 0 THEN 1.0 ELSE 1.25 * tp / (predicted + 0.25 * m) END"


def _per_query(scored: str = "scored", name: str = "pq", tau: float = 0.6) -> str:
    return f"""{name} AS MATERIALIZED (SELECT u.q, coalesce(m.m, 0) AS m, coalesce(c.candidates, 0) AS candidates, coalesce(c.hit, 0) AS hit, coalesce(c.predicted, 0) AS predicted, coalesce(c.tp, 0) AS tp
  FROM universe u LEFT JOIN (SELECT q, count(*) AS m FROM truth GROUP BY q) m USING (q)
  LEFT JOIN (SELECT s.q, count(*) AS candidates, count(tr.t) AS hit, count(*) FILTER (WHERE p >= {tau}) AS predicted, count(tr.t) FILTER (WHERE p >= {tau}) AS tp
    FROM {scored} s LEFT JOIN truth tr ON tr.q = s.q AND tr.t = s.t GROUP BY s.q) c USING (q))"""


_ORACLE = "CASE WHEN m = 0 THEN 1.0 ELSE 5.0 * hit / (m + 4 * hit) END"
_TAGS = f"""tags AS (SELECT q, unnest(list_filter(['country:' || country, CASE WHEN m = 0 THEN 'singleton' ELSE 'non_singleton' END, CASE WHEN missing = 1 THEN 'true_vendor_missing_address' END,
  CASE WHEN m = 1 THEN 'one_match' WHEN m > 1 THEN 'many_matches' END], lambda x: x IS NOT NULL)) AS tag
  FROM (SELECT u.q, r.country, count(tr.t) AS m, max(v.missing) AS missing FROM universe u JOIN rec r ON r.rid = u.q LEFT JOIN truth tr ON tr.q = u.q LEFT JOIN rec v ON v.rid = tr.t GROUP BY ALL))"""

_COMPONENTS = f"""{_TRUTH}, qs AS (SELECT s_suppkey::BIGINT + {STEP} AS q FROM supplier),
reach(q, c) AS (SELECT q, q FROM qs UNION SELECT b.q, r.c FROM reach r JOIN truth a ON a.q = r.q JOIN truth b ON b.t = a.t),
comp AS MATERIALIZED (SELECT q, min(c) AS component FROM reach GROUP BY q)"""
_HASH = lambda x: f"('0x' || substr(md5({x}), 1, 15))::BIGINT"
_SPLIT = f"""{_COMPONENTS}, split AS (SELECT q, component, CASE WHEN b < 60 THEN 'fit' WHEN b < 65 THEN 'stop' WHEN b < 75 THEN 'cal_fit' WHEN b < 80 THEN 'cal_select' WHEN b < 90 THEN 'tune' ELSE 'final' END AS split
  FROM (SELECT *, {_HASH("component::VARCHAR")} % 100 AS b FROM comp))"""


def _top(channel: str) -> str:
    return f"WITH {_REC}, {_index(channel)}, {_TOP} SELECT q, t, source, round(score, 5) AS score FROM top"


def _terms_count(channel: str) -> str:
    return f"WITH {_REC}, tf AS ({_terms(channel)}) SELECT source, term, count(*) AS records, sum(tf)::BIGINT AS times FROM tf GROUP BY ALL"


def _listed(threshold: float, column: str) -> str:
    return f"""WITH {_SCORED} SELECT u.q, r.eid AS source1_entity_id, coalesce(x.ids, '') AS {column} FROM universe u JOIN rec r ON r.rid = u.q
LEFT JOIN (SELECT s.q, string_agg(t.eid, ',' ORDER BY t.eid) AS ids FROM scored s JOIN rec t ON t.rid = s.t WHERE p >= {threshold} GROUP BY s.q) x USING (q)"""


def _curve() -> str:
    ks = (5, 10, 20, 40, 60, 100)
    parts = ", ".join(f"{_fuse(k, f'f{k}')}, s{k} AS (SELECT q, t, 1.0 AS p FROM f{k}), {_per_query(f's{k}', f'p{k}')}" for k in ks)
    rows = " UNION ALL ".join(
        f"SELECT {k} AS k, count(*) AS queries, sum(candidates)::BIGINT AS pairs, round(avg({_ORACLE}), 6) AS oracle, round(avg(candidates), 6) AS mean_k, max(candidates) AS max_k, round(sum(hit) / sum(m), 6) AS pair_recall FROM p{k}" for k in ks
    )
    return f"WITH {_HITS}, {_TRUTH}, {_UNIVERSE}, {parts} {rows}"


_FEATURES = f"""WITH {_FUSED},
r AS (SELECT *, list_distinct({_WORDS("core")}) AS w, list_distinct({_WORDS("address")}) AS aw, list_distinct(regexp_extract_all(address, '\\b\\d+[a-z]?\\b')) AS nums,
  list_filter(list_distinct({_WORDS("address")}), lambda x: x IN ('near', 'opposite', 'behind', 'adjacent')) AS marks FROM rec),
nq AS (SELECT count(*) AS n FROM rec WHERE source = 1),
wi AS (SELECT term, ln((1 + any_value(n)) / (1 + count(*))) + 1 AS idf FROM (SELECT unnest(w) AS term FROM r WHERE source = 1), nq GROUP BY term),
p AS (SELECT f.q, f.t, f.mask, f.rrf, a.w AS aw, b.w AS bw, a.cons AS an, b.cons AS bn, a.core AS ac, b.core AS bc, a.legal AS al, b.legal AS bl, a.aw AS aa, b.aw AS ba, a.nums AS anu, b.nums AS bnu, a.marks AS am, b.marks AS bm,
  (a.missing + b.missing > 0) AS missing, a.country AS aco, b.country AS bco, b.source AS bs FROM fused f JOIN r a ON a.rid = f.q JOIN r b ON b.rid = f.t),
ro AS (SELECT q, t, sum(CASE WHEN list_contains(aw, term) AND list_contains(bw, term) THEN x ELSE 0 END) / greatest(sum(x), 1e-8) AS rare_overlap
  FROM (SELECT q, t, aw, bw, term, coalesce(idf, (SELECT ln(1 + n) + 1 FROM nq)) AS x FROM (SELECT q, t, aw, bw, unnest(list_distinct(list_concat(aw, bw))) AS term FROM p) LEFT JOIN wi USING (term)) GROUP BY q, t)
SELECT q, t, (an = bn)::INT::DOUBLE AS name_exact, (ac = bc)::INT::DOUBLE AS core_exact, round(JAC(aw, bw), 6) AS name_jaccard, round(coalesce(rare_overlap, 0), 6) AS rare_overlap, (al <> '' AND al = bl)::INT::DOUBLE AS legal_equal,
  CASE WHEN missing THEN 0 ELSE round(JAC(aa, ba), 6) END AS addr_jaccard, round(JAC(anu, bnu), 6) AS numeric_overlap, (len(anu) > 0 AND len(bnu) > 0 AND NOT list_has_any(anu, bnu))::INT::DOUBLE AS numeric_conflict,
  round(JAC(am, bm), 6) AS landmark_overlap, missing::INT::DOUBLE AS addr_missing, round(least(length(ac), length(bc)) / greatest(length(ac), length(bc), 1), 6) AS name_length_ratio, (aco <> '' AND aco = bco)::INT::DOUBLE AS country_equal,
  0.0::DOUBLE AS cross_script, 0.0::DOUBLE AS indic_fraction, (bs = 3)::INT::DOUBLE AS source3, bit_count(mask)::DOUBLE AS channels, (mask & 1)::DOUBLE AS retrieved_exact, ((mask >> 1) & 1)::DOUBLE AS retrieved_char, ((mask >> 2) & 1)::DOUBLE AS retrieved_rare,
  ((mask >> 3) & 1)::DOUBLE AS retrieved_translit, ((mask >> 4) & 1)::DOUBLE AS retrieved_address, ((mask >> 5) & 1)::DOUBLE AS retrieved_minhash_name, ((mask >> 6) & 1)::DOUBLE AS retrieved_minhash_joint, round(rrf, 6) AS rrf
FROM p LEFT JOIN ro USING (q, t)"""
for _a, _b in (("aw", "bw"), ("aa", "ba"), ("anu", "bnu"), ("am", "bm")):
    _FEATURES = _FEATURES.replace(f"JAC({_a}, {_b})", f"CASE WHEN len({_a}) + len({_b}) = 0 THEN 0 ELSE len(list_intersect({_a}, {_b})) / len(list_distinct(list_concat({_a}, {_b}))) END")


def _violations() -> str:
    """The same faults put into lists of ids; each check counted on its own."""
    ids = lambda p: f"SELECT u.q, r.eid, coalesce(x.ids, []) AS ids FROM universe u JOIN rec r ON r.rid = u.q LEFT JOIN (SELECT s.q, list(t.eid) AS ids FROM scored s JOIN rec t ON t.rid = s.t WHERE p >= {p} GROUP BY s.q) x USING (q)"
    checks = {
        "row in one file only": "SELECT count(*) FROM m FULL JOIN c ON m.eid = c.eid WHERE m.eid IS NULL OR c.eid IS NULL",
        "repeated query": "SELECT count(*) FROM (SELECT eid FROM m GROUP BY eid HAVING count(*) > 1)",
        "unknown query": "SELECT count(*) FROM m WHERE eid NOT IN (SELECT eid FROM rec WHERE source = 1)",
        "missing query": "SELECT count(*) FROM rec WHERE source = 1 AND eid NOT IN (SELECT eid FROM m)",
        "duplicate targets": "SELECT count(*) FROM m FULL JOIN c ON m.eid = c.eid WHERE len(list_distinct(m.ids)) < len(m.ids) OR len(list_distinct(c.ids)) < len(c.ids)",
        "matches outside candidates": "SELECT count(*) FROM m JOIN c ON m.eid = c.eid WHERE NOT list_has_all(c.ids, m.ids)",
        "unknown or wrong-source target": "SELECT count(*) FROM (SELECT unnest(ids) AS id FROM c) WHERE id NOT IN (SELECT eid FROM rec WHERE source > 1)",
    }
    rows = " UNION ALL ".join(f"SELECT '{k}' AS \"check\", ({v}) AS violations" for k, v in checks.items())
    return f"""WITH {_SCORED}, m0 AS ({ids(0.6)}), c0 AS ({ids(0.0)}),
m1 AS (SELECT q, CASE WHEN q % 8 = 5 THEN eid || 'x' ELSE eid END AS eid, CASE WHEN q % 5 = 1 THEN list_append(ids, 'S1-1') WHEN q % 6 = 2 THEN list_concat(['S2-1', 'S2-1'], ids) ELSE ids END AS ids FROM m0 WHERE q % 7 <> 3),
m AS MATERIALIZED (SELECT * FROM m1 UNION ALL SELECT * FROM m1 WHERE q % 9 = 4), c AS MATERIALIZED (SELECT eid, CASE WHEN q % 4 = 0 THEN list_append(ids, 'S4-1') ELSE ids END AS ids FROM c0) {rows}"""


def _minhash(mode: str) -> str:
    """Least values of 64 functions over the words' md5 numbers, in 16 bands of 4; of equal word sets the
    first ten can be taken."""
    words = f"list_distinct({_WORDS('core')})" if mode == "name" else f"list_distinct(list_concat({_WORDS('core')}, {_WORDS('address')}))"
    number = lambda at: f"('0x' || substr(md5('sketch ' || i), {at}, 7))::BIGINT"
    return f"""WITH {_REC}, r AS MATERIALIZED (SELECT rid, source, country, missing, {words} AS w FROM rec WHERE len({words}) > 0),
f AS (SELECT i, 1 + {number(1)} AS a, {number(8)} AS b FROM range(64) t(i)),
x AS (SELECT rid, ('0x' || substr(md5(word), 1, 8))::BIGINT % 2147483647 AS x FROM (SELECT rid, unnest(w) AS word FROM r)),
least AS MATERIALIZED (SELECT rid, i, min((x * a + b) % 2147483647) AS m FROM x, f GROUP BY ALL),
bands AS MATERIALIZED (SELECT rid, i // 4 AS b, list(m ORDER BY i) AS key FROM least GROUP BY ALL),
t AS (SELECT * FROM r WHERE source > 1 AND missing = {int(mode == "name")} QUALIFY row_number() OVER (PARTITION BY country, source, list_sort(w) ORDER BY rid) <= 10),
q AS (SELECT * FROM r WHERE source = 1{"" if mode == "name" else " AND missing = 0"}),
met AS (SELECT DISTINCT q.rid AS q, t.rid AS t FROM q JOIN bands bq ON bq.rid = q.rid JOIN bands bt ON bt.b = bq.b AND bt.key = bq.key JOIN t ON t.rid = bt.rid),
s AS (SELECT met.q, met.t, t.source, t.country, len(list_intersect(q.w, t.w)) / len(list_distinct(list_concat(q.w, t.w))) AS score FROM met JOIN q ON q.rid = met.q JOIN t ON t.rid = met.t)
SELECT q, t, source, 'minhash_{mode}' AS channel, score FROM s QUALIFY row_number() OVER (PARTITION BY q, country, source ORDER BY score DESC, t) <= 10"""


def _ratios() -> str:
    """The string ratios by longest common subsequences, a row of the table at a time as the bits of a
    128-bit number, joined to the other features; no string here is longer than 120 characters."""
    words = lambda c: f"list_filter(string_split({c}, ' '), lambda x: x <> '')"
    joined = lambda c: f"array_to_string(list_sort({c}), ' ')"
    return f"""WITH native AS ({_FEATURES}),
k AS MATERIALIZED (SELECT native.q, native.t, native.addr_missing, a.cons AS an, b.cons AS bn, a.core AS ac, b.core AS bc, a.address AS aa, b.address AS ba FROM native JOIN (WITH {_REC} SELECT * FROM rec) a ON a.rid = native.q JOIN (WITH {_REC} SELECT * FROM rec) b ON b.rid = native.t),
w AS (SELECT *, list_distinct({words("ac")}) AS aw, list_distinct({words("bc")}) AS bw FROM k),
p AS MATERIALIZED (SELECT *, {joined("list_intersect(aw, bw)")} AS s, {joined("list_filter(aw, lambda x: NOT list_contains(bw, x))")} AS oa, {joined("list_filter(bw, lambda x: NOT list_contains(aw, x))")} AS ob FROM w),
pairs AS (SELECT q, t, 'name' AS kind, an AS x, bn AS y FROM p UNION ALL SELECT q, t, 'addr', {joined(words("aa"))}, {joined(words("ba"))} FROM p UNION ALL SELECT q, t, 'set1', trim(s || ' ' || oa), trim(s || ' ' || ob) FROM p
  UNION ALL SELECT q, t, 'set2', s, trim(s || ' ' || oa) FROM p UNION ALL SELECT q, t, 'set3', s, trim(s || ' ' || ob) FROM p),
masks AS (SELECT q, t, kind, length(x) AS nx, length(y) AS ny, (1::HUGEINT << length(x)) - 1 AS ones, list_transform(string_split(y, ''), lambda c: coalesce(list_sum(list_transform(range(1, length(x) + 1), lambda i: CASE WHEN x[i] = c THEN 1::HUGEINT << (i - 1)::INT ELSE 0::HUGEINT END)), 0)::HUGEINT) AS m FROM pairs),
lcs AS (SELECT q, t, kind, nx, ny, CASE WHEN nx = 0 OR ny = 0 THEN 0 ELSE nx - bit_count(list_reduce(list_concat([ones], m), lambda v, u: ((v + (v & u)) | (v - (v & u))) & ones)) END AS n FROM masks),
r AS (SELECT q, t, kind, CASE WHEN nx + ny = 0 THEN 1.0 ELSE 2 * n / (nx + ny) END AS r FROM lcs),
z AS (SELECT q, t, max(r) FILTER (WHERE kind = 'name') AS nr, max(r) FILTER (WHERE kind = 'addr') AS ar, max(r) FILTER (WHERE kind = 'set1') AS s1, max(r) FILTER (WHERE kind IN ('set2', 'set3')) AS s2 FROM r GROUP BY q, t)
SELECT native.*, round(nr, 6) AS name_ratio, round(CASE WHEN len(aw) = 0 OR len(bw) = 0 THEN 0 WHEN s <> '' AND (oa = '' OR ob = '') THEN 1 WHEN s <> '' THEN greatest(s1, s2) ELSE s1 END, 6) AS name_token_set, round(nr, 6) AS translit_ratio,
  CASE WHEN native.addr_missing = 1 THEN 0 ELSE round(ar, 6) END AS addr_ratio FROM native JOIN z USING (q, t) JOIN p USING (q, t)"""


_NOISES = {
    "leading_dash": r"n, '^\s*--+'", "leading_star": r"n, '^\s*\*{2,}'", "leading_angle": r"n, '^\s*<<+'", "address_hash": r"a, '^\s*##+'", "url": r"n, '(?i)(?:https?://|www\.)\S+'", "pipe": r"n, '\|'", "hashtag": r"n, '#\w'",
    "llc_repeat": r"n, '(?i)\bLLC(?:\s+LLC)+\b'", "pvt_repeat": r"n, '(?i)\bPvt(?:\s+Pvt)+\b'", "ltd_repeat": r"n, '(?i)\bLtd(?:\s+Ltd)+\b'", "private_repeat": r"n, '(?i)\bPrivate(?:\s+Private)+\b'",
    "blank_address": r"a, '^\s*$'", "angle_null": r"a, '(?i)<\s*(?:null|nan|none)\s*>'", "generic_null": r"a, '(?i)\b(?:null|nan|none)\b'",
}

ORACLES: dict[str, str] = {
    "missing_clean": f"WITH {_RAW} SELECT rid, {_missing('n')} AS name, {_missing('a')} AS address FROM base",
    "clean_name": f"WITH {_REC} SELECT rid, cn AS name FROM rec",
    "clean_address": f"WITH {_REC} SELECT rid, ca AS address FROM rec",
    "tokens": f"WITH {_REC} SELECT rid, cons AS name, address FROM rec",
    "core_legal": f"WITH {_REC} SELECT rid, core, legal FROM rec",
    "address_parts": f"""WITH {_REC}, p AS (SELECT rid, list_distinct({_WORDS("ca")}) AS x, {_WORDS("ca")} AS w, regexp_extract_all(lower(ca), '\\b\\d+[a-z]?\\b') AS nums FROM rec)
SELECT rid, array_to_string(list_filter(w, lambda v, i: list_position(w, v) = i), ' ') AS tokens, array_to_string(list_filter(nums, lambda v, i: list_position(nums, v) = i), ' ') AS numbers,
  array_to_string(list_filter(w, lambda v, i: list_position(w, v) = i AND v IN ('near', 'opposite', 'behind', 'adjacent')), ' ') AS landmarks FROM p""",
    "accent_fold": "SELECT doc_id, md5(strip_accents(text)) AS folded FROM documents",
    "script_profile": r"SELECT doc_id, CASE WHEN len(l) = 0 THEN 0 ELSE round(len(list_filter(l, lambda c: regexp_matches(c, '\p{Latin}'))) / len(l), 6) END AS latin, 0.0::DOUBLE AS indic FROM (SELECT doc_id, regexp_extract_all(text, '\p{L}') AS l FROM documents)",
    "char_grams": f"SELECT s_suppkey, array_to_string(list_sort({_grams('s_name')}), '|') AS grams FROM supplier",
    "transliterate": "SELECT p_partkey, ['globala', 'kulopal', 'pavara', 'Sun pavara', 'plain'][p_partkey % 5 + 1] || ' ' || p_partkey AS latin FROM part",
    "noise_counts": f"WITH {_REC} " + " UNION ALL ".join(f"SELECT '{k}' AS noise, count(*) FILTER (WHERE regexp_matches({v})) AS n FROM rec" for k, v in _NOISES.items()) + " UNION ALL SELECT 'unusable_after_clean', count(*) FILTER (WHERE address = '') FROM rec",
    "suffix_counts": f"WITH {_REC} SELECT suffix, count(*) AS n FROM (SELECT regexp_extract(cons, '[^ ]+$') AS suffix FROM rec WHERE source = 1) WHERE regexp_full_match(suffix, '{_LEGAL}') GROUP BY suffix",
    "ingest_records": f"WITH {_REC} SELECT rid, eid, source, country, core AS name_key, missing, address FROM rec",
    "record_lookup": f"WITH {_REC} SELECT 'S2-' || c_custkey AS eid, r.rid FROM customer LEFT JOIN rec r ON r.eid = 'S2-' || c_custkey AND r.source > 1",
    "truth_load": f"WITH {_TRUTH} SELECT q, t FROM truth",
    "char_ngrams": _terms_count("char"),
    "word_terms": _terms_count("rare"),
    "idf_table": f"WITH {_REC}, {_index('rare', 'address')} SELECT channel, country, source, term, df, round(idf, 6) AS idf FROM idf",
    "tfidf_weights": f"WITH {_REC}, {_index('rare', 'address')} SELECT channel, country, source, t, term, round(w, 6) AS w FROM w",
    "feature_word_idf": f"WITH {_REC}, nq AS (SELECT count(*) AS n FROM rec WHERE source = 1) SELECT term, round(ln((1 + any_value(n)) / (1 + count(*))) + 1, 6) AS idf FROM (SELECT unnest(list_distinct({_WORDS('core')})) AS term FROM rec WHERE source = 1), nq GROUP BY term UNION ALL SELECT NULL, round(ln(1 + n) + 1, 6) FROM nq",
    "exact_channel": f"WITH {_REC}, {_exact(20)} SELECT q, t, source FROM exact",
    "exact_overflow": f"WITH {_REC}, {_exact(1)} SELECT DISTINCT q FROM same WHERE rank > 1",
    "route_countries": f"WITH {_REC} SELECT DISTINCT q.rid AS q, t.country FROM rec q JOIN (SELECT DISTINCT country FROM rec WHERE source > 1) t ON q.country = '' OR t.country IN (q.country, '') WHERE q.source = 1",
    "topk_rare": _top("rare"),
    "topk_address": _top("address"),
    "topk_char": _top("char"),
    "topk_translit": _top("translit"),
    "fuse_candidates": f"WITH {_FUSED} SELECT q, t, source, mask, round(rrf, 9) AS rrf, position FROM fused",
    "retrieval_benchmark": f"""WITH {_FUSED}, s AS (SELECT q, t, 1.0 AS p FROM fused), {_per_query("s")}, b AS (SELECT DISTINCT q, t, 1.0 AS p FROM hits), {_per_query("b", "pb")}
SELECT count(*) AS queries, sum(candidates)::BIGINT AS pairs, round(avg({_ORACLE}), 6) AS oracle, round(avg(candidates), 6) AS mean_k, quantile_disc(candidates, 0.95) AS p95_k, quantile_disc(candidates, 0.99) AS p99_k, max(candidates) AS max_k,
  round(sum(hit) / sum(m), 6) AS pair_recall, (SELECT round(avg({_ORACLE}), 6) FROM pb) AS precap_oracle, (SELECT count(DISTINCT q) FROM same WHERE rank > 20) AS exact_overflows FROM pq""",
    "budget_curve": _curve(),
    "pair_features_native": _FEATURES,
    "components": f"WITH RECURSIVE {_COMPONENTS} SELECT * FROM comp",
    "split_assignment": f"WITH RECURSIVE {_SPLIT} SELECT q, component, split FROM split",
    "select_queries": f"WITH RECURSIVE {_SPLIT} SELECT q FROM split WHERE split = 'fit' ORDER BY {_HASH("'42:' || q")}, q LIMIT 20",
    "sample_train": f"""WITH {_HITS}, {_fuse(20, "fused")}, {_TRUTH},
l AS (SELECT f.q, f.t, rrf, (tr.t IS NOT NULL)::INT AS y FROM fused f LEFT JOIN truth tr ON tr.q = f.q AND tr.t = f.t),
h AS (SELECT *, row_number() OVER (PARTITION BY q, y ORDER BY rrf DESC, t) <= 5 AS hard FROM l)
SELECT q, t, y FROM h QUALIFY y = 1 OR hard OR row_number() OVER (PARTITION BY q, y, hard ORDER BY {_HASH("'42:' || q || ':' || t")}, t) <= 5""",
    "learn_spelling": "SELECT CASE p_partkey % 3 WHEN 0 THEN 'kulopal' ELSE 'dilli' END AS x, CASE p_partkey % 3 WHEN 0 THEN 'global' ELSE 'delhi' END AS y, count(*) AS n FROM part WHERE p_partkey % 3 < 2 GROUP BY ALL",
    "fetch_records": f"WITH {_REC} SELECT rid, eid, core AS name_key FROM rec WHERE source = 2 AND (rid - 2 * {STEP}::BIGINT) % 3 = 0",
    "external_ids": f"WITH {_REC} SELECT c_custkey + 3 * {STEP}::BIGINT AS rid, eid FROM customer LEFT JOIN rec ON rid = c_custkey + 3 * {STEP}::BIGINT",
    "pair_groups": f"WITH RECURSIVE {_COMPONENTS} SELECT q, t, component FROM truth JOIN comp USING (q)",
    "topk_verified": f"WITH {_REC}, {_index('rare')}, {_TOP.replace('FROM dots JOIN ql USING', 'FROM (SELECT dots.* FROM dots JOIN rec o ON o.rid = q WHERE dots.country IN (o.country, chr(0)) OR dots.country = E_ OR o.country = E_) dots JOIN ql USING').replace('E_', chr(39) * 2)} SELECT q, t, source, round(score, 5) AS score FROM top",
    "fuse_default": f"""WITH {_REC}, {_index("char", "rare", "translit")}, {_TOP}, {_exact(20)}, hits AS MATERIALIZED (SELECT * FROM top UNION ALL SELECT q, t, source, 'exact', 1.0 FROM exact),
{_fuse(60, "fused")} SELECT q, t, source, mask, round(rrf, 9) AS rrf, position FROM fused""",
    "decide": f"WITH {_SCORED} SELECT q, t FROM scored WHERE p >= 0.6",
    "entity_f05": f"WITH {_SCORED}, {_per_query()} SELECT q, m, candidates, hit, predicted, tp, round({_F05}, 6) AS f05, round({_ORACLE}, 6) AS oracle FROM pq",
    "threshold_sweep": f"""WITH {_SCORED}, g AS (SELECT range AS step, CASE WHEN range = 1001 THEN 1.5::DOUBLE ELSE range / 1000.0::DOUBLE END AS tau FROM range(1002)), qm AS (SELECT u.q, count(tr.t) AS m FROM universe u LEFT JOIN truth tr USING (q) GROUP BY u.q),
c AS (SELECT s.q, p, count(*) AS c, count(tr.t) AS tp FROM scored s LEFT JOIN truth tr ON tr.q = s.q AND tr.t = s.t GROUP BY ALL),
v AS (SELECT q, p, m, sum(c) OVER d AS acc, sum(tp) OVER d AS tp FROM c JOIN qm USING (q) WINDOW d AS (PARTITION BY q ORDER BY p DESC)),
x AS (SELECT q, p, 1.25 * tp / (acc + 0.25 * m) AS f, CASE WHEN m = 0 THEN 1.0 ELSE 0.0 END AS e FROM v),
y AS (SELECT q, p, f - coalesce(lag(f) OVER (PARTITION BY q ORDER BY p DESC), e) AS delta FROM x), b AS (SELECT sum(CASE WHEN m = 0 THEN 1.0 ELSE 0.0 END) AS base, count(*) AS n FROM qm)
SELECT step::INT AS step, round((base + coalesce(sum(delta), 0)) / n, 6) AS score FROM g CROSS JOIN b LEFT JOIN y ON tau <= p GROUP BY step, base, n""",
    "evaluate_slices": f"""WITH {_SCORED}, {_per_query()}, {_TAGS}, all_tags AS (SELECT q, tag FROM tags UNION ALL SELECT q, 'all' FROM universe)
SELECT tag, count(*) AS n, round(avg({_F05}), 6) AS macro_f05, round(avg({_ORACLE}), 6) AS oracle, round(sum(hit) / nullif(sum(m), 0), 6) AS pair_recall, round(avg((hit = m)::INT) FILTER (WHERE m > 0), 6) AS complete_recall FROM pq JOIN all_tags USING (q) GROUP BY tag""",
    "difficulty_tags": f"WITH {_REC}, {_TRUTH}, {_UNIVERSE}, {_TAGS} SELECT q, tag FROM tags",
    "mine_hard_negatives": f"WITH {_SCORED} SELECT s.q, s.t, p FROM scored s LEFT JOIN truth tr ON tr.q = s.q AND tr.t = s.t WHERE tr.t IS NULL QUALIFY row_number() OVER (PARTITION BY s.q ORDER BY p DESC, s.t) = 1",
    "match_output": _listed(0.6, "matched_entity_ids"),
    "candidate_output": _listed(0.0, "candidate_entity_ids"),
    "output_violations": _violations(),
    "brier": f"WITH {_SCORED} SELECT round(avg((p - (tr.t IS NOT NULL)::INT) ** 2), 6) AS brier FROM scored s LEFT JOIN truth tr ON tr.q = s.q AND tr.t = s.t",
    "memory_estimates": f"""WITH {_REC}, {_TRUTH}, e AS (SELECT 'records' AS "table", count(*) AS row_count, sum(40 + strlen(eid) + strlen(country) + strlen(core))::BIGINT AS total_bytes FROM rec UNION ALL SELECT 'truth', count(*), count(*) * 24 FROM truth)
SELECT "table", row_count, round(total_bytes / row_count, 6) AS row_bytes, total_bytes FROM e""",
    "minhash_name": _minhash("name"),
    "minhash_joint": _minhash("joint"),
    "pair_features_ratio": _ratios(),
}
