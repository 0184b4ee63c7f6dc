"""Multi-view text normalisation as column expressions.

Everything stays in the JVM: Unicode forms come from ICU, which Spark brings along, through
``reflect``, and only for texts that aren't ASCII.  ``reflect`` counts as non-deterministic, so a
projection with views should be written or cached before it is aggregated.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The white space that separates words, word characters, and the marks cut off ends.
SPACE = r"[\t-\r\x1c-\x20\x85\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
LEFT, RIGHT = r"(?<![\p{L}\p{N}_])", r"(?![\p{L}\p{N}_])"
EDGES = " ,;|"

#: How noise in source texts looks.  address_hash is looked for in the address, all others in the name.
NOISE = {
    "leading_dash": rf"^{SPACE}*--+",
    "leading_star": rf"^{SPACE}*\*{{2,}}",
    "leading_angle": rf"^{SPACE}*<<+",
    "address_hash": rf"^{SPACE}*##+",
    "url": r"(?i)(?:https?://|www\.)\S+",
    "pipe": r"\|",
    "hashtag": r"#(?=[\p{L}\p{N}_])",
    "llc_repeat": rf"(?i){LEFT}LLC(?:{SPACE}+LLC)+{RIGHT}",
    "pvt_repeat": rf"(?i){LEFT}Pvt(?:{SPACE}+Pvt)+{RIGHT}",
    "ltd_repeat": rf"(?i){LEFT}Ltd(?:{SPACE}+Ltd)+{RIGHT}",
    "private_repeat": rf"(?i){LEFT}Private(?:{SPACE}+Private)+{RIGHT}",
}
NULL_ANGLE = rf"(?i)<{SPACE}*(?:null|nan|none){SPACE}*>"
NULL_WORD = rf"(?i){LEFT}(?:null|nan|none){RIGHT}"

#: Legal forms that may be stuttered, and legal forms at a name's end with the form they stand for.
STUTTERED = ["LLC", "Pvt", "Ltd", "Private", "Inc", "Corp", "Limited", "Corporation", "Company"]
LEGAL = {
    "incorporated": "inc", "inc": "inc", "corporation": "corp", "corp": "corp", "pvt": "private", "private": "private",
    "ltd": "limited", "limited": "limited", "llc": "llc", "co": "company", "company": "company",
}
#: Address abbreviations in the order in which they are written out, and landmark words.
ABBREVIATIONS = [
    (r"b\s*/\s*h", "", "behind"), ("opp", r"\.?", "opposite"), ("nr", r"\.?", "near"), ("adj", r"\.?", "adjacent"), ("rd", r"\.?", "road"),
    ("ave", r"\.?", "avenue"), ("blvd", r"\.?", "boulevard"), ("ln", r"\.?", "lane"), ("hwy", r"\.?", "highway"), ("ste", r"\.?", "suite"),
]
LANDMARKS = ["near", "opposite", "behind", "adjacent"]

_INDIC = r"[\u0900-\u0d7f&&\p{L}]"


def _replace(c: Column, pattern: str, by: str) -> Column:
    return F.regexp_replace(c, F.lit(pattern), F.lit(by))


def _collapse(c: Column) -> Column:
    return F.btrim(_replace(c, f"{SPACE}+", " "), F.lit(" "))


def _plain(c: Column) -> Column:
    """Whether there is nothing but ASCII in a text (or no text)."""
    return F.coalesce(F.octet_length(c) == F.length(c), F.lit(True))


def _icu(c: Column, kind: str, method: str, *args: bool) -> Column:
    """An ICU method on texts that hold more than ASCII."""
    made = F.reflect(F.lit(f"com.ibm.icu.{kind}"), F.lit(method), c, *[F.lit(a) for a in args])
    return F.when(_plain(c), c).otherwise(made)


def missing_clean(c: Column) -> Column:
    """'' for null; markers of missing values taken out, white space collapsed, EDGES cut off."""
    c = _replace(F.coalesce(c, F.lit("")), NULL_ANGLE, " ")
    return F.btrim(_collapse(_replace(c, NULL_WORD, " ")), F.lit(EDGES))


def unicode_view(c: Column) -> Column:
    return _icu(c, "text.Normalizer", "compose", True)


def fold_case(c: Column) -> Column:
    return F.when(_plain(c), F.lower(c)).otherwise(_icu(c, "lang.UCharacter", "foldCase", True))


def tokens(c: Column) -> Column:
    """Runs that begin with a letter or digit and go on with letters, digits and marks, case folded."""
    return F.regexp_extract_all(fold_case(c), F.lit(r"([\p{L}\p{N}][\p{L}\p{N}\p{M}]*)"), F.lit(1))


def conservative(c: Column) -> Column:
    return F.array_join(tokens(unicode_view(c)), " ")


def fold_accents(c: Column) -> Column:
    """Marks after Latin letters taken off; those of other scripts stay."""
    bare = _replace(F.reflect(F.lit("com.ibm.icu.text.Normalizer"), F.lit("decompose"), c, F.lit(False)), r"(\p{IsLatin})\p{M}+", "$1")
    return F.when(_plain(c), c).otherwise(_icu(bare, "text.Normalizer", "compose", False))


def clean_name(c: Column) -> Column:
    c = _replace(missing_clean(c), rf"^{SPACE}*[-*<>#~]+{SPACE}*", "")
    c = _replace(_replace(_replace(c, NOISE["url"], " "), NOISE["hashtag"], ""), NOISE["pipe"], " ")
    c = _replace(c, rf"(?i){LEFT}({'|'.join(STUTTERED)})(?:{SPACE}+\1)+{RIGHT}", "$1")
    return _collapse(_replace(c, rf"{SPACE}*&{SPACE}*", " and "))


def clean_address(c: Column) -> Column:
    c = _replace(_replace(missing_clean(c), NOISE["address_hash"], ""), NOISE["url"], " ")
    c = reduce(lambda x, rule: _replace(x, rf"(?i){LEFT}{rule[0]}{RIGHT}{rule[1]}", rule[2]), ABBREVIATIONS, c)
    return F.btrim(_collapse(c), F.lit(EDGES))


def core_and_legal(c: Column) -> tuple[Column, Column]:
    """A token string without the legal words at its end (whole if nothing else is left), and these
    words in their standing forms, neighbours alike joined."""
    ending = rf"^(.*?)((?:(?:^| )(?:{'|'.join(LEGAL)}))+)$"
    core, tail = F.regexp_extract(c, ending, 1), F.btrim(F.regexp_extract(c, ending, 2), F.lit(" "))
    forms = F.create_map(*[F.lit(x) for pair in LEGAL.items() for x in pair])
    said = F.transform(F.filter(F.split(tail, " "), lambda w: w != ""), lambda w: F.element_at(forms, w))
    once = F.filter(said, lambda w, i: (i == 0) | (w != F.get(said, i - 1)))
    return F.when((tail == "") | (core == ""), c).otherwise(core), F.array_join(once, " ")


def numbers(c: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(fold_case(c), F.lit(rf"{LEFT}(\p{{Nd}}+[a-z]?){RIGHT}"), F.lit(1)))


def address_parts(c: Column) -> Column:
    """Struct of the distinct tokens, house numbers and landmark words."""
    words = F.array_distinct(tokens(c))
    return F.struct(words.alias("tokens"), numbers(c).alias("numbers"), F.array_intersect(words, F.array(*[F.lit(x) for x in LANDMARKS])).alias("landmarks"))


def script_profile(c: Column) -> Column:
    """Struct of the shares of Indic, Latin and other letters among all letters; zeros without any."""
    n = F.regexp_count(c, F.lit(r"\p{L}"))
    indic, latin = F.regexp_count(c, F.lit(_INDIC)), F.regexp_count(c, F.lit(r"[\p{IsLatin}&&\p{L}]"))
    share = lambda x: F.when(n == 0, 0.0).otherwise(x / n)
    return F.struct(share(indic).alias("indic"), share(latin).alias("latin"), share(n - indic - latin).alias("other"))


def noise_flags(name: Column, address: Column) -> dict[str, Column]:
    """Which kinds of noise a record shows."""
    found = {k: F.coalesce(F.rlike(address if k == "address_hash" else name, F.lit(p)), F.lit(False)) for k, p in NOISE.items()}
    a = F.coalesce(address, F.lit(""))
    return found | {
        "blank_address": _collapse(a) == "",
        "angle_null": F.rlike(a, F.lit(NULL_ANGLE)),
        "generic_null": F.rlike(a, F.lit(NULL_WORD)),
        "unusable_after_clean": F.size(tokens(clean_address(a))) == 0,
    }


def respelt(c: Column, rules: Column | None) -> Column:
    """A token string with each token replaced by its rule, if there is one (a map column)."""
    if rules is None:
        return c
    return F.array_join(F.transform(F.filter(F.split(c, " "), lambda w: w != ""), lambda w: F.coalesce(F.try_element_at(rules, w), w)), " ")
