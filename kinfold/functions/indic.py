"""Indic letters to Latin ones.

The nine Indic blocks of Unicode share one layout, so one table of offsets serves all: a consonant
carries an ``a`` unless a vowel sign or the sign that silences it follows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Offsets in a block and the Latin letters for them.
VOWELS = dict(zip([*range(0x05, 0x0D), *range(0x0E, 0x15)], "a ā i ī u ū r̥ l̥ e ē ai ô o ō au".split(), strict=True))
CONSONANTS = dict(zip(range(0x15, 0x3A), "k kh g gh ṅ c ch j jh ñ ṭ ṭh ḍ ḍh ṇ t th d dh n ṉ p ph b bh m y r ṟ l ḷ ḻ v ś ṣ s h".split(), strict=True))
SIGNS = dict(zip([*range(0x3E, 0x45), *range(0x46, 0x4D)], "ā i ī u ū r̥ r̥̄ e ē ai ô o ō au".split(), strict=True))
OTHERS = {0x01: "m̐", 0x02: "ṁ", 0x03: "ḥ", 0x3C: "", 0x3D: "'"} | {0x66 + d: str(d) for d in range(10)}
SILENCER = 0x4D
_RUN = re.compile("[\u0900-\u0d7f]+")


def _latin(run: re.Match) -> str:
    out, carries = [], False
    for c in run[0]:
        at = ord(c) & 0x7F
        if at in SIGNS and carries:
            out[-1] = SIGNS[at]
        elif at == SILENCER and carries:
            out[-1] = ""
        else:
            out.append(CONSONANTS.get(at) or VOWELS.get(at) or SIGNS.get(at) or OTHERS.get(at, "" if at == SILENCER else c))
        carries = at in CONSONANTS
        if carries:
            out.append("a")
    return "".join(out)


def transliterate(text: str) -> str:
    """Runs of Indic letters in Latin ones; all else as it is."""
    return _RUN.sub(_latin, text)


def transliterated(c: Column) -> Column:
    """``transliterate`` for texts that hold Indic letters; others don't leave the JVM's hands as
    more than a null."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(lambda t: None if t is None else transliterate(t))

    indic = F.rlike(c, F.lit(r"[\u0900-\u0d7f]"))
    return F.coalesce(run(F.when(indic, c)), c)
