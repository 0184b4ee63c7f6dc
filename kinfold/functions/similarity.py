"""String similarities: the share of a longest common subsequence, in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType


def lcs_length(a: str, b: str) -> int:
    """Length of a longest common subsequence, a row of the table at a time as the bits of a number."""
    if not a or not b:
        return 0
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    everything = (1 << len(a)) - 1
    row = everything
    for c in b:
        met = row & places.get(c, 0)
        row = (row + met | row - met) & everything
    return len(a) - row.bit_count()


def ratio(a: str, b: str) -> float:
    """0 to 100: twice the common part over both lengths; 100 for two empty strings."""
    n = len(a) + len(b)
    return 200.0 * lcs_length(a, b) / n if n else 100.0


def token_sort_ratio(a: str, b: str) -> float:
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set_ratio(a: str, b: str) -> float:
    """The best ratio among the shared words and either side's shared words with its own rest."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both, only_a, only_b = (" ".join(sorted(s)) for s in (x & y, x - y, y - x))
    if both and (not only_a or not only_b):
        return 100.0
    with_a, with_b = f"{both} {only_a}".strip(), f"{both} {only_b}".strip()
    found = ratio(with_a, with_b)
    return max(found, ratio(both, with_a), ratio(both, with_b)) if both else found


_KINDS = {"ratio": ratio, "token_sort": token_sort_ratio, "token_set": token_set_ratio}


def similarity(kind: str, a: Column, b: Column) -> Column:
    """``kind`` of two string columns, over 100; null where either is null."""
    measure = _KINDS[kind]

    @F.pandas_udf("double")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for x, y in batches:
            yield pd.Series([None if p is None or q is None else measure(p, q) / 100 for p, q in zip(x, y, strict=True)], dtype="float64")

    return run(a, b)


#: The four ratios of a pair of records.
RATIOS = ["name_ratio", "name_token_set", "translit_ratio", "addr_ratio"]


@F.pandas_udf(StructType([StructField(r, DoubleType()) for r in RATIOS]))
def similarities(a: pd.Series, b: pd.Series, core_a: pd.Series, core_b: pd.Series, new_a: pd.Series, new_b: pd.Series, where_a: pd.Series, where_b: pd.Series) -> pd.DataFrame:
    """The four ratios of two records, over 100, in one go: of the folded names, the cores' token sets, the
    corrected names, and the sorted tokens of the addresses (0 where either is null)."""
    rows = []
    for x, y, cx, cy, nx, ny, wx, wy in zip(a, b, core_a, core_b, new_a, new_b, where_a, where_b, strict=True):
        whole = 100.0 if x == y else ratio(x, y)
        new = whole if (nx, ny) == (x, y) else 100.0 if nx == ny else ratio(nx, ny)
        rows.append((whole / 100, (100.0 if cx == cy and cx else token_set_ratio(cx, cy)) / 100, new / 100, 0.0 if wx is None or wy is None else 1.0 if wx == wy else token_sort_ratio(wx, wy) / 100))
    return pd.DataFrame(rows, columns=RATIOS, dtype="float64")
