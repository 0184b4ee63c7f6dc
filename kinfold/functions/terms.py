"""Terms of the retrieval channels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kinfold.functions.text import tokens

#: Which view each channel reads, and whether its terms are stretches of letters or words.
CHANNEL_VIEWS = {
    "char": ("name.accent_folded", "grams"),
    "translit": ("name.corrected", "grams"),
    "rare": ("name.core", "words"),
    "address": ("address.corrected", "words"),
}
#: Channels that leave out terms which too many records share.
PRUNED = ("rare", "address")


def char_grams(c: Column, least: int = 3, most: int = 5) -> Column:
    """Stretches of ``least`` to ``most`` characters of each word with a blank at either side; repeats
    stay.  A padded word shorter than a length gives that length once, as it is."""
    words = F.filter(F.split(F.lower(c), r"\s+"), lambda w: w != "")

    def of_word(word: Column) -> Column:
        padded = F.concat(F.lit(" "), word, F.lit(" "))
        n = F.length(padded)
        lengths = F.sequence(F.lit(least), F.greatest(F.lit(least), F.least(F.lit(most), n)))
        return F.flatten(F.transform(lengths, lambda k: F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), n - k + 1)), lambda i: F.substring(padded, i, k))))

    return F.flatten(F.transform(words, of_word))


def channel_terms(channel: str, c: Column) -> Column:
    """The terms of a text of the view that a channel reads."""
    return char_grams(c) if CHANNEL_VIEWS[channel][1] == "grams" else tokens(c)
