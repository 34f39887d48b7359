"""Fixed word lists.  All are short literals; none grows with the data."""

from __future__ import annotations

# Language evidence words.  Insertion order is the tie order.
STOPWORDS: dict[str, list[str]] = {
    "en": "the of and to in is that it for as with on be at by this from or an are".split(),
    "fr": "le la les et des est pour pas que une dans sur par au du en il qui".split(),
    "es": "el los las que de y en un por con para una es se del no lo su".split(),
    "de": "der die und das ist nicht sich auf ein eine mit den von zu für im dem auch".split(),
}

# Spellings that mean "missing" after a CSV round trip.
MISSING: list[str] = ["", "None", "NA", "null", "NaN", "N/A"]


def all_stopwords() -> list[str]:
    return sorted({w for words in STOPWORDS.values() for w in words})
