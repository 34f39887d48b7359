"""Porter suffix stripping for ROUGE tokens.

Written from M. F. Porter, "An algorithm for suffix stripping" (1980), with the
usual departures of the toolkit that ROUGE implementations rely on: a table of
irregular forms, ``ies``/``ied`` on four-letter words, ``y`` after a consonant,
``alli``, ``fulli`` and ``logi``.
"""

from __future__ import annotations

import re
from functools import lru_cache

# Irregular forms.
IRREGULAR = {
    "skies": "sky",
    "sky": "sky",
    "dying": "die",
    "lying": "lie",
    "tying": "tie",
    "news": "news",
    "innings": "inning",
    "inning": "inning",
    "outings": "outing",
    "outing": "outing",
    "cannings": "canning",
    "canning": "canning",
    "howe": "howe",
    "proceed": "proceed",
    "exceed": "exceed",
    "succeed": "succeed",
}

# Suffix -> replacement, tried in this order; needs measure > 0.
STEP_2 = [
    ("ational", "ate"),
    ("tional", "tion"),
    ("enci", "ence"),
    ("anci", "ance"),
    ("izer", "ize"),
    ("bli", "ble"),
    ("alli", "al"),
    ("entli", "ent"),
    ("eli", "e"),
    ("ousli", "ous"),
    ("ization", "ize"),
    ("ation", "ate"),
    ("ator", "ate"),
    ("alism", "al"),
    ("iveness", "ive"),
    ("fulness", "ful"),
    ("ousness", "ous"),
    ("aliti", "al"),
    ("iviti", "ive"),
    ("biliti", "ble"),
    ("fulli", "ful"),
]
STEP_3 = [
    ("icate", "ic"),
    ("ative", ""),
    ("alize", "al"),
    ("iciti", "ic"),
    ("ical", "ic"),
    ("ful", ""),
    ("ness", ""),
]
# Suffixes removed when the measure of the rest is > 1.
STEP_4 = (
    "al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize"
).split()

_VOWEL_RUN = re.compile(r"v+c+")


def _shape(word: str) -> str:
    """The word as a string of c (consonant) and v (vowel)."""
    out: list[str] = []
    for i, ch in enumerate(word):
        if ch in "aeiou":
            out.append("v")
        elif ch == "y" and i > 0 and out[-1] == "c":
            out.append("v")
        else:
            out.append("c")
    return "".join(out)


def _measure(stem: str) -> int:
    return len(_VOWEL_RUN.findall(_shape(stem)))


def _has_vowel(stem: str) -> bool:
    return "v" in _shape(stem)


def _double_consonant(word: str) -> bool:
    return len(word) > 1 and word[-1] == word[-2] and _shape(word)[-1] == "c"


def _short_end(word: str) -> bool:
    """Consonant-vowel-consonant end, the last not w, x or y; or a vowel-consonant
    word of two letters."""
    shape = _shape(word)
    if len(word) == 2:
        return shape == "vc"
    return shape[-3:] == "cvc" and word[-1] not in "wxy"


def _plural(w: str) -> str:
    if w.endswith("ies") and len(w) == 4:
        return w[:-1]
    for suffix, new in (("sses", "ss"), ("ies", "i"), ("ss", "ss"), ("s", "")):
        if w.endswith(suffix):
            return w[: len(w) - len(suffix)] + new
    return w


def _past(w: str) -> str:
    if w.endswith("ied"):
        return w[:-3] + ("ie" if len(w) == 4 else "i")
    if w.endswith("eed"):
        return w[:-1] if _measure(w[:-3]) > 0 else w
    for suffix in ("ed", "ing"):
        if w.endswith(suffix):
            stem = w[: len(w) - len(suffix)]
            if not _has_vowel(stem):
                return w
            if stem.endswith(("at", "bl", "iz")):
                return stem + "e"
            if _double_consonant(stem):
                return stem if stem[-1] in "lsz" else stem[:-1]
            if _measure(stem) == 1 and _short_end(stem):
                return stem + "e"
            return stem
    return w


def _final_y(w: str) -> str:
    stem = w[:-1]
    if w.endswith("y") and len(stem) > 1 and _shape(stem)[-1] == "c":
        return stem + "i"
    return w


def _derivational(w: str) -> str:
    if w.endswith("alli") and _measure(w[:-4]) > 0:
        return _derivational(w[:-4] + "al")
    for suffix, new in STEP_2:
        if w.endswith(suffix):
            stem = w[: len(w) - len(suffix)]
            return stem + new if _measure(stem) > 0 else w
    if w.endswith("logi") and _measure(w[:-3]) > 0:
        return w[:-1]
    return w


def _endings(w: str) -> str:
    for suffix, new in STEP_3:
        if w.endswith(suffix):
            stem = w[: len(w) - len(suffix)]
            return stem + new if _measure(stem) > 0 else w
    return w


def _residual(w: str) -> str:
    for suffix in STEP_4:
        if w.endswith(suffix):
            stem = w[: len(w) - len(suffix)]
            if _measure(stem) > 1 and (suffix != "ion" or stem.endswith(("s", "t"))):
                return stem
            return w
    return w


def _final_e(w: str) -> str:
    if w.endswith("e"):
        stem = w[:-1]
        m = _measure(stem)
        if m > 1 or (m == 1 and not _short_end(stem)):
            return stem
    return w


def _double_l(w: str) -> str:
    return w[:-1] if w.endswith("ll") and _measure(w[:-1]) > 1 else w


@lru_cache(maxsize=1 << 18)
def stem(word: str) -> str:
    """Stem of a lower-case word; the cache makes frequent words free."""
    if word in IRREGULAR:
        return IRREGULAR[word]
    if len(word) <= 2:
        return word
    for step in (_plural, _past, _final_y, _derivational, _endings, _residual, _final_e, _double_l):
        word = step(word)
    return word
