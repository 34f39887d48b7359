"""Text expressions.

Every function maps a Column to a Column and touches one row only, so a plan
built from them stays narrow: no shuffle and no Python worker, whatever the
corpus size.  Shuffles appear only where a statistic spans documents.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

WHITESPACE = r"\s+"
NON_ASCII_TERM = r"[^a-z0-9]+"
NON_TERM = r"[^\p{L}\p{N}]+"
LANGUAGE_SPLIT = r"[\s.,]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body``.

    A column used inside a lambda would otherwise be re-evaluated for every
    array element once Catalyst collapses the projections.
    """
    return F.transform(F.array(value), body)[0]


def split_nonempty(text: Column, pattern: str) -> Column:
    return F.array_remove(F.split(text, pattern), "")


def words(text: Column) -> Column:
    """Whitespace-separated pieces; NULL stays NULL, '' gives an empty array."""
    return split_nonempty(text, WHITESPACE)


def word_count(text: Column) -> Column:
    return F.array_size(words(text)).cast("bigint")


def char_count(text: Column) -> Column:
    return F.length(text).cast("bigint")


def terms(text: Column, unicode_words: bool = True) -> Column:
    """Lower-cased alphanumeric pieces (Unicode letters, or ASCII only)."""
    return split_nonempty(F.lower(text), NON_TERM if unicode_words else NON_ASCII_TERM)


def without(tokens: Column, stopwords: Sequence[str]) -> Column:
    """Tokens that are not in a fixed literal list (a hash-set test)."""
    return F.filter(tokens, lambda w: ~w.isin(list(stopwords)))


def ngrams(tokens: Column, n: int) -> Column:
    """Adjacent token runs of length n joined by one space."""
    if n == 1:
        return tokens

    def build(t: Column) -> Column:
        last = F.array_size(t) - (n - 1)
        grams = F.slice(t, F.lit(1), last)
        for k in range(1, n):
            grams = F.zip_with(
                grams, F.slice(t, F.lit(k + 1), last), lambda a, b: F.concat(a, F.lit(" "), b)
            )
        return F.when(last >= 1, grams).otherwise(F.array().cast("array<string>"))

    return let(tokens, build)


def chunks(text: Column, size: int | Column) -> Column:
    """Consecutive runs of at most ``size`` words, each joined by one space."""
    k = F.lit(size) if isinstance(size, int) else size

    def build(w: Column) -> Column:
        n = F.array_size(w)
        last = ((n - 1) / k).cast("int")
        return F.when(
            n > 0,
            F.transform(
                F.sequence(F.lit(0), last),
                lambda i: F.array_join(F.slice(w, i * k + 1, k), " "),
            ),
        ).otherwise(F.array().cast("array<string>"))

    return let(words(text), build)


def lead(text: Column, n_words: int | Column) -> Column:
    """The first ``n_words`` words, joined by one space."""
    n = F.lit(n_words) if isinstance(n_words, int) else n_words
    return F.array_join(F.slice(words(text), F.lit(1), n), " ")


def sentences(text: Column) -> Column:
    """Trimmed non-empty pieces between ``.``, ``!``, ``?`` and line ends."""
    return F.array_remove(
        F.transform(F.split(text, r"[.!?\n]+"), lambda s: F.trim(s)), ""
    )


def evidence(tokens: Column, lexicon: Sequence[str]) -> Column:
    """How many tokens are on a fixed word list."""
    return F.array_size(F.filter(tokens, lambda w: w.isin(list(lexicon))))


def detect_language(text: Column, lexicons: dict[str, list[str]]) -> Column:
    """Language with most evidence words; ties go to the earlier lexicon and no
    evidence gives NULL."""
    langs = F.array(*[F.lit(lang) for lang in lexicons])
    every_word = sorted({w for ws in lexicons.values() for w in ws})

    def decide(tokens: Column) -> Column:
        scores = F.array(*[evidence(tokens, ws) for ws in lexicons.values()])
        return let(
            scores,
            lambda s: F.when(
                F.array_max(s) > 0,
                F.element_at(langs, F.array_position(s, F.array_max(s)).cast("int")),
            ),
        )

    # one pass leaves the evidence words, which the languages then count
    tokens = F.split(F.lower(text), LANGUAGE_SPLIT)
    return let(F.filter(tokens, lambda w: w.isin(every_word)), decide)


def first_trigger_type(text: Column, triggers: Sequence[tuple[str, str]]) -> Column:
    """Type of the earliest trigger word of the text, NULL when there is none."""
    kinds = F.create_map(*[F.lit(x) for pair in triggers for x in pair])
    hits = F.filter(terms(text), lambda w: w.isin([w_ for w_, _ in triggers]))
    return F.try_element_at(kinds, F.get(hits, F.lit(0)))


def entities(text: Column) -> Column:
    """Runs of capitalised words that do not open a sentence.

    A word counts from two letters up, in any script with capitals, whatever the
    case of the later ones.  A comma, colon or semicolon ends a run, as does any
    other word.
    """
    cap, cap_end = r"^\p{Lu}[\p{L}\p{M}]+$", r"^\p{Lu}[\p{L}\p{M}]+[,;:]$"

    def mark(w: Column) -> Column:
        return (
            F.when(w.rlike(cap), w)
            .when(w.rlike(cap_end), F.concat(F.regexp_replace(w, "[,;:]$", ""), F.lit(" |")))
            .otherwise(F.lit("|"))
        )

    def spans(sentence: Column) -> Column:
        marked = let(
            words(sentence),
            lambda w: F.transform(F.slice(w, F.lit(2), F.greatest(F.array_size(w), F.lit(1))), mark),
        )
        return F.transform(F.split(F.array_join(marked, " "), r"\|"), lambda s: F.trim(s))

    return F.array_remove(F.flatten(F.transform(sentences(text), spans)), "")


def normalize_missing(c: Column, missing: Sequence[str]) -> Column:
    """NULL for the spellings of "missing", the value otherwise."""
    return F.when(~c.isin(list(missing)), c)
