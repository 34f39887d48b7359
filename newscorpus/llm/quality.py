"""Line-first quality rules; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newscorpus.functions.text import let
from newscorpus.llm.common import named

_SPACES = r"[\x20\x09-\x0D]+"
#: Base rules: fewest words, and the largest percentage of words in repeated windows.
LEAST_WORDS = 50
MOST_REPEATED = 50
#: A document goes if its failed lines hold more than this percentage of its words.
MOST_LOST = 50

# What a line rule looks for.
_ENDINGS = r"[.!?…:;。！？\"”’')\]]\s*$|[.!?…。！？][\"”’')\]]?\s"
_NAVIGATION = (
    r"(?i)^\s*(home|menu|search|log ?in|sign (in|up)|next|previous|back|skip to content|read more"
    r"|click here|share|subscribe|contact( us)?|about( us)?|sitemap)\s*[|>»·:]?\s*$"
    r"|(\s[|>»·]\s[^|>»·]*){3}"
)
_BOILERPLATE = (
    r"(?i)\b(all rights reserved|terms of (use|service)|privacy policy|cookie policy|use cookies"
    r"|enable javascript|lorem ipsum|powered by|licensed under|copyright \(c\))"
    r"|©"
)
_SYMBOLS = r"[#*$%&|<>{}\\^~=_]"
#: Most symbols and most capitals of a line, as percentages of its characters and letters.
MOST_SYMBOLS = 10
MOST_CAPITALS = 60
#: Lines of fewer words need no sentence end.
SHORT_LINE = 8


def word_list(text: Column) -> Column:
    return F.array_remove(F.split(text, _SPACES), "")


def without(text: Column, characters: str) -> Column:
    for c in characters:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def repeated_words(words: Column) -> Column:
    """How many of ``words`` stand in a 3-word window that is found twice or more.

    Each step is bound by ``let``: a filter on the result, which Spark pushes
    down as an expression, must not work a step out anew for every word.
    """

    def windows(words: Column, room: Column) -> Column:
        # a window's hash with its position in the low bits: sorting brings equal windows together
        keyed = F.transform(
            words,
            lambda _, i: F.xxhash64(F.slice(words, i + 1, 3)).bitwiseAND(-room).bitwiseOR(i.cast("bigint")),
        )
        return F.sort_array(F.slice(keyed, 1, F.greatest(F.size(words) - 2, F.lit(0))))

    def twice(ordered: Column, room: Column) -> Column:
        same = lambda x, to: F.coalesce(
            x.bitwiseAND(-room) == F.get(ordered, to).bitwiseAND(-room), F.lit(False)
        )
        found = F.filter(ordered, lambda x, i: same(x, i - 1) | same(x, i + 1))
        return F.sort_array(F.transform(found, lambda x: x.bitwiseAND(room - 1)))

    def covered(at: Column) -> Column:
        # each window adds the words that the next one does not hold
        three = F.lit(3).cast("bigint")
        adds = F.transform(at, lambda x, i: F.least(three, F.coalesce(F.get(at, i + 1) - x, three)))
        return F.aggregate(adds, F.lit(0).cast("bigint"), lambda a, x: a + x)

    def counted(words: Column) -> Column:
        bits = F.ceil(F.log2(F.size(words) + F.lit(1))).cast("int")
        return let(
            F.call_function("shiftleft", F.lit(1).cast("bigint"), bits),
            lambda room: let(
                windows(words, room), lambda ordered: let(twice(ordered, room), covered)
            ),
        )

    return let(words, counted)


def line_failure(line: Column) -> Column:
    """Name of the first rule that a line with words fails, NULL if none.

    navigation: menu words, or three and more parts between bars or arrows;
    boilerplate: licences, notices, fillers; symbols: too many marks that prose
    has not; shouting: mostly capitals; punctuation: a long line that neither
    ends as a sentence does nor holds a sentence's end.
    """
    n_words = F.size(word_list(line))
    letters = F.length(F.regexp_replace(line, r"\P{L}+", ""))
    capitals = F.length(F.regexp_replace(line, r"\P{Lu}+", ""))
    symbols = F.length(line) - F.length(F.regexp_replace(line, _SYMBOLS, ""))
    return (
        F.when(line.rlike(_NAVIGATION), "navigation")
        .when(line.rlike(_BOILERPLATE), "boilerplate")
        .when(symbols * 100 > F.length(line) * MOST_SYMBOLS, "symbols")
        .when((capitals * 100 > letters * MOST_CAPITALS) & (letters >= 20), "shouting")
        .when((n_words >= SHORT_LINE) & ~line.rlike(_ENDINGS), "punctuation")
    )


def line_clean(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each row of ``df``: id, base counts, cleaned text and verdict.

    (id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, cleaned, n_lost_words, failed_lines).  ``cleaned`` is the
    text without the lines that fail a rule, ``failed_lines`` counts them by
    rule.  A document is kept if it passes the base rules and its failed lines
    hold no more than MOST_LOST percent of its words.  NULL, empty and blank
    texts have no words, fail and are not kept; repeated rows each keep their
    row.  Everything is row-local.
    """
    text = F.coalesce(named(text_col), F.lit(""))
    docs = df.select(named(id_col).alias("id"), text.alias("text"))
    docs = docs.withColumn("words", word_list(F.col("text"))).withColumn(
        "lines", F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    )
    docs = docs.withColumn("n", F.size("words")).withColumn("n_repeat_words", repeated_words(F.col("words")))
    judged = F.transform("lines", lambda x: F.struct(x.alias("line"), line_failure(x).alias("rule")))
    docs = docs.withColumn("judged", judged)
    failed = F.filter("judged", lambda x: x["rule"].isNotNull())
    lost = F.size(word_list(F.array_join(F.transform(failed, lambda x: x["line"]), " ")))
    base_failed = (F.col("n") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n"))
    return docs.select(
        "id",
        F.col("n").cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        (F.octet_length("text") - F.octet_length(without(F.col("text"), "#*$%&|<>"))).cast("bigint").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        "n_repeat_words",
        base_failed.alias("base_failed"),
        lost.cast("bigint").alias("n_lost_words"),
        F.transform(failed, lambda x: x["rule"]).alias("failed_lines"),
        F.array_join(F.transform(F.filter("judged", lambda x: x["rule"].isNull()), lambda x: x["line"]), "\n").alias("cleaned"),
    ).withColumn("kept", ~F.col("base_failed") & (100 * F.col("n_lost_words") <= MOST_LOST * F.col("n_words")))
