"""Corpus statistics.  Tokens are made once per row; counts combine map-side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newscorpus.functions import text as tx
from newscorpus.lexicons import all_stopwords

THRESHOLDS = (4000, 2000, 1000, 700, 500)


def text_lengths(df: DataFrame, col: str) -> DataFrame:
    return df.withColumns(
        {"char_len": tx.char_count(F.col(col)), "word_len": tx.word_count(F.col(col))}
    )


def _per_field(df: DataFrame, cols: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Long form (by…, field, n_words): one row per text column."""
    fields = F.array(
        *[
            F.struct(F.lit(c).alias("field"), tx.word_count(F.col(c)).alias("n_words"))
            for c in cols
        ]
    )
    return df.select(*by, F.inline(fields))


def length_report(
    df: DataFrame,
    cols: Sequence[str],
    by: Sequence[str] = (),
    thresholds: Sequence[int] = THRESHOLDS,
) -> DataFrame:
    """Longest text and number of texts above each word count, per column."""
    return (
        _per_field(df, cols, by)
        .groupBy(*by, "field")
        .agg(
            F.max("n_words").alias("max_words"),
            *[F.count_if(F.col("n_words") > t).alias(f"over_{t}") for t in thresholds],
        )
    )


def avg_length(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    return (
        _per_field(df, cols, by)
        .groupBy(*by, "field")
        .agg(F.avg("n_words").alias("avg_words"))
    )


def length_histogram(df: DataFrame, col: str, bins: int = 40) -> DataFrame:
    """Equal-width bins over a text's word counts; the last bin is closed.

    Bin edges stay in integers: bin = (w - min) * bins div (max - min).
    """
    lens = df.select(tx.word_count(F.col(col)).alias("w")).where(F.col("w").isNotNull())
    edges = lens.agg(F.struct(F.min("w").alias("lo"), F.max("w").alias("hi")).alias("e")).scalar()
    width = F.nullif(F.col("e.hi") - F.col("e.lo"), F.lit(0))
    raw = F.floor((F.col("w") - F.col("e.lo")) * bins / width)
    return (
        # lengths repeat a lot, so counting them first leaves few rows to place
        lens.groupBy("w")
        .agg(F.count("*").alias("n"))
        .withColumn("e", edges)
        .withColumn("bin", F.least(F.coalesce(raw, F.lit(0)), F.lit(bins - 1)).cast("bigint"))
        .groupBy("bin")
        .agg(
            F.min("w").alias("min_words"),
            F.max("w").alias("max_words"),
            F.sum("n").alias("n"),
        )
    )


def _top(tokens: DataFrame, name: str, n: int) -> DataFrame:
    return (
        tokens.groupBy(name).agg(F.count("*").alias("n")).orderBy(F.desc("n"), name).limit(n)
    )


def content_terms(text: Column, stopwords: Sequence[str] | None = None) -> Column:
    return tx.without(tx.terms(text), stopwords or all_stopwords())


def top_words(
    df: DataFrame, col: str, n: int = 30, stopwords: Sequence[str] | None = None
) -> DataFrame:
    """The n most frequent terms that are not stopwords."""
    return _top(df.select(F.explode(content_terms(F.col(col), stopwords)).alias("word")), "word", n)


def top_bigrams(
    df: DataFrame, col: str, n: int = 20, stopwords: Sequence[str] | None = None
) -> DataFrame:
    """The n most frequent neighbours in the stopword-free terms of a document."""
    grams = tx.ngrams(content_terms(F.col(col), stopwords), 2)
    return _top(df.select(F.explode(grams).alias("bigram")), "bigram", n)


def term_weights(
    df: DataFrame, col: str, n: int = 200, stopwords: Sequence[str] | None = None
) -> DataFrame:
    """Counts of the n top terms relative to the most frequent one."""
    top = top_words(df, col, n, stopwords)
    # the window runs over the n rows that are left
    return top.withColumn("weight", F.col("n") / F.max("n").over(Window.partitionBy()))


def category_counts(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count("*").alias("n"))


def event_type_counts(df: DataFrame, col: str, triggers: Sequence[tuple[str, str]]) -> DataFrame:
    """Documents per type of their first event trigger, "unknown" without one.

    ``triggers`` are (word, event type), for the language and field of the corpus.

    For a report on a sample, cut ``df`` with ``head_sample`` first.
    """
    kind = F.coalesce(tx.first_trigger_type(F.col(col), triggers), F.lit("unknown"))
    return category_counts(df.select(kind.alias("event_type")), "event_type")


def extract_entities(df: DataFrame, col: str, gazetteer: DataFrame | None = None) -> DataFrame:
    """Capitalised spans and how often each occurs, typed by a gazetteer if given.

    Spans are counted before the gazetteer join, so frequent names cause no skew.
    """
    found = (
        df.select(F.explode(tx.entities(F.col(col))).alias("entity"))
        .groupBy("entity")
        .agg(F.count("*").alias("n"))
    )
    return found if gazetteer is None else found.join(gazetteer, "entity", "left")
