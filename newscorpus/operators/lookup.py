"""Lookups in term tables: frequent terms inside the row, the others by a join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: How many of the most frequent keys are joined by broadcast.
HEAVY_KEYS = 10_000
#: Most terms that a row looks up in place ...
MAP_WORDS = 1 << 16
#: ... and the longest of them, in bytes: together they bound what tasks receive.
MAP_WORD_BYTES = 64


def join_by_frequency(
    rows: DataFrame, table: DataFrame, key: str, frequency: str, heavy: int = HEAVY_KEYS
) -> DataFrame:
    """Inner join of ``rows`` to a one-row-per-key ``table`` under heavy skew.

    The ``heavy`` most frequent keys are broadcast (their number is the bound on
    the broadcast); every other key takes a shuffled hash join, where no key is
    frequent any more and a task holds its share of ``table``.  Both parts together
    are the exact inner join.
    """
    cols = [c for c in table.columns if c != key]
    top = table.orderBy(F.desc(frequency), key).limit(heavy)
    marked = rows.join(
        F.broadcast(top.select(key, F.struct(*cols).alias("_heavy"))), key, "left"
    )
    hot = marked.where(F.col("_heavy").isNotNull()).select(*rows.columns, "_heavy.*")
    rest = (
        marked.where(F.col("_heavy").isNull()).drop("_heavy").join(table.hint("shuffle_hash"), key).select(*hot.columns)
    )
    return hot.unionByName(rest)


def join_tokens(
    df: DataFrame,
    source: Column,
    tokens: Column,
    table: DataFrame,
    key: str,
    value: str,
    name: str,
    spent: Sequence[str] = (),
) -> DataFrame:
    """Add ``name``: (pos, value) of every token that is not NULL, value NULL if absent.

    ``tokens``, an array, must follow from the text ``source`` alone: equal texts
    are looked up once, by their digest.  A row's tokens come back to it as one
    array, so a task holds one text's tokens at a time.  Columns that only ``tokens``
    needs, such as a table held in the row, are ``spent``: each row would carry a
    copy of them through the join.
    """
    digest = F.unhex(F.sha2(source, 256))
    asked = (
        df.select(digest.alias("_digest"), tokens.alias("_tokens"))
        .where(F.exists("_tokens", lambda w: w.isNotNull()))
        .groupBy("_digest")
        .agg(F.first("_tokens").alias("_tokens"))
        .select("_digest", F.posexplode("_tokens").alias("pos", "_token"))
        .where(F.col("_token").isNotNull())
    )
    answers = table.select(F.col(key).alias("_token"), F.col(value).alias("value"))
    found = (
        asked.join(answers, "_token", "left")
        .groupBy("_digest")
        .agg(F.collect_list(F.struct("pos", "value")).alias(name))
    )
    return df.withColumn("_digest", digest).drop(*spent).join(found, "_digest", "left").drop("_digest")


def in_order(settled: Column, joined: Column) -> Column:
    """The values of all tokens: ``settled`` ones (NULL elsewhere) and those of :func:`join_tokens`."""
    here = F.filter(
        F.transform(settled, lambda v, i: F.struct(i.alias("pos"), v.alias("value"))),
        lambda x: x["value"].isNotNull(),
    )
    both = F.array_sort(F.when(joined.isNull(), here).otherwise(F.concat(here, joined)))
    return F.transform(both, lambda x: x["value"])


def held(words: int, first_id: int) -> Column:
    """Whether a row of a vocabulary is among those looked up in place."""
    return (F.col("id") < first_id + words) & (F.octet_length("word") <= MAP_WORD_BYTES)


def word_ids(vocab: DataFrame, buckets: int = 4096, value: str = "id") -> Column:
    """A bounded vocabulary as one array of small maps from word to ``value``.

    The result is a scalar subquery: it reaches the tasks as one constant, and a
    word is looked up by hash bucket.  The caller bounds the vocabulary.
    """
    kind = vocab.schema[value].dataType.simpleString()
    filled = (
        vocab.groupBy(_bucket(F.col("word"), buckets).alias("b"))
        .agg(F.map_from_entries(F.collect_list(F.struct("word", value))).alias("m"))
    )
    slots = vocab.sparkSession.range(buckets).select(F.col("id").cast("int").alias("b"))
    by_bucket = F.array_sort(
        F.collect_list(F.struct("b", "m")), lambda x, y: x["b"] - y["b"]
    )
    return (
        slots.join(filled, "b", "left")
        .select("b", F.coalesce("m", F.create_map().cast(f"map<string,{kind}>")).alias("m"))
        .agg(F.transform(by_bucket, lambda s: s["m"]).alias("ids"))
        .scalar()
    )


def _bucket(word: Column, buckets: int) -> Column:
    return F.pmod(F.hash(word), F.lit(buckets))


def word_id(ids: Column, word: Column, buckets: int = 4096) -> Column:
    """The value of a word in a table made by :func:`word_ids`, NULL if absent."""
    return F.try_element_at(F.get(ids, _bucket(word, buckets)), word)


def id_words(vocab: DataFrame, first_id: int, words: int = MAP_WORDS) -> Column:
    """The first ``words`` of a vocabulary as an array; position = id - first_id.

    Words that are too long to be held are NULL there.
    """
    word = F.when(held(words, first_id), F.col("word")).alias("word")
    return vocab.where(F.col("id") < first_id + words).select("id", word).agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("id", "word"))), lambda s: s["word"]
        ).alias("words")
    ).scalar()
