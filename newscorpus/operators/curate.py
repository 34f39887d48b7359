"""Ingest planning and row-level curation of an article table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newscorpus.functions import text as tx
from newscorpus.lexicons import MISSING, STOPWORDS
from newscorpus.schemas import API_RESPONSE, CORRUPT


def pending_queries(queue: DataFrame, done: DataFrame, col: str = "value") -> DataFrame:
    """Distinct trimmed phrases of the queue that the ledger does not hold.

    Both sides are reduced to distinct phrases first, so a phrase repeated many
    times costs one row per task in the shuffle.
    """

    def phrases(df: DataFrame) -> DataFrame:
        return df.select(F.trim(F.col(col)).alias(col)).where(F.col(col) != "").distinct()

    return phrases(queue).join(phrases(done), col, "left_anti")


def page_plan(
    totals: DataFrame, page_size: int = 100, max_pages: int = 5, ceil: bool = False
) -> DataFrame:
    """One row per result page to fetch: pages 1..min(total/page_size, max_pages)."""
    full = F.col("total") / page_size
    pages = F.least(F.ceil(full) if ceil else F.floor(full), F.lit(max_pages)).cast("bigint")
    return (
        totals.withColumn("pages", pages)
        .where(F.col("pages") >= 1)
        .withColumn("page", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("pages"))))
        .drop("pages")
    )


def parse_responses(raw: DataFrame, json: str = "json", query: str = "query") -> DataFrame:
    """Every response parsed once: ``category``, ``response`` and the ``reason`` to reject it.

    The reason is NULL for a response to use; otherwise "broken" (not JSON of a
    response, NULL included), "error" (the API says so) or "no articles".
    """
    schema = T.StructType([*API_RESPONSE.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = raw.select(
        F.col(query).alias("category"), F.col(json).alias("json"), F.from_json(json, schema, options).alias("response")
    )
    r = F.col("response")
    reason = (
        F.when(r.isNull() | r[CORRUPT].isNotNull(), "broken")
        .when(r["status"] == "error", "error")
        .when(F.coalesce(F.size(r["articles"]), F.lit(0)) < 1, "no articles")
    )
    return parsed.withColumn("reason", reason)


def rejected_responses(raw: DataFrame, json: str = "json", query: str = "query") -> DataFrame:
    """(category, reason, json) of the responses that give no articles."""
    return parse_responses(raw, json, query).where("reason IS NOT NULL").select("category", "reason", "json")


def article_ids() -> Column:
    """An id that is the same whenever the same response is flattened again."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("url", "category", "position")]
    return F.md5(F.concat_ws("\n", *parts))


def flatten_articles(
    raw: DataFrame, json: str = "json", query: str = "query", with_ids: bool = False
) -> DataFrame:
    """API responses to flat article rows tagged with the query that found them.

    ``with_ids`` adds ``position`` (of the article in its response, from 0) and
    ``article_id``, derived from URL, query and position.
    """
    parsed = parse_responses(raw, json, query).where("reason IS NULL")
    a = parsed.select("category", F.posexplode("response.articles").alias("position", "a"))
    flat = article_columns(a, "position")
    return flat.withColumn("article_id", article_ids()) if with_ids else flat.drop("position")


def article_columns(df: DataFrame, *more: str) -> DataFrame:
    """The flat columns of the nested article ``a``, its category, and ``more``."""
    return df.select(
        F.col("a.source.id").alias("source_id"),
        F.col("a.source.name").alias("source_name"),
        F.col("a.author").alias("author"),
        F.col("a.title").alias("title"),
        F.col("a.description").alias("description"),
        F.col("a.url").alias("url"),
        F.col("a.urlToImage").alias("url_to_image"),
        F.col("a.publishedAt").alias("published_at"),
        F.col("a.content").alias("content"),
        "category",
        *more,
    )


def day_slice(df: DataFrame, day: str, col: str = "published_at") -> DataFrame:
    """Rows whose timestamp text starts with ``day`` (YYYY-MM-DD)."""
    return df.where(F.col(col).isNotNull() & F.col(col).startswith(day))


def drop_missing(
    df: DataFrame, cols: Sequence[str], missing: Sequence[str] = MISSING
) -> DataFrame:
    """Map every spelling of "missing" to NULL in ``cols``, then drop those rows."""
    return df.withColumns(
        {c: tx.normalize_missing(F.col(c), missing) for c in cols}
    ).na.drop(subset=list(cols))


def digest(*cols: str) -> Column:
    """A 256-bit key for long values, so that a dedupe shuffles 64 characters
    instead of whole texts.  NULL when every column is NULL."""
    values = [F.col(c).cast("string") for c in cols]
    if len(values) == 1:
        return F.sha2(values[0], 256)
    # JSON keeps ("a", "bc") and ("ab", "c") apart, and NULL from ""
    return F.when(F.coalesce(*values).isNotNull(), F.sha2(F.to_json(F.array(*values)), 256))


def dedupe_keep_first(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]
) -> DataFrame:
    """The first row per key along ``order``; rows with a NULL key are dropped.

    The ``= 1`` filter on a row number makes Spark keep one row per key in every
    map task before the shuffle, so a key that covers a third of the table sends
    as many rows as there are map tasks and no more.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.na.drop(subset=list(keys))
        .withColumn("_rn", F.row_number().over(w))
        .where(F.col("_rn") == 1)
        .drop("_rn")
    )


def detect_language(
    df: DataFrame, col: str, name: str = "detected", lexicons: dict[str, list[str]] | None = None
) -> DataFrame:
    """Add the language with most evidence words, NULL without evidence."""
    return df.withColumn(name, tx.detect_language(F.col(col), lexicons or STOPWORDS))


def filter_language(
    df: DataFrame,
    col: str = "content",
    lang: str = "en",
    lexicons: dict[str, list[str]] | None = None,
) -> DataFrame:
    """Rows whose text is judged to be in ``lang``; no evidence means dropped."""
    return df.where(tx.detect_language(F.col(col), lexicons or STOPWORDS) == lang)


def language_report(df: DataFrame, col: str, label: str) -> DataFrame:
    """Per true label: rows, rows with evidence, rows judged correctly."""
    return (
        detect_language(df.select(label, col), col)
        .groupBy(label)
        .agg(
            F.count("*").alias("n"),
            F.count("detected").alias("covered"),
            F.count_if(F.col("detected") == F.col(label)).alias("correct"),
        )
    )
