"""The curation chain from article table to clean corpus, as one lazy plan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newscorpus.functions import text as tx
from newscorpus.lexicons import STOPWORDS
from newscorpus.operators import curate, stats
from newscorpus.operators.extract import extract_body
from newscorpus.operators.rules import SITE_RULES, Rule
from newscorpus.sources import articles as io

REQUIRED = ["author", "url", "title", "full_content"]


def curate_articles(
    articles: DataFrame,
    rules: Sequence[Rule] = SITE_RULES,
    lang: str = "en",
    order: Sequence[str] = ("article_id",),
    pages: DataFrame | None = None,
    page_key: str | None = None,
) -> DataFrame:
    """Every day of the table at once: per-day dedupe by URL, language, body text.

    The first copy of a URL within a day survives and is then judged by language.
    ``pages`` (with ``page_key`` and ``html``) is joined after dedupe and language,
    so HTML is moved only for articles that are still wanted.  The join is inner:
    an article without a page has no body and would be dropped at the end, and
    its NULL key would send all such rows to one task.
    """
    kept = curate.drop_missing(articles, ["url"])
    # judged in the row, so that the dedupe shuffles no text that goes afterwards
    wanted = F.coalesce(tx.detect_language(F.col("content"), STOPWORDS) == lang, F.lit(False))
    kept = kept.withColumn("_wanted", wanted).withColumn("content", F.when(F.col("_wanted"), F.col("content")))
    kept = curate.dedupe_keep_first(kept, ["published_date", "url"], list(order))
    kept = kept.where("_wanted").drop("_wanted")
    if pages is not None:
        kept = kept.join(pages, page_key)
    extracted = extract_body(kept, rules).drop("html")
    return curate.drop_missing(extracted, REQUIRED)


def daily_curation(articles: DataFrame, day: str, **options) -> DataFrame:
    """One day: the slice on the partition column prunes every other directory."""
    return curate_articles(articles.where(F.col("published_date") == F.lit(day).cast("date")), **options)


def run_day(spark: SparkSession, source: str, target: str, day: str, **options) -> None:
    """Curate one day of an article table into ``target``; safe to repeat.

    The day's directory is replaced whatever comes out, so a rerun that finds
    nothing leaves nothing of an earlier run; no other day is touched.
    """
    io.replace_day(daily_curation(io.read_articles(spark, source), day, **options), target, day)


def flagship(articles: DataFrame, **options) -> DataFrame:
    """Length report of the curated corpus per source."""
    curated = curate_articles(articles, **options)
    return stats.length_report(curated, ["content", "full_content"], by=["source_name"])
