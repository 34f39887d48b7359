"""Good and rejected records in one table, written in one pass.

A checked frame has a ``reason`` (NULL for a good record) and the ``raw`` text
of a rejected one beside its columns.  Both kinds go through the same write, into
two partitions: nothing is parsed twice, nothing vanishes, and a reader of the
good records does not touch the others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newscorpus.operators import curate


def checked_articles(raw: DataFrame, json: str = "json", query: str = "query") -> DataFrame:
    """API responses as checked articles; a rejected response is one row."""
    parsed = curate.parse_responses(raw, json, query)
    parsed = parsed.withColumn("raw", F.when(F.col("reason").isNotNull(), F.col("json")))
    articles = F.when(F.col("reason").isNull(), F.col("response.articles"))
    found = parsed.select("category", "reason", "raw", F.posexplode_outer(articles).alias("position", "a"))
    return curate.article_columns(found, "reason", "raw", "position")


def write_checked(df: DataFrame, path: str) -> None:
    """Append a checked frame; ``rejected`` is its partition."""
    df.withColumn("rejected", F.col("reason").isNotNull().cast("int")).write.mode("append").partitionBy("rejected").parquet(path)


def read_good(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).where("rejected = 0").drop("rejected", "reason", "raw")


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """(reason, raw) of the rejected records."""
    return spark.read.parquet(path).where("rejected = 1").select("reason", "raw")


def reject_report(spark: SparkSession, path: str) -> DataFrame:
    """(reason, n): how many records were good (reason '') or rejected, by reason."""
    table = spark.read.parquet(path)
    return table.groupBy(F.coalesce("reason", F.lit("")).alias("reason")).agg(F.count("*").alias("n"))
