"""Reading and writing article tables, raw responses, CSV corpora and results."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, DataFrameReader, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newscorpus.schemas import ARTICLE, CORRUPT


def with_published_date(df: DataFrame) -> DataFrame:
    """Add the partition column from the timestamp text."""
    return df.withColumn("published_date", F.to_date(F.substring("published_at", 1, 10)))


#: Upper bound on the rows of one file.
MAX_ROWS_PER_FILE = 5_000_000


def by_day(df: DataFrame, rebalance: bool = True) -> DataFrameWriter:
    """Writer with one directory per day.

    Rebalancing groups rows by day and lets AQE split a day that is larger than
    the target partition size and merge small ones, so a day that holds a third
    of the table is written by many tasks and a quiet one gives a single file.
    """
    if rebalance:
        df = df.hint("rebalance", F.col("published_date"))
    return df.write.partitionBy("published_date").option("maxRecordsPerFile", MAX_ROWS_PER_FILE)


def append_articles(df: DataFrame, path: str, rebalance: bool = True) -> None:
    """Append to the article table, one directory per day.

    Without ``rebalance`` nothing is shuffled and each task writes its own file
    for every day it holds.
    """
    if "published_date" not in df.columns:
        df = with_published_date(df)
    by_day(df, rebalance).mode("append").parquet(path)


def overwrite_days(df: DataFrame, path: str) -> None:
    """Replace exactly the days present in ``df``; a rerun gives the same table."""
    by_day(df).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def replace_day(df: DataFrame, path: str, day: str) -> None:
    """Make ``df`` the rows of ``day`` (YYYY-MM-DD) in the table at ``path``.

    Exactly that day's directory is replaced, also by nothing: an empty ``df``
    leaves an empty file there, which keeps the table readable.
    """
    rows = df.where(F.col("published_date") == F.lit(day).cast("date")).drop("published_date")
    rows.hint("rebalance").write.mode("overwrite").option("maxRecordsPerFile", MAX_ROWS_PER_FILE).parquet(
        f"{path}/published_date={day}"
    )


def read_articles(spark: SparkSession, path: str) -> DataFrame:
    """The article table; filters on ``published_date`` prune directories."""
    return spark.read.parquet(path)


def read_articles_jdbc(
    spark: SparkSession,
    url: str,
    table: str = "news_articles",
    partition: Mapping[str, str] | None = None,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """The article table in a database; filters and columns are pushed into it.

    ``partition`` holds partitionColumn, lowerBound, upperBound, numPartitions;
    without it one task reads the whole table.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    return reader.options(**(partition or {})).options(**(properties or {})).load()


def append_articles_jdbc(
    df: DataFrame, url: str, table: str = "news_articles", properties: Mapping[str, str] | None = None
) -> None:
    (
        df.select(*ARTICLE.fieldNames())
        .write.format("jdbc")
        .option("url", url)
        .option("dbtable", table)
        .options(**(properties or {}))
        .mode("append")
        .save()
    )


def export_csv(df: DataFrame, path: str) -> None:
    """UTF-8 CSV with header; everything quoted, NULL as an unquoted empty cell."""
    (
        df.write.option("header", True)
        .option("quoteAll", True)
        .option("escape", '"')
        .option("encoding", "UTF-8")
        # the writer would otherwise trim every cell
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def read_csv_corpus(
    spark: SparkSession, path: str, schema: T.StructType, checked: bool = False, header: bool = True
) -> DataFrame:
    """CSV with quotes and line ends inside cells.

    A multi-line CSV file cannot be split, so keep such files small and many;
    the writer above makes one per task.  A cell that is not of its type, or is
    not there, reads as NULL; ``checked`` adds what :mod:`newscorpus.sources.rejects`
    writes: ``reason`` "broken" and the record's ``raw`` text.
    """
    if checked:
        wide = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
        # every cell is judged, whatever columns are selected later
        reader = spark.read.schema(wide).option("columnNameOfCorruptRecord", CORRUPT).option("columnPruning", False)
        rows = _csv(reader, path, header).withColumnRenamed(CORRUPT, "raw")
        return rows.withColumn("reason", F.when(F.col("raw").isNotNull(), "broken"))
    return _csv(spark.read.schema(schema), path, header)


def _csv(reader: DataFrameReader, path: str, header: bool) -> DataFrame:
    return (
        reader
        .option("header", header)
        .option("multiLine", True)
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .csv(path)
    )


def read_phrases(spark: SparkSession, path: str) -> DataFrame:
    """Query queue or ledger: one phrase per line, column ``value``."""
    return spark.read.text(path)


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    """Landed API responses: one JSON line each, with its ``query`` field."""
    return spark.read.schema("query string, json string").json(path)


def write_results_json(df: DataFrame, path: str) -> None:
    """Summarization results as JSON lines."""
    df.write.json(path)


def read_results_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)
