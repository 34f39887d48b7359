"""Helpers that the operators of this package share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newscorpus.ship import ship
from newscorpus.sources.scratch import new_path


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """One input table, read where it is; Python workers get this package."""
    ship(spark)
    return spark.read.parquet(f"{sf}/{name}.parquet")


def named(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only ``id`` and ``text`` (NULL text: empty); other columns cannot clash."""
    return df.select(
        named(id_col).alias("id"), F.coalesce(named(text_col), F.lit("")).alias("text")
    )


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again.

    Cuts lineage, and a lost executor costs no recomputation of what was saved.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Most rows and bytes that a task sends to Python at a time: long texts are held on both sides.
BATCH_ROWS, BATCH_BYTES = 2_000, 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Bounds the session's Arrow batches; lower bounds, given as plain numbers, stay."""
    for key, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        key = f"spark.sql.execution.arrow.{key}"
        held = str(spark.conf.get(key)).removesuffix("b")
        if not held.isdigit() or not 0 < int(held) <= most:
            spark.conf.set(key, str(most))


def bucketed(df: DataFrame, column: str, name: str) -> DataFrame:
    """``df`` saved in buckets by ``column``: joins on it leave its rows where they are.

    Meant for few large rows, as a task writes a file for each bucket it has rows
    of.  The table's name goes at once, its files stay.
    """
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"{name}_{uuid.uuid4().hex}"
    df.write.format("parquet").bucketBy(buckets, column).option("path", new_path(spark, name)).saveAsTable(name)
    table = spark.table(name)
    table.schema  # resolved before the name goes
    spark.sql(f"DROP TABLE {name}")
    return table


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only; texts of ASCII alone take the fast built-in."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, upper, upper.lower())
    )


def text_runs(column, characters: int) -> Iterator[tuple[int, list[str]]]:
    """(index of the first, texts) of an Arrow column: runs of about so many characters."""
    low, run, size = 0, [], 0
    for k in range(len(column)):
        run.append(column[k].as_py())
        size += len(run[-1])
        if size >= characters:
            yield low, run
            low, run, size = k + 1, [], 0
    if run:
        yield low, run


def held_out(id_col: str, folds: int, fold: int) -> Column:
    """True where crc32 of the id as text leaves ``fold``; a NULL id counts as ''."""
    return F.crc32(F.coalesce(named(id_col).cast("string"), F.lit("")).cast("binary")) % folds == fold
