"""Curation of articles as they land, with Structured Streaming.

The sink is idempotent, whatever is replayed and with whatever checkpoint:

* A batch is named by (stream id, batch id).  The stream id is the one that
  Spark keeps in the checkpoint, so a new checkpoint is a new stream.
* ``<ledger>/keys`` holds the keys (day, URL) that each batch admitted, nothing
  else, below the batch's own directory and by day.
* ``<target>`` holds each batch's curated rows below the batch's own directory.
* ``<ledger>/commits`` gets one row for a batch after both are written.

A batch admits the first copy of every key that no other committed batch of any
stream has.  A batch that failed half-way has no commit: its rows are not read
and its keys do not count, so a replay under its name overwrites it, and a new
stream admits the same rows again under its own name.  A new checkpoint that
sees old files again finds their keys committed and adds nothing.

One stream at a time may write to a target.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newscorpus.operators import curate
from newscorpus.operators.extract import extract_body
from newscorpus.operators.rules import SITE_RULES, Rule
from newscorpus.plans.daily import REQUIRED

KEYS = ["published_date", "url"]
BATCH = ["stream_id", "batch_id"]
_KEYS_SCHEMA = "url string, stream_id string, batch_id bigint, published_date date"
_COMMITS_SCHEMA = "n_admitted bigint, stream_id string, batch_id bigint"


def _of(path: str, stream_id: str, batch_id: int) -> str:
    return f"{path}/stream_id={stream_id}/batch_id={batch_id}"


def commits(spark: SparkSession, ledger: str) -> DataFrame:
    """(n_admitted, stream_id, batch_id) of every batch that was written whole."""
    return spark.read.schema(_COMMITS_SCHEMA).parquet(f"{ledger}/commits")


def admitted_keys(spark: SparkSession, ledger: str) -> DataFrame:
    """The keys that committed batches admitted, with the batch's name."""
    keys = spark.read.schema(_KEYS_SCHEMA).parquet(f"{ledger}/keys")
    return keys.join(commits(spark, ledger).select(*BATCH), BATCH, "left_semi")


def _create(spark: SparkSession, path: str, schema: str, by: list[str]) -> None:
    """A directory that reads as an empty table until rows come."""
    spark.createDataFrame([], schema).write.mode("append").partitionBy(*by).parquet(path)


def _admit(batch: DataFrame, stream_id: str, batch_id: int, ledger: str, order: Sequence[str]) -> DataFrame:
    """First copies of this batch whose keys no other committed batch has."""
    firsts = curate.dedupe_keep_first(curate.drop_missing(batch, ["url"]), KEYS, list(order))
    # the days of this batch bound how much of the ledger is read
    first_day, last_day = batch.agg(F.min("published_date"), F.max("published_date")).first()
    own = (F.col("stream_id") == stream_id) & (F.col("batch_id") >= batch_id)
    seen = (
        admitted_keys(batch.sparkSession, ledger)
        .where(F.col("published_date").between(F.lit(first_day), F.lit(last_day)))
        .where(~own)
        .select(*KEYS)
    )
    return firsts.join(seen, KEYS, "left_anti")


def write_batch(
    batch: DataFrame,
    stream_id: str,
    batch_id: int,
    target: str,
    ledger: str,
    rules: Sequence[Rule] = SITE_RULES,
    lang: str = "en",
    order: Sequence[str] = ("article_id",),
    join_pages: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Curate one batch into ``target``; any number of calls equals one."""
    spark = batch.sparkSession
    # a replay must not show the old rows while it replaces them
    done = _of(f"{ledger}/commits", stream_id, batch_id)
    nothing = spark.createDataFrame([], "n_admitted bigint")
    nothing.write.mode("overwrite").parquet(done)
    keys = _of(f"{ledger}/keys", stream_id, batch_id)
    admitted = _admit(batch, stream_id, batch_id, ledger, order)
    admitted.select(*KEYS).hint("rebalance", F.col("published_date")).write.partitionBy("published_date").mode(
        "overwrite"
    ).parquet(keys)
    kept = curate.filter_language(admitted, "content", lang)
    if join_pages is not None:
        kept = join_pages(kept)
    clean = curate.drop_missing(extract_body(kept, rules).drop("html"), REQUIRED)
    clean.hint("rebalance", F.col("published_date")).write.partitionBy("published_date").mode("overwrite").parquet(
        _of(target, stream_id, batch_id)
    )
    written = spark.read.schema("url string, published_date date").parquet(keys)
    written.agg(F.count("*").alias("n_admitted")).write.mode("overwrite").parquet(done)


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark wrote into the checkpoint when the stream first began."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def incremental_curation(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    target: str,
    ledger: str,
    checkpoint: str,
    rules: Sequence[Rule] = SITE_RULES,
    lang: str = "en",
    order: Sequence[str] = ("article_id",),
    join_pages: Callable[[DataFrame], DataFrame] | None = None,
    replay_window: str | None = None,
    max_files: int | None = None,
) -> None:
    """Process everything that has landed in ``source`` since the last call.

    ``replay_window`` (such as "2 days") also removes rows that were delivered
    twice with the same id and URL, in streaming state that the watermark bounds.
    A row older than the window is then dropped as late, so leave it unset where
    old articles may still arrive; the ledger removes the copies either way.
    """
    _create(spark, f"{ledger}/keys", _KEYS_SCHEMA, [*BATCH, "published_date"])
    _create(spark, f"{ledger}/commits", _COMMITS_SCHEMA, BATCH)
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    stream = reader.parquet(source)
    if replay_window is not None:
        stream = (
            stream.withColumn("_event_time", F.to_timestamp("published_at"))
            .withWatermark("_event_time", replay_window)
            .dropDuplicatesWithinWatermark([*order, "url"])
            .drop("_event_time")
        )

    def write(batch: DataFrame, batch_id: int) -> None:
        stream_id = _stream_id(batch.sparkSession, checkpoint)
        write_batch(batch, stream_id, batch_id, target, ledger, rules, lang, order, join_pages)

    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_curated(spark: SparkSession, target: str, ledger: str) -> DataFrame:
    """The curated rows of all committed batches; filters on the day prune directories."""
    done = commits(spark, ledger).where("n_admitted IS NOT NULL").select(*BATCH)
    return spark.read.parquet(target).join(done, BATCH, "left_semi").drop(*BATCH)
