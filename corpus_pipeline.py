"""The corpus pipeline: stages that each take and return a table of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from newscorpus.llm import decontaminate, langid, queries, secrets, simhash
from newscorpus.llm.common import saved, small_batches, table
from newscorpus.sources.scratch import new_path

#: A text nearer to no language than this cosine is rejected.
LEAST_COSINE = 0.05


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go whose language stays undetermined or unlike all learned ones."""
    small_batches(spark)
    return langid.keep_identified(docs, queries.language_profiles(docs), at_least=LEAST_COSINE)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays: that of the smallest id."""
    small_batches(spark)
    return simhash.keep_one(docs, shingle=3, radius=3)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go that hold ten consecutive words of a benchmark item."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret in a text becomes a mark; ``n_chars`` follows the text."""
    small_batches(spark)
    ledger = new_path(spark, "ledger")
    secrets.commit(docs, ledger)
    return secrets.redacted(docs, ledger).selectExpr(
        *[
            "cast(char_length(text) as bigint) as n_chars" if c == "n_chars" else f"`{c}`"
            for c in docs.columns
        ]
    )


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text in digest form."""
    small_batches(spark)
    return queries.encoded(docs)


STAGES = [
    ("language", identify_language),
    ("simhash", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("secrets", redact_secrets),
    ("sentencepiece", encode),
]

#: The language model, the groups and the ids have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each stage's rows are saved for the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
