"""Landed scalar logs and evaluation metrics.

A log file is CSV with a header that says how it is laid out: ``step, tag, value``
(and ``seq``, if there is one) in any order is the long layout, ``step`` with one
column for each tag the wide one.  Layouts may differ between files.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Commas outside quotes.
_COMMA = r',(?=(?:[^"]*"[^"]*")*[^"]*$)'


def scan_scalars(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """Every line of several named runs' files, read by its file's header.

    (run, file, line, reason, step, seq, entries): ``entries`` holds the tags and
    values of a good line, ``reason`` says what is wrong with another one.  Each run
    also has a row without a line, so that one that logged nothing is seen; a path
    that is not there has the reason "missing" in it.
    """
    lines, listed = [], []
    for run, path in paths.items():
        try:
            lines.append(_lines(spark, path).withColumn("run", F.lit(run)))
            listed.append((run, None))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            listed.append((run, "missing"))
    marks = spark.createDataFrame(listed, "run string, reason string")
    if not lines:
        return marks
    return _parsed(reduce(DataFrame.unionByName, lines)).unionByName(marks, allowMissingColumns=True)


def scan_partitioned_scalars(spark: SparkSession, path: str) -> DataFrame:
    """The same for files laid out as ``run=<name>/``: one scan for all runs."""
    return _parsed(_lines(spark, path))


def load_scalars(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """(run, tag, step, seq, value) of the good lines of several named runs."""
    return good_scalars(scan_scalars(spark, paths))


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).withColumn("file", F.col("_metadata.file_path")).where(F.trim("value") != "")


def _cells(line: Column) -> Column:
    cells = F.when(F.contains(line, F.lit('"')), F.split(line, _COMMA)).otherwise(F.split(line, ","))
    inner = lambda c: F.replace(c.substr(F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"'))
    return F.transform(cells, lambda c: F.when(F.trim(c).rlike('^".*"$'), inner(F.trim(c))).otherwise(F.trim(c)))


def _parsed(lines: DataFrame) -> DataFrame:
    cut = lines.withColumn("cells", _cells(F.col("value")))
    lower = F.transform("cells", lambda c: F.lower(c))
    cut = cut.withColumn("is_header", F.array_contains(lower, "step"))
    # one short row a file comes back to its lines
    headers = cut.where("is_header").groupBy("run", "file").agg(
        F.min("cells").alias("names"), (F.min("cells") != F.max("cells")).alias("mixed")
    )
    body = cut.where("NOT is_header").join(headers, ["run", "file"], "left")
    lower = F.transform("names", lambda c: F.lower(c))

    def cell(name: str) -> Column:
        return F.get("cells", F.array_position(lower, name).cast("int") - 1)

    def entry(tag: Column, text: Column) -> Column:
        text = F.nullif(text, F.lit(""))
        return F.struct(tag.alias("tag"), text.try_cast("double").alias("value"), text.alias("text"))

    long = F.array_contains(lower, "tag") & F.array_contains(lower, "value")
    named = F.transform(F.arrays_zip("names", "cells"), lambda z: entry(z["names"], z["cells"]))
    wide = F.filter(named, lambda e: ~F.lower(e["tag"]).isin("step", "seq") & e["text"].isNotNull())
    step = cell("step").try_cast("double")
    whole = F.when(step == F.floor(step), step.cast("bigint"))
    found = body.select(
        "run", "file", F.col("value").alias("line"), "names", "cells", "mixed", whole.alias("step"),
        F.nullif(cell("seq"), F.lit("")).alias("seq_text"),
        F.when(long, F.array(entry(cell("tag"), cell("value")))).otherwise(wide).alias("entries"),
    )
    seq = F.col("seq_text").try_cast("bigint")
    unread = F.exists("entries", lambda e: e["text"].isNotNull() & e["value"].isNull())
    reason = (
        F.when(F.col("names").isNull(), "no header")
        .when(F.col("mixed"), "two headers")
        .when(F.size("cells") != F.size("names"), "cells")
        .when(F.col("step").isNull(), "step")
        .when(unread | (F.col("seq_text").isNotNull() & seq.isNull()), "value")
    )
    kept = F.transform("entries", lambda e: F.struct(e["tag"].alias("tag"), e["value"].alias("value")))
    return found.select("run", "file", "line", reason.alias("reason"), "step", seq.alias("seq"), kept.alias("entries"))


def good_scalars(scanned: DataFrame) -> DataFrame:
    """(run, tag, step, seq, value); ``seq`` is NULL where files have none."""
    if "entries" not in scanned.columns:  # no run has a file
        none = {"tag": "string", "step": "bigint", "seq": "bigint", "value": "double"}
        return scanned.select("run", *[F.lit(None).cast(t).alias(c) for c, t in none.items()]).limit(0)
    good = scanned.where(F.col("reason").isNull() & F.col("line").isNotNull())
    return good.select("run", "step", "seq", F.inline("entries")).select("run", "tag", "step", "seq", "value")


def rejected_scalars(scanned: DataFrame) -> DataFrame:
    """(run, reason, line) of the lines that were not read."""
    return scanned.where(F.col("reason").isNotNull() & F.col("line").isNotNull()).select("run", "reason", "line")


def load_report(scanned: DataFrame) -> DataFrame:
    """(run, n_lines, n_rejected, status) per run.

    The status is "missing" (no such path), "empty", "broken" (no line could be
    read) or "ok".
    """
    line = F.col("line") if "line" in scanned.columns else F.lit(None).cast("string")
    per_run = scanned.groupBy("run").agg(
        F.count(line).alias("n_lines"),
        F.count_if(line.isNotNull() & F.col("reason").isNotNull()).alias("n_rejected"),
        F.bool_or(F.coalesce(F.col("reason") == "missing", F.lit(False))).alias("missing"),
    )
    status = (
        F.when(F.col("missing"), "missing")
        .when(F.col("n_lines") == 0, "empty")
        .when(F.col("n_lines") == F.col("n_rejected"), "broken")
        .otherwise("ok")
    )
    return per_run.select("run", "n_lines", "n_rejected", status.alias("status"))


def write_eval_metrics(scalars: DataFrame, path: str) -> None:
    """Evaluation scalars (run, step, tag, value), appended to one directory per run."""
    scalars.select("step", "tag", "value", "run").write.mode("append").option("header", True).partitionBy(
        "run"
    ).csv(path)


def read_eval_metrics(spark: SparkSession, path: str) -> DataFrame:
    return (
        spark.read.schema("step bigint, tag string, value double, run string")
        .option("header", True)
        .csv(path)
        .select("tag", "value", "run", "step")
    )
