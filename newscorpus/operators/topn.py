"""The first n rows of an order, without a task that holds them all.

``orderBy().limit(n)`` sends up to n rows of every task to one.  Here a table of
quantiles gives a threshold that at least n rows stay below; what stays is cut
into ranges of the order, sorted range by range, and numbered by adding the
sizes of the ranges before.  Rows above the threshold never leave their task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newscorpus.sources import scratch

#: Quantiles of the leading column have a rank error of at most one in ``ACCURACY`` rows;
#: each level is the one before divided by ``STEP``, down to that error.
ACCURACY, STEP = 10_000, 1.15
LEVELS = [STEP**-k for k in range(math.ceil(math.log(ACCURACY, STEP)))]

_ROW_BITS = 33  # of an id of monotonically_increasing_id; the others are the partition


def first_rows(
    df: DataFrame, n: int, order: Sequence[str], descending: Sequence[str] = (), rank: str | None = "rank"
) -> DataFrame:
    """The first ``n`` rows along the columns ``order``, numbered from 1 in ``rank``.

    NULLs come first in an ascending column and last in a descending one, NaN is
    the largest number.  Rows that tie are ordered by a digest of the whole row;
    equal rows are interchangeable, all of them count.  A table of fewer rows is
    returned whole, an empty one or ``n`` = 0 gives no rows.  Without ``rank``
    the rows are the same and not numbered.

    The rows below the threshold are written to the shared folder twice: as they
    are, and range by range.
    """
    if n < 1:
        return df.limit(0).withColumn(rank, F.lit(0).cast("bigint")) if rank else df.limit(0)
    few = _below_threshold(df, n, order[0], order[0] in descending)
    keys = [F.desc(f"row.`{c}`") if c in descending else F.asc(f"row.`{c}`") for c in order]
    keys.append(F.asc(F.xxhash64("row")))
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = _saved(
        few.select("row")
        .repartitionByRange(ranges, *keys)
        .sortWithinPartitions(*keys)
        .select("row", F.monotonically_increasing_id().alias("at")),
        "ranges",
    )
    part = F.shiftright("at", _ROW_BITS).cast("int")
    sizes = dict(placed.groupBy(part.alias("part")).count().collect())  # a row for each range
    before = [0, *accumulate(sizes.get(k, 0) for k in range(max(sizes, default=0) + 1))]
    number = F.get(F.expr(f"array({', '.join(f'{k}L' for k in before)})"), part) + F.col("at").bitwiseAND((1 << _ROW_BITS) - 1) + 1
    # whole ranges beyond the n-th row need no look at their rows
    last = max(k for k, rows in enumerate(before) if rows < n)
    found = placed.where(part <= last).select("row", number.cast("bigint").alias("number")).where(F.col("number") <= n)
    return found.select("row.*", F.col("number").alias(rank)) if rank else found.select("row.*")


def _below_threshold(df: DataFrame, n: int, lead: str, descending: bool) -> DataFrame:
    """(row) of at least the first ``n`` rows, saved: few more than ``STEP`` times n."""
    place = _place(df.schema[lead].dataType, F.col(f"`{lead}`"), descending)
    seen = df.agg(
        F.count("*").alias("n"), F.percentile_approx(place, F.array(*map(F.lit, LEVELS)), F.lit(ACCURACY)).alias("q")
    )
    # twice the error above the n-th row
    share = F.try_divide(F.lit(n), F.col("n")) + 2 / ACCURACY
    level = F.floor(-F.log(share) / math.log(STEP)).cast("int")
    bound = F.when(share < 1, F.get("q", level)).otherwise(float("inf"))
    seen = seen.select(F.struct("n", bound.alias("bound")).alias("seen")).scalar()
    marked = df.select(F.struct("*").alias("row"), place.alias("place")).withColumn("seen", seen)
    few = _saved(marked.where("place <= seen.bound").select("row", F.col("seen.n").alias("n")), "threshold")
    # the quantiles are approximate within a proven error; this makes the result independent of it
    kept, total = few.agg(F.count("*"), F.max("n")).first()
    if kept < min(n, total or 0):
        return df.select(F.struct("*").alias("row"))
    return few


def _place(kind: T.DataType, col: Column, descending: bool) -> Column:
    """A number that never falls along the order; equal numbers for unequal keys are allowed."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        # the first six bytes: strings are ordered by their bytes
        head = F.rpad(F.hex(F.substring(col.cast("binary"), 1, 6)), 12, "0")
        number = F.conv(head, 16, 10).cast("double")
    elif isinstance(kind, (T.DateType, T.TimestampNTZType)):
        number = F.unix_seconds(col.cast("timestamp")).cast("double")
    else:
        number = F.nanvl(col.cast("double"), F.lit(float("inf")))
    return F.coalesce(-number if descending else number, F.lit(float("inf" if descending else "-inf")))


def _saved(df: DataFrame, name: str) -> DataFrame:
    path = scratch.new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
