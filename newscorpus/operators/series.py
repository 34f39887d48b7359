"""Running values over ordered series, safe when one series dominates.

A plain ``Window.partitionBy(key).orderBy(pos)`` sends a whole series to one
task.  Here a series is cut into blocks of its ordering column: each block gets
a local window, block totals (one row per block, combined map-side) get a window
of their own, and the carry from earlier blocks is joined back on (key, block).
The rows are shuffled once, on (key, block), so a series that holds a third of
the data is spread over as many tasks as it has blocks.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_BLOCK = "_block"


def _fold(fn: str, local: Column, carry: Column) -> Column:
    if fn == "min":
        return F.least(local, carry)
    if fn == "max":
        return F.greatest(local, carry)
    return F.coalesce(local, F.lit(0)) + F.coalesce(carry, F.lit(0))


_AGG = {"min": F.min, "max": F.max, "sum": F.sum, "count": F.count}
_MERGE = {**_AGG, "count": F.sum}


@dataclass(frozen=True)
class Running:
    """One running value: ``fn`` (min, max, sum, count) of ``value``.

    With ``exclusive`` the row itself is left out.
    """

    name: str
    fn: str
    value: Column
    exclusive: bool = False


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    block: Column,
    values: Sequence[Running],
) -> DataFrame:
    """Add running values from the series start to each row.

    ``block`` must not decrease along ``order``; ``keys`` and ``block`` must not
    be NULL.
    """
    keys = list(keys)
    by = [*keys, _BLOCK]
    blocked = df.withColumn(_BLOCK, block).withColumns(
        {f"_v_{r.name}": r.value for r in values}
    )
    before = Window.partitionBy(*keys).orderBy(_BLOCK).rowsBetween(
        Window.unboundedPreceding, -1
    )
    within = Window.partitionBy(*by).orderBy(*order)
    carries = (
        blocked.groupBy(*by)
        .agg(*[_AGG[r.fn](f"_v_{r.name}").alias(f"_t_{r.name}") for r in values])
        .select(
            *by,
            *[_MERGE[r.fn](f"_t_{r.name}").over(before).alias(f"_c_{r.name}") for r in values],
        )
    )
    local = {
        f"_l_{r.name}": _AGG[r.fn](f"_v_{r.name}").over(
            within.rowsBetween(Window.unboundedPreceding, -1 if r.exclusive else 0)
        )
        for r in values
    }
    # the local windows and the join ask for the same partitioning
    joined = blocked.withColumns(local).join(carries, by)
    return joined.select(
        *df.columns,
        *[_fold(r.fn, F.col(f"_l_{r.name}"), F.col(f"_c_{r.name}")).alias(r.name) for r in values],
    )


def running_index(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], block: Column, name: str
) -> DataFrame:
    """Number the rows of each series 1, 2, 3 … along ``order``."""
    return running(df, keys, order, block, [Running(name, "count", F.lit(1))])


def ema(
    df: DataFrame,
    keys: Sequence[str],
    index: str,
    value: str,
    alpha: float,
    name: str = "ema",
) -> DataFrame:
    """Exponential moving average s1 = v1, st = a*vt + (1-a)*s(t-1), per series.

    ``index`` numbers the rows of a series 1, 2, 3 …  Inside a block of B rows
    the recurrence is a running sum of values scaled by powers of the decay;
    between blocks it is a carry.  B keeps every power inside double range, and
    a carry needs only as many earlier blocks as have a decay that is not yet
    zero in double arithmetic, so the result is that of the full recurrence.
    """
    keys = list(keys)
    decay = 1.0 - alpha
    if decay <= 0.0:
        return df.withColumn(name, F.col(value).cast("double"))
    digits = -math.log10(decay)
    rows = max(1, min(1 << 20, int(100 / digits)))
    reach = max(1, math.ceil(330 / (digits * rows)))

    by = [*keys, _BLOCK]
    blocked = df.withColumn(_BLOCK, F.floor((F.col(index) - 1) / rows)).withColumn(
        "_i", F.pmod(F.col(index) - 1, F.lit(rows)) + 1
    )
    scaled = alpha * F.col(value) * F.pow(F.lit(decay), -F.col("_i"))
    totals = blocked.groupBy(*by).agg(
        (F.pow(F.lit(decay), F.max("_i")) * F.sum(scaled)).alias("_u"),
        # the first value of the series acts as the total of a block before it
        F.max(F.when(F.col(index) == 1, F.col(value))).alias("_first"),
    )
    sent = (
        totals.withColumn("_ahead", F.explode(F.sequence(F.lit(1), F.lit(reach))))
        .select(
            *keys,
            (F.col(_BLOCK) + F.col("_ahead")).alias(_BLOCK),
            (F.col("_u") * F.pow(F.lit(decay), (F.col("_ahead") - 1) * rows)).alias("_c"),
        )
        .unionByName(
            totals.where(F.col("_first").isNotNull())
            .withColumn("_ahead", F.explode(F.sequence(F.lit(0), F.lit(reach))))
            .select(
                *keys,
                (F.col(_BLOCK) + F.col("_ahead")).alias(_BLOCK),
                (F.col("_first") * F.pow(F.lit(decay), F.col("_ahead") * rows)).alias("_c"),
            )
        )
        .groupBy(*by)
        .agg(F.sum("_c").alias("_carry"))
    )
    within = Window.partitionBy(*by).orderBy("_i").rowsBetween(Window.unboundedPreceding, 0)
    power = F.pow(F.lit(decay), F.col("_i"))
    return (
        blocked.withColumn("_local", power * F.sum(scaled).over(within))
        .join(sent, by, "left")
        .withColumn(name, F.col("_local") + power * F.coalesce(F.col("_carry"), F.lit(0.0)))
        .drop(_BLOCK, "_i", "_local", "_carry")
    )
