"""Summary evaluation: ROUGE per pair, per corpus, and its sampling error."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newscorpus.functions import rouge as rg

METRICS = ("rouge1", "rouge2", "rougeL", "rougeLsum")


def score_pairs(
    pairs: DataFrame,
    metrics: Sequence[str] = METRICS,
    prediction: str = "prediction",
    reference: str = "reference",
    stemmed: bool = False,
) -> DataFrame:
    """Add one struct (precision, recall, f1) per metric.

    Every metric is computed inside the row of its pair.
    """
    out = pairs.withColumns(
        {
            "_p": rg.rouge_tokens(F.col(prediction), stemmed),
            "_r": rg.rouge_tokens(F.col(reference), stemmed),
        }
    )
    columns: dict[str, Column] = {}
    if "rouge1" in metrics:
        columns["rouge1"] = rg.rouge_n(F.col("_p"), F.col("_r"), 1)
    if "rouge2" in metrics:
        columns["rouge2"] = rg.rouge_n(F.col("_p"), F.col("_r"), 2)
    if "rougeL" in metrics:
        columns["rougeL"] = rg.rouge_l(F.col("_p"), F.col("_r"))
    if "rougeLsum" in metrics:
        columns["rougeLsum"] = rg.rouge_lsum(
            rg.sentence_tokens(F.col(prediction), stemmed),
            rg.sentence_tokens(F.col(reference), stemmed),
        )
    return out.withColumns(columns).drop("_p", "_r")


def rouge_corpus(
    scored: DataFrame, metrics: Sequence[str], by: Sequence[str] = (), digits: int = 4
) -> DataFrame:
    """Mean F1 per metric and group, rounded."""
    return scored.groupBy(*by).agg(
        *[F.round(F.avg(F.col(m)["f1"]), digits).alias(m) for m in metrics],
        F.count("*").alias("n_pairs"),
    )


def _poisson_thresholds() -> list[int]:
    """Cumulative Poisson(1) probabilities scaled to 32-bit integers.

    As many as such a draw can tell apart: the last one is its greatest value.
    """
    total, out, k = 0.0, [], 0
    while not out or out[-1] < 2**32 - 1:
        total += math.exp(-1.0) / math.factorial(k)
        out.append(int(total * 2**32))
        k += 1
    return out


POISSON_THRESHOLDS = _poisson_thresholds()
_DRAWS = 4  # 32-bit draws per md5 digest


def bootstrap_weights(pairs: DataFrame, key: str, reps: int) -> DataFrame:
    """Each row once per replicate that drew it, with its Poisson(1) ``weight``.

    The draw depends on (key, replicate) only, so a recomputed task repeats it.
    """
    blocks = F.sequence(F.lit(0), F.lit((reps - 1) // _DRAWS))
    seeded = pairs.withColumn("_b", F.explode(blocks)).withColumn(
        "_md5", F.md5(F.concat_ws(":", F.col(key).cast("string"), F.col("_b").cast("string")))
    )
    draws = F.array(
        *[
            F.conv(F.substring("_md5", 8 * j + 1, 8), 16, 10).cast("bigint")
            for j in range(_DRAWS)
        ]
    )
    out = seeded.select(
        *pairs.columns, "_b", F.posexplode(draws).alias("_j", "_u")
    ).withColumn("rep", F.col("_b") * _DRAWS + F.col("_j"))
    weight = sum(
        (F.when(F.col("_u") >= t, 1).otherwise(0) for t in POISSON_THRESHOLDS[1:]),
        F.when(F.col("_u") >= POISSON_THRESHOLDS[0], 1).otherwise(0),
    )
    return (
        out.withColumn("weight", weight)
        .where((F.col("weight") > 0) & (F.col("rep") < reps))
        .drop("_b", "_j", "_u")
    )


def rouge_bootstrap(
    scored: DataFrame, key: str, metrics: Sequence[str], reps: int = 1000
) -> DataFrame:
    """2.5 / 50 / 97.5 percent points of the resampled mean F1, one row per metric.

    Weighted sums per replicate combine map-side; ``reps`` rows are left after
    the shuffle, and the percentiles are exact over those.
    """
    flat = scored.select(key, *[F.col(m)["f1"].alias(m) for m in metrics])
    means = (
        bootstrap_weights(flat, key, reps)
        .groupBy("rep")
        .agg(*[(F.sum(F.col(m) * F.col("weight")) / F.sum("weight")).alias(m) for m in metrics])
    )
    long = means.select(
        F.inline(
            F.array(
                *[F.struct(F.lit(m).alias("metric"), F.col(m).alias("mean")) for m in metrics]
            )
        )
    )
    return long.groupBy("metric").agg(
        *[
            F.percentile("mean", F.lit(q)).alias(name)
            for name, q in (("low", 0.025), ("mid", 0.5), ("high", 0.975))
        ]
    )


def gen_len(df: DataFrame, ids: str, by: Sequence[str] = (), pad: int = 0) -> DataFrame:
    """Mean number of ids that are not padding."""
    return df.groupBy(*by).agg(
        F.avg(F.array_size(F.filter(F.col(ids), lambda i: i != pad))).alias("gen_len")
    )


def metrics_to_scalars(
    wide: DataFrame, metrics: Sequence[str], run: Column, step: Column
) -> DataFrame:
    """One row per metric as scalars (run, step, ``eval/<metric>``, value)."""
    rows = F.array(
        *[
            F.struct(
                F.lit(f"eval/{m}").alias("tag"), F.col(m).cast("double").alias("value")
            )
            for m in metrics
        ]
    )
    return wide.select(run.alias("run"), step.alias("step"), F.inline(rows))
