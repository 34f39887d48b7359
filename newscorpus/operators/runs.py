"""Analytics over scalar logs of training runs: (run, tag, step, seq, value)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newscorpus.operators import series

TRAIN_LOSS, EVAL_LOSS = "train/loss", "eval/loss"
GPU, TRAIN_SECONDS = "gpu_memory_gb", "total_training_time_seconds"
ROUGE_TAGS = {"rouge1": "eval/rouge1", "rouge2": "eval/rouge2", "rougeL": "eval/rougeL"}

#: Rows of one series that share a block in the running operators.
BLOCK_STEPS = 100_000


def scalars_to_long(wide: DataFrame, ids: Sequence[str] = ("run", "step", "seq")) -> DataFrame:
    """One row per present value: (ids…, tag, value).  Long input passes through."""
    if "tag" in wide.columns:
        return wide.where(F.col("value").isNotNull())
    kept = [c for c in ids if c in wide.columns]
    tags = [c for c in wide.columns if c not in kept]
    return wide.unpivot(kept, tags, "tag", "value").where(F.col("value").isNotNull())


def scalars_to_wide(
    scalars: DataFrame, tags: Sequence[str], ids: Sequence[str] = ("run", "step")
) -> DataFrame:
    """One column per tag; a tag written twice at a step keeps the later value."""
    last = dict.fromkeys(tags)
    for tag in tags:
        last[tag] = F.max_by(
            F.when(F.col("tag") == tag, F.col("value")),
            F.when(F.col("tag") == tag, F.col("seq")),
        ).alias(tag)
    return scalars.where(F.col("tag").isin(list(tags))).groupBy(*ids).agg(*last.values())


def loss_curves(scalars: DataFrame) -> DataFrame:
    """Training and validation loss series: (run, curve, step, seq, loss), in that order."""
    curve = F.when(F.col("tag") == TRAIN_LOSS, "train").otherwise("validation")
    return (
        scalars.where(F.col("tag").isin(TRAIN_LOSS, EVAL_LOSS) & F.col("value").isNotNull())
        .select("run", curve.alias("curve"), "step", "seq", F.col("value").alias("loss"))
        .orderBy("run", "curve", "step", "seq")
    )


def _of(tag: str, value: Column | str = "value") -> Column:
    v = F.col(value) if isinstance(value, str) else value
    return F.when((F.col("tag") == tag) & F.col("value").isNotNull(), v)


def _last(tag: str) -> Column:
    return F.max_by(_of(tag), _of(tag, F.struct("step", "seq")))


def _first(tag: str) -> Column:
    return F.min_by(_of(tag), _of(tag, F.struct("step", "seq")))


def last_metric(scalars: DataFrame, tags: Sequence[str]) -> DataFrame:
    """Last value per run and tag, by step and then by write order."""
    return (
        scalars.where(F.col("tag").isin(list(tags)) & F.col("value").isNotNull())
        .groupBy("run", "tag")
        .agg(F.max_by("value", F.struct("step", "seq")).alias("value"))
    )


def gpu_mean(scalars: DataFrame) -> DataFrame:
    """Mean GPU memory per run, NULL for a run that never logged it."""
    return scalars.groupBy("run").agg(F.avg(_of(GPU)).alias("gpu_avg"))


def _minutes(seconds: Column) -> Column:
    return F.nullif(seconds, F.lit(0.0)) / 60


def train_minutes(scalars: DataFrame) -> DataFrame:
    """First logged training time per run in minutes; zero counts as not logged."""
    return scalars.groupBy("run").agg(_minutes(_first(TRAIN_SECONDS)).alias("train_time_min"))


def run_summary(scalars: DataFrame, runs: DataFrame | None = None) -> DataFrame:
    """One row per run: last ROUGE values, mean GPU memory, training minutes.

    One conditional aggregate over the five tags that matter.  With a run list,
    runs that logged nothing still get a row of NULLs.
    """
    summary = (
        scalars.where(F.col("tag").isin(*ROUGE_TAGS.values(), GPU, TRAIN_SECONDS))
        .groupBy("run")
        .agg(
            *[_last(tag).alias(name) for name, tag in ROUGE_TAGS.items()],
            F.avg(_of(GPU)).alias("gpu_avg"),
            _minutes(_first(TRAIN_SECONDS)).alias("train_time_min"),
        )
    )
    return summary if runs is None else runs.join(summary, "run", "left")


def ema(scalars: DataFrame, alpha: float = 0.3, indexed: bool = False) -> DataFrame:
    """Smoothed value of every (run, tag) series in step order.

    ``indexed`` says that ``step`` already counts 1, 2, 3 … within each series.
    """
    if indexed:
        return series.ema(scalars, ["run", "tag"], "step", "value", alpha)
    numbered = series.running_index(
        scalars, ["run", "tag"], ["step", "seq"], F.floor(F.col("step") / BLOCK_STEPS), "_n"
    )
    return series.ema(numbered, ["run", "tag"], "_n", "value", alpha).drop("_n")


def valid_runs(scalars: DataFrame) -> DataFrame:
    """Runs with at least one training and one validation loss."""
    return (
        scalars.where(F.col("tag").isin(TRAIN_LOSS, EVAL_LOSS) & F.col("value").isNotNull())
        .groupBy("run")
        .agg(
            F.count(_of(TRAIN_LOSS)).alias("n_train"),
            F.count(_of(EVAL_LOSS)).alias("n_eval"),
        )
        .where((F.col("n_train") > 0) & (F.col("n_eval") > 0))
    )


def label_runs(summary: DataFrame, labels: DataFrame) -> DataFrame:
    """Add the run's size label, sorted by label text; unmapped runs get NULL.

    ``size_rows`` is the trailing ``<n>k`` of the label as a number, for a
    natural order.  ``pred_kind`` says what the ROUGE of the run was measured on:
    T5 runs score teacher-forced tokens and the others generated text, so the
    two kinds must not be compared.
    """
    rows = F.regexp_extract("data_size", r"(\d+)k$", 1)
    return (
        summary.join(labels, "run", "left")
        .withColumn("size_rows", F.when(rows != "", rows.cast("bigint") * 1000))
        .withColumn(
            "pred_kind",
            F.when(F.col("data_size").startswith("t5"), "teacher_forced").when(
                F.col("data_size").isNotNull(), "generated"
            ),
        )
        .orderBy("data_size", "run")
    )


def rouge_by_run(summary: DataFrame) -> DataFrame:
    """(run, metric, score) from the run table."""
    return summary.select("run", *ROUGE_TAGS).unpivot(["run"], list(ROUGE_TAGS), "metric", "score")


def lower_is_better(metric: str) -> bool:
    return metric.endswith("loss")


def best_checkpoint(scalars: DataFrame, metric: str, greater: bool | None = None) -> DataFrame:
    """Step of the best value per run; the earliest step wins a tie."""
    greater = not lower_is_better(metric) if greater is None else greater
    signed = -F.col("value") if greater else F.col("value")
    return (
        scalars.where((F.col("tag") == metric) & F.col("value").isNotNull())
        .groupBy("run")
        .agg(F.min(F.struct(signed.alias("v"), F.col("step").alias("step"))).alias("b"))
        .select(
            "run",
            F.col("b.step").alias("best_step"),
            (-F.col("b.v") if greater else F.col("b.v")).alias("best_value"),
        )
    )


def early_stop_step(
    scalars: DataFrame, metric: str = EVAL_LOSS, patience: int = 3, greater: bool | None = None
) -> DataFrame:
    """First step at which ``patience`` evaluations in a row brought no new best.

    Evaluation number and best value before come from one block-wise pass, the
    last improvement from a second, so a run of any length is spread over tasks.
    """
    greater = not lower_is_better(metric) if greater is None else greater
    keys, order = ["run"], ["step", "seq"]
    evals = scalars.where((F.col("tag") == metric) & F.col("value").isNotNull()).select(
        "run", "step", "seq", (-F.col("value") if greater else F.col("value")).alias("v")
    )
    block = F.floor(F.col("step") / BLOCK_STEPS)
    judged = series.running(
        evals,
        keys,
        order,
        block,
        [
            series.Running("n", "count", F.lit(1)),
            series.Running("best", "min", F.col("v"), exclusive=True),
        ],
    )
    improved = F.col("best").isNull() | (F.col("v") < F.col("best"))
    traced = series.running(
        judged,
        keys,
        order,
        block,
        [series.Running("last_improved", "max", F.when(improved, F.col("n")))],
    )
    stops = traced.where(F.col("n") - F.col("last_improved") >= patience)
    return (
        evals.select("run")
        .distinct()
        .join(stops.groupBy("run").agg(F.min("step").alias("stop_step")), "run", "left")
    )


def keep_last_checkpoints(
    checkpoints: DataFrame, n: int, best: DataFrame | None = None
) -> DataFrame:
    """The n latest steps per run, plus each run's best step if given.

    The row-number filter keeps n rows per run in every map task, so long runs
    are cut before the shuffle.
    """
    w = Window.partitionBy("run").orderBy(F.desc("step"))
    steps = checkpoints.select("run", "step").distinct()
    last = (
        steps.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= n).select("run", "step")
    )
    if best is None:
        return last
    return last.union(best.select("run", F.col("best_step"))).distinct()


def duplicate_sources(runs: DataFrame) -> DataFrame:
    """Log locations that more than one run claims, with those runs."""
    return (
        runs.groupBy("source")
        .agg(F.count("run").alias("n_runs"), F.min("run").alias("first_run"))
        .where(F.col("n_runs") > 1)
    )


def labels_frame(spark, labels: Sequence[tuple[str, str]]) -> DataFrame:
    return spark.createDataFrame(list(labels), "run string, data_size string")
