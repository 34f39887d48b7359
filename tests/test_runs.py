import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from newscorpus.plans.bindings import RUN_LABELS
from newscorpus.operators import runs, series

LONG = "run string, tag string, step bigint, seq bigint, value double"


def frame(spark, rows):
    return spark.createDataFrame(rows, LONG)


def evals(spark, values, tag=runs.EVAL_LOSS):
    return frame(spark, [("r", tag, i + 1, i, float(v)) for i, v in enumerate(values)])


@pytest.mark.parametrize("alpha", [0.3, 0.05, 0.9, 0.999, 1.0])
def test_ema_equals_recurrence_across_blocks(spark, alpha):
    rng = random.Random(4)
    values = {k: [rng.uniform(-50, 100) for _ in range(n)] for k, n in (("a", 0), ("b", 1), ("c", 3), ("d", 3000))}
    rows = [(k, "t", i + 1, i, v) for k, vs in values.items() for i, v in enumerate(vs)]
    got = runs.ema(frame(spark, rows), alpha, indexed=True).toPandas()
    for k, vs in values.items():
        mine = got[got.run == k].sort_values("step")["ema"].to_numpy()
        want = pd.Series(vs, dtype=float).ewm(alpha=alpha, adjust=False).mean().to_numpy()
        assert mine == pytest.approx(want, rel=1e-9, abs=1e-9)


def test_ema_numbers_sparse_steps_itself(spark):
    rows = [("r", "t", s, i, float(i)) for i, s in enumerate((5, 250_000, 250_000, 900_000))]
    got = [r["ema"] for r in runs.ema(frame(spark, rows), 0.5).orderBy("step", "seq").collect()]
    assert got == pytest.approx([0.0, 0.5, 1.25, 2.125])


def test_running_values_equal_plain_windows(spark):
    rng = random.Random(5)
    rows = [(rng.choice("ab"), "t", rng.randint(0, 400), i, float(rng.randint(0, 30))) for i in range(500)]
    df = frame(spark, rows)
    got = series.running(
        df, ["run"], ["step", "seq"], F.floor(F.col("step") / 16),
        [
            series.Running("n", "count", F.lit(1)),
            series.Running("s", "sum", F.col("value")),
            series.Running("lo", "min", F.col("value"), exclusive=True),
            series.Running("hi", "max", F.when(F.col("value") > 10, F.col("value"))),
        ],
    ).toPandas()
    assert len(got) == 500
    for _, g in got.groupby("run"):
        g = g.sort_values(["step", "seq"])
        assert g["n"].tolist() == list(range(1, len(g) + 1))
        assert g["s"].tolist() == g["value"].cumsum().tolist()
        lo = g["value"].cummin().shift(1)
        assert g["lo"].fillna(-1).tolist() == lo.fillna(-1).tolist()
        hi = g["value"].where(g["value"] > 10).cummax().ffill()
        assert g["hi"].fillna(-1).tolist() == hi.fillna(-1).tolist()


@pytest.mark.parametrize(
    "values, stop",
    [
        ([5, 4, 4, 4, 4], 5),  # an equal value is no improvement
        ([5, 6, 7, 8, 9], 4),  # exact patience
        ([5, 6, 7, 4, 5, 6], None),  # improvement at the last allowed evaluation
        ([5, 4, 3, 2, 1], None),
        ([5, 6, 7, 4, 5, 6, 7, 1], 7),
        ([1], None),
    ],
)
def test_early_stop(spark, values, stop):
    assert runs.early_stop_step(evals(spark, values), patience=3).first()["stop_step"] == stop
    mirrored = evals(spark, [-v for v in values], tag="eval/rougeL")
    assert runs.early_stop_step(mirrored, "eval/rougeL").first()["stop_step"] == stop


def test_early_stop_over_block_borders(spark):
    gap = runs.BLOCK_STEPS
    rows = [("r", runs.EVAL_LOSS, i * gap, i, v) for i, v in enumerate((3.0, 2.0, 2.5, 2.4, 2.2, 1.0))]
    assert runs.early_stop_step(frame(spark, rows)).first()["stop_step"] == 4 * gap


def test_summary_of_missing_zero_and_repeated_tags(spark):
    rows = [
        ("a", "eval/rouge1", 2, 1, 0.5),
        ("a", "eval/rouge1", 2, 2, 0.51),  # written twice at one step
        ("a", "eval/rouge1", 1, 3, 0.9),
        ("a", "gpu_memory_gb", 1, 4, 2.0),
        ("a", "gpu_memory_gb", 2, 5, 4.0),
        ("a", "total_training_time_seconds", 1, 6, 120.0),
        ("b", "total_training_time_seconds", 1, 1, 0.0),
        ("b", "train/loss", 1, 2, 0.3),
    ]
    listed = spark.createDataFrame([("a",), ("b",), ("c",)], "run string")
    got = {r["run"]: r.asDict() for r in runs.run_summary(frame(spark, rows), listed).collect()}
    assert got["a"] == {"run": "a", "rouge1": 0.51, "rouge2": None, "rougeL": None, "gpu_avg": 3.0, "train_time_min": 2.0}
    assert all(v is None for k, v in got["b"].items() if k != "run")
    assert all(v is None for k, v in got["c"].items() if k != "run")


def test_wide_and_long_hold_the_same_values(spark):
    rows = [("a", "x", 1, 1, 1.0), ("a", "y", 2, 2, 2.0), ("b", "x", 1, 3, 3.0)]
    df = frame(spark, rows)
    wide = runs.scalars_to_wide(df, ["x", "y", "z"])
    assert wide.columns == ["run", "step", "x", "y", "z"]
    back = {(r["run"], r["tag"], r["step"], r["value"]) for r in runs.scalars_to_long(wide).collect()}
    assert back == {(r[0], r[1], r[2], r[4]) for r in rows}
    assert runs.scalars_to_long(df).count() == 3


def test_best_and_kept_checkpoints(spark):
    df = evals(spark, [3, 1, 1, 2, 5, 4])
    best = runs.best_checkpoint(df, runs.EVAL_LOSS)
    assert tuple(best.first()) == ("r", 2, 1.0)
    assert tuple(runs.best_checkpoint(df, runs.EVAL_LOSS, greater=True).first()) == ("r", 5, 5.0)
    kept = {r["step"] for r in runs.keep_last_checkpoints(df, 2, best).collect()}
    assert kept == {5, 6, 2}


def test_labels_sort_as_text(spark):
    summary = spark.createDataFrame([("run0",), ("run1",), ("run6",), ("run99",)], "run string")
    got = [tuple(r) for r in runs.label_runs(summary, runs.labels_frame(spark, RUN_LABELS)).collect()]
    assert got == [
        ("run99", None, None, None),
        ("run6", "pegasus_large_2k", 2_000, "generated"),
        ("run1", "t5_base_10k", 10_000, "teacher_forced"),
        ("run0", "t5_base_2k", 2_000, "teacher_forced"),
    ]


def test_valid_runs_and_duplicate_sources(spark):
    rows = [("a", runs.TRAIN_LOSS, 1, 1, 1.0), ("a", runs.EVAL_LOSS, 1, 2, 1.0), ("b", runs.TRAIN_LOSS, 1, 3, 1.0)]
    assert [r["run"] for r in runs.valid_runs(frame(spark, rows)).collect()] == ["a"]
    listed = spark.createDataFrame([("a", "s1"), ("b", "s1"), ("c", "s2")], "run string, source string")
    assert [tuple(r) for r in runs.duplicate_sources(listed).collect()] == [("s1", 2, "a")]


def test_loss_curves_come_in_order(spark):
    rows = [(f"r{k % 3}", ("eval/loss", "train/loss")[k % 2], k * 7 % 40, k % 5, float(k)) for k in range(120)]
    got = runs.loss_curves(spark.createDataFrame(rows, LONG).repartition(5)).collect()
    keys = [(r["run"], r["curve"], r["step"], r["seq"]) for r in got]
    assert len(keys) == 120 and keys == sorted(keys)
