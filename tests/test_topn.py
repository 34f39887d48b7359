import math

import pytest
from pyspark.sql import functions as F

from newscorpus.operators import topn


def numbered(df, key="k"):
    return [(r["rank"], r[key]) for r in df.orderBy("rank").collect()]


@pytest.mark.parametrize("n", [0, 1, 37, 3000, 5000, 9999])
def test_same_rows_as_a_sort(spark, n):
    df = spark.range(5000).select(((F.col("id") * 7919) % 5003).alias("k"), F.lit("text").alias("t")).repartition(7)
    want = [(i + 1, k) for i, k in enumerate(sorted(r["k"] for r in df.collect())[:n])]
    got = topn.first_rows(df, n, ["k"])
    assert numbered(got) == want and got.columns == ["k", "t", "rank"]


def test_descending_with_ties_in_the_lead(spark):
    """A third of all rows share the leading value, on both sides of the cut."""
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 11).alias("n"), F.concat(F.lit("w"), "id").alias("word")
    )
    rows = sorted((-r["n"], r["word"]) for r in df.collect())
    for n in (10, 1400, 2200):
        got = topn.first_rows(df, n, ["n", "word"], descending=["n"]).orderBy("rank").collect()
        assert [(-r["n"], r["word"]) for r in got] == rows[:n]
        assert [r["rank"] for r in got] == list(range(1, n + 1))


def test_a_whole_tie_counts_every_row(spark):
    df = spark.range(1000).select(F.lit(1).alias("k"), (F.col("id") % 2).alias("copy"))
    assert topn.first_rows(df, 333, ["k"], rank=None).count() == 333
    assert sorted(r["rank"] for r in topn.first_rows(df, 333, ["k"]).collect()) == list(range(1, 334))


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("kind", ["string", "double", "timestamp", "date"])
def test_kinds_nulls_and_nan(spark, kind, descending):
    base = spark.range(900).select((F.col("id") * 7 % 901).alias("i"))
    made = {
        "string": F.format_string("schlüssel %04d", "i"),
        "double": F.when(F.col("i") % 10 == 3, math.nan).otherwise(F.col("i") / 3 - 100),
        "timestamp": F.timestamp_seconds(F.col("i") * 1000),
        "date": F.date_add(F.lit("2020-01-01").cast("date"), F.col("i").cast("int")),
    }[kind]
    df = base.select(F.when(F.col("i") % 20 != 7, made).alias("k"), "i").repartition(5)
    order = [F.desc("k") if descending else F.asc("k"), "i"]
    for n in (10, 60, 400):
        want = [str(r["k"]) for r in df.orderBy(*order).limit(n).collect()]
        got = topn.first_rows(df, n, ["k", "i"], descending=["k"] if descending else []).orderBy("rank").collect()
        assert [str(r["k"]) for r in got] == want


def test_empty_table_and_odd_names(spark):
    empty = spark.createDataFrame([], "`a.b` bigint, row string, at string, seen string")
    assert topn.first_rows(empty, 5, ["a.b"]).count() == 0
    odd = empty.union(spark.createDataFrame([(2, "x", "y", "z"), (1, None, None, None)], empty.schema))
    got = topn.first_rows(odd, 1, ["a.b"]).collect()
    assert [tuple(r) for r in got] == [(1, None, None, None, 1)]


def test_few_rows_pass_the_threshold(spark, monkeypatch):
    """Neither task nor file receives the head of every input task."""
    written = {}
    save = topn._saved

    def counted(df, name):
        written[name] = save(df, name)
        return written[name]

    monkeypatch.setattr(topn, "_saved", counted)
    df = spark.range(200_000).select((F.col("id") * 7919 % 200_003).alias("k")).repartition(8)
    assert topn.first_rows(df, 2_000, ["k"]).count() == 2_000
    assert 2_000 <= written["threshold"].count() <= topn.STEP * (2_000 + 3 * 200_000 / topn.ACCURACY) + 200_000 / topn.ACCURACY
    sizes = [r["count"] for r in written["ranges"].groupBy(F.shiftright("at", 33).alias("p")).count().collect()]
    assert len(sizes) == 4 and max(sizes) < 2 * sum(sizes) / len(sizes)
