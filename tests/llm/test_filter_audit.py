"""The filter audit against every order walked by hand."""

import re
from itertools import permutations

import duckdb
import pytest
from pyspark.sql import functions as F

from newscorpus.llm import filter_audit, queries

SF = "/root/testdata/sf0.001"


def walked(rows, names):
    """rows: (part, {failing names}, mark).  Every order, row by row."""
    out, removed_by = {}, {}
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        for order in permutations(names):
            left = own
            for step, x in enumerate(order, 1):
                gone = [r for r in left if x in r[1]]
                left = [r for r in left if x not in r[1]]
                fails = [r for r in own if x in r[1]]
                out[part, "".join(order), step] = [
                    len(left), len(gone), len(fails) - len(gone), sum(r[1] == {x} for r in own), sum(r[2] for r in gone)
                ]
                removed_by[part, x] = removed_by.get((part, x), 0) + len(gone)
    return {(p, o, s): (*v, removed_by[p, o[s - 1]]) for (p, o, s), v in out.items()}


def found(df, mark):
    columns = ["kept", "removed", "redundant", "unique_fails", f"lost_{mark}", "shapley"]
    return {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in columns) for r in df.collect()}


def test_lattice_counts_orders():
    lattice = filter_audit.Lattice(4)
    assert lattice.forward[-1] == lattice.backward[0] == 24
    assert all(lattice.forward[s] * lattice.backward[s] <= 24 for s in range(16))
    # every order passes one state of each size
    sizes = [bin(s).count("1") for s in range(16)]
    for k in range(5):
        assert sum(lattice.forward[s] * lattice.backward[s] for s in range(16) if sizes[s] == k) == 24


def test_audit_equals_walking_every_order(spark):
    rows = [
        ("x", "AB", 1), ("x", "A", 0), ("x", "", 1), ("x", "ABC", 1), ("x", "C", 0), ("x", "C", 0),
        (None, "B", 1), (None, "BC", None), ("", "", 1), ("y", "", 0),
    ]
    df = spark.createDataFrame(rows, "part string, fails string, good int")
    df = df.withColumns({c: F.lit("clash") for c in ("mask", "n", "m0", "step", "_row", "lost_good")})
    failures = {x: F.col("fails").contains(x) for x in "ABC"}
    got = filter_audit.audit(df, failures, F.col("part"), {"good": F.col("good") == 1})
    want = walked([(p or "", set(f), g == 1) for p, f, g in rows], "ABC")
    assert found(got, "good") == want and got.count() == len(want)
    assert filter_audit.audit(df.limit(0), failures, F.col("part")).count() == 0
    nulls = filter_audit.audit(df, {"A": F.lit(None).cast("boolean")}, F.col("part"))
    assert {r["removed"] for r in nulls.collect()} == {0}
    with pytest.raises(ValueError):
        filter_audit.audit(df, {}, F.col("part"))
    with pytest.raises(ValueError):
        filter_audit.audit(df, {str(k): F.lit(True) for k in range(8)}, F.col("part"))


TEXTS = [
    (1, "a " * 120, "en"), (2, "a " * 120, "en"), (2, "a " * 120, "en"), (None, "null id", "fr"), (5, "null id", "fr"),
    (6, None, None), (7, "", ""), (8, " \t\n", "fr"), (9, " ".join(f"w{k}é" for k in range(150)), "en"),
    (10, "ABC|" * 3, None), (11, " ".join(f"W{k}" for k in range(30_000)) + "\x0b\x1cx", "en"), (12, "a b", "en"),
]


def test_query_on_hard_rows(spark, tmp_path):
    docs = spark.createDataFrame(TEXTS, "doc_id bigint, text string, lang string")
    clash = {c: F.lit("clash") for c in ("id", "part", "digest", "quality", "_of", "n_words", "repeated")}
    docs.withColumns(clash).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(1, 1, 1), (1, 0, 0), (2, 1, None), (5, None, 1), (99, 1, 1), (None, 1, 1)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")

    def fails(key, text, seen):
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        out = "A" * (len(words) < 100) + "B" * (100 * len(set(words)) < 80 * len(words))
        out += "C" * (100 * len(re.findall("[A-Z]", text)) > 10 * len(text)) + "D" * bool(re.search(r"[#$%&*|]", text))
        return set(out + "E" * (seen[text] < (key is not None, key or 0)))

    seen = {}
    for key, text, _ in TEXTS:
        at = (key is not None, key or 0)
        seen[text or ""] = min(seen.get(text or "", at), at)
    good = {1, 2}
    rows = [(lang or "", fails(key, text, seen), key in good) for key, text, lang in TEXTS]
    got = queries.op12_audit(spark, str(tmp_path)).withColumnRenamed("good_lost", "lost_good")
    assert found(got, "good") == walked(rows, "ABCDE")


def test_query_equals_sql(spark):
    con = duckdb.connect()
    for name in ("documents", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    got = queries.op12_audit(spark, SF)
    want = con.execute(queries.SQL["op12_audit"])
    columns = [c[0] for c in want.description]
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(want.fetchall())


def test_copies_are_aggregated_before_they_meet(spark):
    df = spark.range(1000).selectExpr("id", "'same' AS digest")
    out = filter_audit.repeats_smaller(df, "id", "digest", "repeated")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "Window" not in plan
    assert out.where("NOT repeated").count() == 1
