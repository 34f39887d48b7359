import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newscorpus.operators import curate, evaluate
from newscorpus.operators.rules import Rule, Selector
from newscorpus.plans import daily
from newscorpus.schemas import ARTICLE, PREDICTION
from newscorpus.sources import articles as io
from newscorpus.sources import rejects
from newscorpus.sources import scalars as scalar_io
from newscorpus.streaming import incremental

RULES = [Rule("s", path=(Selector("article"),))]
SCHEMA = (
    "article_id bigint, source_name string, author string, title string, url string, "
    "published_at string, content string, html string, published_date date"
)


def row(i, url, day, content="the cat is on the mat", author="x", html="<article><p>body {}</p></article>"):
    return (i, "s", author, "t", url, f"{day}T00:00:00Z", content, html.format(i))


def articles(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA.rsplit(",", 1)[0])
    return io.with_published_date(df)


ROWS = [
    row(1, "u1", "2024-01-01"),
    row(2, "u1", "2024-01-01"),  # copy
    row(3, "u1", "2024-01-02"),  # same URL, other day
    row(4, None, "2024-01-01"),
    row(5, "u5", "2024-01-01", content="der Hund und die Katze"),
    row(6, "u5", "2024-01-01"),  # English, but its first copy is not
    row(7, "u7", "2024-01-02", author="None"),
    row(8, "u8", "2024-01-02", html="<div>no container</div>"),
    row(9, "u9", "2024-01-02"),
    row(10, "u1", "2024-01-01"),
]
KEPT = {(1, "body 1"), (3, "body 3"), (9, "body 9")}


def test_curation_order(spark):
    got = daily.curate_articles(articles(spark, ROWS), RULES)
    assert {(r["article_id"], r["full_content"]) for r in got.collect()} == KEPT
    one_day = daily.daily_curation(articles(spark, ROWS), "2024-01-02", rules=RULES)
    assert {r["article_id"] for r in one_day.collect()} == {3, 9}


def test_day_run_is_repeatable_and_leaves_other_days(spark, tmp_path):
    source, target = f"{tmp_path}/src", f"{tmp_path}/out"
    io.append_articles(articles(spark, ROWS), source)
    for day in ("2024-01-01", "2024-01-02", "2024-01-02"):
        daily.run_day(spark, source, target, day, rules=RULES)
    got = spark.read.parquet(target).select("article_id", "full_content")
    assert sorted(map(tuple, got.collect())) == sorted(KEPT)


@pytest.mark.parametrize("cuts", [[10], [5, 5], [1, 3, 6], [1] * 10])
def test_stream_equals_batch(spark, tmp_path, cuts):
    df = articles(spark, ROWS)
    args = dict(
        schema=df.schema,
        target=f"{tmp_path}/out",
        ledger=f"{tmp_path}/ledger",
        checkpoint=f"{tmp_path}/cp",
        rules=RULES,
        max_files=1,
    )
    start = 0
    for n in cuts:  # one landed file and one call per cut: the daily resume
        part = df.where((F.col("article_id") > start) & (F.col("article_id") <= start + n))
        part.coalesce(1).write.mode("append").parquet(f"{tmp_path}/landed")
        incremental.incremental_curation(spark, f"{tmp_path}/landed", **args)
        start += n
    got = incremental.read_curated(spark, f"{tmp_path}/out", f"{tmp_path}/ledger")
    assert {(r["article_id"], r["full_content"]) for r in got.collect()} == KEPT
    # nothing new has landed: another call changes nothing
    incremental.incremental_curation(spark, f"{tmp_path}/landed", **args)
    assert incremental.read_curated(spark, f"{tmp_path}/out", f"{tmp_path}/ledger").count() == len(KEPT)


def test_new_checkpoints_neither_repeat_nor_lose(spark, tmp_path):
    df = articles(spark, ROWS)
    out, ledger = f"{tmp_path}/out", f"{tmp_path}/ledger"
    for k, part in enumerate(("article_id <= 4", "article_id BETWEEN 5 AND 7", "article_id > 7")):
        df.where(part).coalesce(1).write.mode("append").parquet(f"{tmp_path}/landed")
        for again in range(2):  # each call with a checkpoint of its own sees all files anew
            incremental.incremental_curation(
                spark, f"{tmp_path}/landed", df.schema, out, ledger, f"{tmp_path}/cp{k}{again}", rules=RULES
            )
    got = incremental.read_curated(spark, out, ledger)
    assert sorted((r["article_id"], r["full_content"]) for r in got.collect()) == sorted(KEPT)
    keys = incremental.admitted_keys(spark, ledger)
    assert keys.count() == keys.select("published_date", "url").distinct().count()
    # by day, and narrow
    assert set(keys.columns) == {"url", "stream_id", "batch_id", "published_date"}


class Stop(Exception):
    pass


@pytest.mark.parametrize("fails_at", ["keys", "target"])
def test_a_failed_batch_does_not_count(spark, tmp_path, monkeypatch, fails_at):
    """Neither its rows nor its keys, for a replay as well as for a new stream."""
    df = articles(spark, ROWS)
    out, ledger = f"{tmp_path}/out", f"{tmp_path}/ledger"
    args = dict(target=out, ledger=ledger, rules=RULES)
    for name, schema, by in (
        ("keys", incremental._KEYS_SCHEMA, [*incremental.BATCH, "published_date"]),
        ("commits", incremental._COMMITS_SCHEMA, incremental.BATCH),
    ):
        incremental._create(spark, f"{ledger}/{name}", schema, by)

    def stop(df, rules):
        raise Stop

    with monkeypatch.context() as m:
        if fails_at == "keys":
            m.setattr(incremental, "extract_body", stop)
        else:
            # the commit is the last write: cut off right before it
            read = incremental.F.count
            m.setattr(incremental.F, "count", lambda c: stop(c, None) if c == "*" else read(c))
        with pytest.raises(Stop):
            incremental.write_batch(df.where("article_id < 6"), "s1", 0, **args)
    assert incremental.admitted_keys(spark, ledger).count() == 0
    for stream, batch in (("s1", 0), ("s1", 0), ("s2", 0), ("s2", 1)):
        incremental.write_batch(df, stream, batch, **args)
    got = incremental.read_curated(spark, out, ledger)
    assert sorted((r["article_id"], r["full_content"]) for r in got.collect()) == sorted(KEPT)


def test_redelivered_rows_within_the_watermark(spark, tmp_path):
    df = articles(spark, ROWS)
    for part in (df.where("article_id <= 6"), df):
        part.coalesce(1).write.mode("append").parquet(f"{tmp_path}/landed")
    incremental.incremental_curation(
        spark, f"{tmp_path}/landed", df.schema, f"{tmp_path}/out", f"{tmp_path}/ledger",
        f"{tmp_path}/cp", rules=RULES, max_files=1, replay_window="2 days",
    )
    got = incremental.read_curated(spark, f"{tmp_path}/out", f"{tmp_path}/ledger")
    assert {(r["article_id"], r["full_content"]) for r in got.collect()} == KEPT


def test_day_rerun_replaces_by_what_there_is(spark, tmp_path):
    source, target = f"{tmp_path}/src", f"{tmp_path}/out"
    io.append_articles(articles(spark, ROWS), source)
    for day in ("2024-01-01", "2024-01-02"):
        daily.run_day(spark, source, target, day, rules=RULES)
    io.replace_day(articles(spark, ROWS).where("article_id = 3"), source, "2024-01-02")
    io.replace_day(articles(spark, ROWS).limit(0), source, "2024-01-01")
    for day in ("2024-01-01", "2024-01-02", "2024-01-05"):
        daily.run_day(spark, source, target, day, rules=RULES)
    got = spark.read.parquet(target).select("article_id", "full_content")
    assert [tuple(r) for r in got.collect()] == [(3, "body 3")]


def test_one_day_prunes_the_others(spark, tmp_path):
    io.append_articles(articles(spark, ROWS), f"{tmp_path}/t")
    day = daily.daily_curation(io.read_articles(spark, f"{tmp_path}/t"), "2024-01-02", rules=RULES)
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "published_date" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_chain_from_responses_to_a_curated_day(spark, tmp_path):
    def response(*articles_):
        listed = [
            {"source": {"id": None, "name": "s"}, "title": "t", "author": "a", "url": u, "content": c,
             "publishedAt": "2024-01-02T10:00:00Z"} for u, c in articles_
        ]
        return json.dumps({"status": "ok", "articles": listed})

    english = "the cat is on the mat"
    raw = [
        ("q1", response(("u1", english), ("u2", english), ("u1", "der Hund und die Katze"))),
        ("q2", response(("u3", "der Hund und die Katze"), (None, english))),
        ("q3", '{"status": "error"}'), ("q4", '{"status": "ok", "articles": [{"ti'), ("q5", None),
        ("q6", '{"status": "ok", "articles": []}'), ("q7", '{"status": "ok"}'), ("q8", "[1]"),
    ]
    landed = spark.createDataFrame(raw, "query string, json string")
    flat = curate.flatten_articles(landed, with_ids=True)
    again = curate.flatten_articles(landed.repartition(5), with_ids=True)
    assert sorted(r["article_id"] for r in flat.collect()) == sorted(r["article_id"] for r in again.collect())
    assert flat.select("article_id").distinct().count() == 5
    io.append_articles(flat, f"{tmp_path}/src")
    pages = spark.createDataFrame(
        [(f"u{k}", f"<article><p>body {k}</p></article>") for k in (1, 2, 3)], "url string, html string"
    )
    daily.run_day(
        spark, f"{tmp_path}/src", f"{tmp_path}/out", "2024-01-02", rules=RULES, pages=pages, page_key="url",
        order=("position", "article_id"),
    )
    got = spark.read.parquet(f"{tmp_path}/out")
    assert sorted((r["url"], r["full_content"]) for r in got.collect()) == [("u1", "body 1"), ("u2", "body 2")]
    rejected = {r["category"]: r["reason"] for r in curate.rejected_responses(landed).collect()}
    assert rejected == {
        "q3": "error", "q4": "broken", "q5": "broken", "q6": "no articles", "q7": "no articles", "q8": "broken"
    }


def test_csv_round_trip_keeps_odd_text(spark, tmp_path):
    odd = ['say "hi", x', "two\nlines\r\nhere", " padded ", "back\\slash", 'end"', "éß–", None]
    rows = [tuple([f"id{i}"] + [None] * 7 + [t, "q"]) for i, t in enumerate(odd)]
    io.export_csv(spark.createDataFrame(rows, ARTICLE), f"{tmp_path}/csv")
    back = {r["source_id"]: r["content"] for r in io.read_csv_corpus(spark, f"{tmp_path}/csv", ARTICLE).collect()}
    assert back == {f"id{i}": t for i, t in enumerate(odd)}


def test_filter_and_columns_reach_the_scan(spark, tmp_path):
    io.append_articles(articles(spark, ROWS), f"{tmp_path}/t")
    table = io.read_articles(spark, f"{tmp_path}/t")
    pruned = table.where(F.col("published_date") == F.lit("2024-01-02").cast("date")).select("url")
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "published_date" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "ReadSchema: struct<url:string>" in plan
    sliced = curate.day_slice(table, "2024-01-02").select("url")
    plan = sliced._jdf.queryExecution().executedPlan().toString()
    assert "StringStartsWith(published_at,2024-01-02)" in plan
    assert sorted(r["url"] for r in sliced.collect()) == ["u1", "u7", "u8", "u9"]


def test_scalar_files_by_their_headers(spark, tmp_path):
    files = {
        "long": "step,tag,value,seq\n1,x,0.5,1\noops,x,0.6,2\n2,x,,3\n3,x,abc,4\n4,x\n1.5,x,1,5\n",
        "moved": 'value,wall_time,Tag,STEP\n1.5,99,"a,""b""",7\nNaN,99,y,8.0\n',
        "wide": "step,train/loss,eval/loss\n1,0.5,\n2,,0.25\n3,x,0.1\n4,1,2,3\n",
        "empty": "",
        "bare": "1,x,0.5\n2,x,0.6\n",
        "junk": "\x00\x01 nothing\n",
        "only": "step,tag,value\n",
    }
    for name, text in files.items():
        (tmp_path / f"{name}.csv").write_text(text)
    both = tmp_path / "both"  # one run, two layouts
    both.mkdir()
    (both / "1.csv").write_text("step,tag,value\n1,x,1\n")
    (both / "2.csv").write_text("x,step\n2,2\n\n")
    paths = {n: f"{tmp_path}/{n}.csv" for n in files} | {"both": str(both), "gone": f"{tmp_path}/gone.csv"}
    scanned = scalar_io.scan_scalars(spark, paths)
    got = {(r["run"], r["step"], r["tag"], str(r["value"]), r["seq"]) for r in scalar_io.good_scalars(scanned).collect()}
    assert got == {
        ("long", 1, "x", "0.5", 1), ("long", 2, "x", "None", 3), ("moved", 7, 'a,"b"', "1.5", None),
        ("moved", 8, "y", "nan", None), ("wide", 1, "train/loss", "0.5", None), ("wide", 2, "eval/loss", "0.25", None),
        ("both", 1, "x", "1.0", None), ("both", 2, "x", "2.0", None),
    }
    report = {r["run"]: tuple(r)[1:] for r in scalar_io.load_report(scanned).collect()}
    assert report == {
        "long": (6, 4, "ok"), "moved": (2, 0, "ok"), "wide": (4, 2, "ok"), "empty": (0, 0, "empty"),
        "bare": (2, 2, "broken"), "junk": (1, 1, "broken"), "only": (0, 0, "empty"), "both": (2, 0, "ok"),
        "gone": (0, 0, "missing"),
    }
    reasons = {(r["run"], r["reason"]) for r in scalar_io.rejected_scalars(scanned).collect()}
    assert {r for n, r in reasons if n == "long"} == {"step", "value", "cells"}
    assert ("bare", "no header") in reasons and ("wide", "cells") in reasons
    none = scalar_io.scan_scalars(spark, {"gone": f"{tmp_path}/gone.csv"})
    assert scalar_io.good_scalars(none).count() == 0
    assert [tuple(r) for r in scalar_io.load_report(none).collect()] == [("gone", 0, 0, "missing")]


def test_rejects_are_written_beside_the_good_rows(spark, tmp_path):
    good = '{"status":"ok","articles":[{"title":"t"},{"title":"u"}]}'
    raw = [("q", good), ("q", good[:-4]), ("q", None), ("q", '{"status":"error"}'), ("q", '{"status":"ok"}')]
    landed = spark.createDataFrame(raw, "query string, json string")
    path = f"{tmp_path}/articles"
    rejects.write_checked(rejects.checked_articles(landed), path)
    assert sorted(r["title"] for r in rejects.read_good(spark, path).collect()) == ["t", "u"]
    assert set(ARTICLE.fieldNames()) <= set(rejects.read_good(spark, path).columns)
    found = {tuple(r) for r in rejects.read_rejects(spark, path).collect()}
    assert found == {
        ("broken", good[:-4]), ("broken", None), ("error", '{"status":"error"}'), ("no articles", '{"status":"ok"}')
    }
    plan = rejects.read_good(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "rejected" in plan.split("PartitionFilters: [")[1].split("]")[0]
    (tmp_path / "c.csv").write_text('a,b\n1,"x\ny"\nz,q\n3\n4,"r"\n')
    checked = io.read_csv_corpus(spark, f"{tmp_path}/c.csv", T.StructType.fromDDL("a bigint, b string"), checked=True)
    rejects.write_checked(checked, f"{tmp_path}/csv")
    assert sorted(map(tuple, rejects.read_good(spark, f"{tmp_path}/csv").collect())) == [(1, "x\ny"), (4, "r")]
    assert {tuple(r) for r in rejects.reject_report(spark, f"{tmp_path}/csv").collect()} == {("", 2), ("broken", 2)}


def test_metric_and_result_files(spark, tmp_path):
    wide = spark.createDataFrame([(1, 0.25, 0.5)], "turn bigint, rouge1 double, rouge2 double")
    scalars = evaluate.metrics_to_scalars(wide, ["rouge1", "rouge2"], F.lit("r"), F.col("turn"))
    scalar_io.write_eval_metrics(scalars, f"{tmp_path}/m")
    got = {tuple(r) for r in scalar_io.read_eval_metrics(spark, f"{tmp_path}/m").collect()}
    assert got == {("eval/rouge1", 0.25, "r", 1), ("eval/rouge2", 0.5, "r", 1)}
    results = spark.createDataFrame([(1, "a\nb", "s", "o"), (2, "é", "", None)], PREDICTION)
    io.write_results_json(results, f"{tmp_path}/j")
    back = io.read_results_json(spark, f"{tmp_path}/j", PREDICTION)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, results.collect()))


def test_phrases_and_responses(spark, tmp_path):
    (tmp_path / "newsq").write_text(" war \npeace\nwar\n\n")
    (tmp_path / "done").write_text("peace\n")
    queue = io.read_phrases(spark, f"{tmp_path}/newsq")
    done = io.read_phrases(spark, f"{tmp_path}/done")
    assert [r["value"] for r in curate.pending_queries(queue, done).collect()] == ["war"]
    raw = spark.createDataFrame([("q", '{"status":"ok","articles":[{"title":"t"}]}')], "query string, json string")
    raw.write.json(f"{tmp_path}/raw")
    assert curate.flatten_articles(io.read_responses(spark, f"{tmp_path}/raw")).first()["title"] == "t"
