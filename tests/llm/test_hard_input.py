"""Inputs that made operators slow, unrepeatable or fail: repeats, long runs, clashing names."""

import time
import uuid

import pytest
from pyspark.sql import functions as F

from newscorpus.llm import decontaminate, langid, secrets, simhash

UNDERSCORED = "_guess _fp _kept_id _kept_fp _blob _found _bad _bad_digest _h row bad kept text_ id fp of".split()


def with_names(spark, rows):
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    for name in UNDERSCORED:
        df = df.withColumn(name, F.concat(F.lit(name), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    return df


ROWS = [
    (1, "one two three four five six seven eight nine ten eleven"),
    (2, "password = hunter2hunter2 and other plain words in a row"),
    (2, "password = hunter2hunter2 and other plain words in a row"),
    (3, None),
    (None, "a text without id that says very little"),
    (4, ""),
]


def same_columns(df, got):
    assert got.columns == df.columns
    for r in got.collect():
        assert all(r[n] == n + ("" if r["doc_id"] is None else str(r["doc_id"])) for n in UNDERSCORED)
    return sorted((r["doc_id"] or 0) for r in got.select("doc_id").collect())


def test_keep_clean_names_repeats_empty(spark):
    df = with_names(spark, ROWS)
    items = spark.createDataFrame([("i", "Two three four FIVE six seven eight nine ten eleven twelve"), ("j", ROWS[0][1])], "item_id string, text string")
    assert same_columns(df, decontaminate.keep_clean(df, items)) == [0, 2, 2, 3, 4]
    assert decontaminate.keep_clean(df.limit(0), items).count() == 0
    assert decontaminate.keep_clean(df, items.limit(0)).count() == len(ROWS)


def test_keep_one_names_repeats_empty(spark):
    df = with_names(spark, ROWS)
    # NULL and the empty text share fingerprint zero
    assert same_columns(df, simhash.keep_one(df)) == [0, 1, 2, 3]
    assert simhash.keep_one(df.limit(0)).count() == 0


def test_keep_one_is_repeatable(spark):
    """One id, one fingerprint, two texts: the same one stays in any row order."""
    rows = [(1, "Same words here now"), (1, "same WORDS here now"), (1, "same words  here now")]
    kept = {
        simhash.keep_one(spark.createDataFrame(r, "doc_id bigint, text string").coalesce(1)).first()["text"]
        for r in (rows, rows[::-1], rows[1:] + rows[:1])
    }
    assert len(kept) == 1


def test_redacted_names_repeats_empty(spark, tmp_path):
    df = with_names(spark, ROWS)
    ledger = str(tmp_path / uuid.uuid4().hex)
    secrets.commit(df, ledger)
    got = secrets.redacted(df, ledger)
    assert same_columns(df, got) == [0, 1, 2, 2, 3, 4]
    texts = {r["doc_id"]: r["text"] for r in got.collect()}
    assert texts[2] == "[secret] and other plain words in a row" and texts[3] is None and texts[1] == ROWS[0][1]
    assert secrets.redacted(df.limit(0), ledger).count() == 0


def test_keep_identified_names_repeats_empty(spark):
    learn = spark.createDataFrame([("aaa bbb abab", "x"), ("ccc ddd cdcd", "y")], "text string, lang string")
    model = langid.train(learn)
    df = with_names(spark, ROWS)
    assert same_columns(df, langid.keep_identified(df, model, at_least=-1.0)) == [0, 1, 2, 2]
    assert langid.keep_identified(df.limit(0), model).count() == 0


def test_token_rule_is_linear():
    rule = next(r for r in secrets.RULES if r.kind == "jwt")
    start = time.time()
    assert list(rule.spans("eyJaaaaaaaa" * 100_000)) == []
    assert time.time() - start < 5
    text = "x=eyJhbGciOiJI.eyJzdWIiOiIx.abcdefgh_-1 end"
    assert list(rule.spans(text)) == [(2, 39)]


@pytest.mark.parametrize("broadcast", [64 << 20, 0])
def test_one_word_repeated_on_both_sides(spark, monkeypatch, broadcast):
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", broadcast)
    docs = spark.createDataFrame([(1, "spam " * 100_000), (2, "spam " * 9), (3, "a spam b")], "doc_id bigint, text string")
    items = [(k, "spam " * 100_000) for k in "ab"] + [("c", "spam " * 10 + "end"), (None, "spam " * 12)]
    items = spark.createDataFrame(items, "item_id string, text string")
    got = {r["id"]: (r["n_words"], r["n_hit"], r["items"]) for r in decontaminate.decontaminate(docs, items).collect()}
    assert got == {1: (100_000, 100_000, ["a", "b", "c"]), 2: (9, 0, []), 3: (3, 0, [])}


@pytest.mark.parametrize("broadcast", [64 << 20, 0])
def test_boilerplate_items_meet_a_document_once(spark, monkeypatch, broadcast):
    """Two hundred items of one text: each is listed, windows are compared once."""
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", broadcast)
    text = " ".join(f"w{i}" for i in range(30))
    items = spark.createDataFrame([(f"i{k:03}", text) for k in range(200)], "item_id string, text string")
    docs = spark.range(50).select(F.col("id").alias("doc_id"), F.lit(f"lead {text} tail").alias("text"))
    got = decontaminate.decontaminate(docs, items).collect()
    assert len(got) == 50 and {(r["n_hit"], len(r["items"])) for r in got} == {(30, 200)}


def test_pipeline_sends_small_batches_to_python(spark):
    """Ten thousand long texts at once would be held by the JVM and by Python."""
    import corpus_pipeline

    keys = [f"spark.sql.execution.arrow.max{x}PerBatch" for x in ("Records", "Bytes")]
    try:
        docs = spark.createDataFrame([(1, "die Katze und der Hund", "de"), (2, "the cat and the dog", "en")], "doc_id long, text string, lang string")
        assert corpus_pipeline.identify_language(spark, docs, "").count() == 2
        assert [int(spark.conf.get(k)) for k in keys] == [2000, 8 << 20]
        big = spark.range(3000).selectExpr("repeat('x', 10000) AS t").coalesce(1)
        sizes = big.mapInPandas(lambda it: (b.assign(t=str(len(b)))[:1] for b in it), "t string").collect()
        assert max(int(r["t"]) for r in sizes) < 1000
    finally:
        for k in keys:
            spark.conf.unset(k)
