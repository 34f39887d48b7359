import random

import pytest
from pyspark.sql import functions as F

from newscorpus import lexicons
from newscorpus.functions import text as tx
from newscorpus.operators import curate, prep, stats


def one(spark, expr, text):
    df = spark.createDataFrame([(text,)], "t string")
    return df.select(expr(F.col("t")).alias("v")).first()["v"]


@pytest.mark.parametrize(
    "text, n", [("", 0), ("a", 1), ("  a \n b  c\n", 3), (" \n ", 0), (None, None)]
)
def test_word_count(spark, text, n):
    assert one(spark, tx.word_count, text) == n


@pytest.mark.parametrize("n_words, sizes", [(0, []), (1, [1]), (512, [512]), (513, [512, 1]), (1024, [512, 512])])
def test_chunk_borders(spark, n_words, sizes):
    text = "  ".join(f"w{i}" for i in range(n_words)) + "\n"
    chunks = one(spark, lambda c: tx.chunks(c, 512), text)
    assert [len(c.split()) for c in chunks] == sizes


def test_chunks_rejoin_to_normalized_text(spark):
    rng = random.Random(7)
    texts = [" ".join(rng.choice(["a", "bb", "c\nd", ""]) for _ in range(rng.randint(0, 60))) for _ in range(40)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    rows = prep.chunk_text(df, "t", 7).collect()
    for i, t in enumerate(texts):
        got = [r["chunk"] for r in sorted((r for r in rows if r["id"] == i), key=lambda r: r["chunk_no"])]
        assert " ".join(got) == " ".join(t.split())
        assert all(len(c.split()) == 7 for c in got[:-1])


def test_ngrams(spark):
    assert one(spark, lambda c: tx.ngrams(tx.words(c), 2), "a b c") == ["a b", "b c"]
    assert one(spark, lambda c: tx.ngrams(tx.words(c), 3), "a b") == []
    assert one(spark, lambda c: tx.ngrams(tx.words(c), 2), "") == []


def test_bigrams_skip_stopwords_within_one_document(spark):
    df = spark.createDataFrame([("the cat of dog",), ("dog cat dog",)], "t string")
    rows = {(r["bigram"], r["n"]) for r in stats.top_bigrams(df, "t").collect()}
    assert rows == {("cat dog", 2), ("dog cat", 1)}


def test_language_ties_and_no_evidence(spark):
    detect = lambda c: tx.detect_language(c, lexicons.STOPWORDS)
    assert one(spark, detect, "the cat is on it") == "en"
    assert one(spark, detect, "der Hund und die Katze") == "de"
    assert one(spark, detect, "the der") == "en"  # tie: the earlier list
    assert one(spark, detect, "xyz 12") is None
    assert one(spark, detect, "") is None
    assert one(spark, detect, None) is None


def test_entities_in_capitals_and_with_accents(spark):
    text = "The NATO met in Zürich, A Łódź I saw McKay Éric; Řím."
    assert one(spark, tx.entities, text) == ["NATO", "Zürich", "Łódź", "McKay Éric", "Řím"]


def test_entities(spark):
    text = "Yesterday Angela Merkel met, Paris, Emmanuel Macron. He left New York today"
    assert one(spark, tx.entities, text) == ["Angela Merkel", "Paris", "Emmanuel Macron", "New York"]


def test_entity_gazetteer(spark):
    df = spark.createDataFrame([("we saw Paris and Rome",), ("we saw Paris",)], "t string")
    gaz = spark.createDataFrame([("Paris", "city")], "entity string, kind string")
    rows = {tuple(r) for r in stats.extract_entities(df, "t", gaz).collect()}
    assert rows == {("Paris", 2, "city"), ("Rome", 1, None)}


def test_first_trigger_wins(spark):
    triggers = [("fire", "disaster"), ("vote", "election")]
    df = spark.createDataFrame([("a vote, then fire",), ("Fire!",), ("calm",), (None,)], "t string")
    rows = {tuple(r) for r in stats.event_type_counts(df, "t", triggers).collect()}
    assert rows == {("election", 1), ("disaster", 1), ("unknown", 2)}


def test_histogram_edges(spark):
    df = spark.createDataFrame([(" ".join("w" * n),) for n in (1, 5, 9, 9)], "t string")
    rows = {(r["bin"], r["n"]) for r in stats.length_histogram(df, "t", bins=4).collect()}
    assert rows == {(0, 1), (2, 1), (3, 2)}
    same = spark.createDataFrame([("a b",), ("c d",)], "t string")
    assert [(r["bin"], r["n"]) for r in stats.length_histogram(same, "t").collect()] == [(0, 2)]


def test_missing_spellings(spark):
    values = [None, "", "None", "NA", "null", "NaN", "N/A", "Unknown", "x"]
    df = spark.createDataFrame([(v,) for v in values], "a string")
    assert {r["a"] for r in curate.drop_missing(df, ["a"]).collect()} == {"Unknown", "x"}


def test_dedupe_keeps_first_and_is_idempotent(spark):
    rows = [(3, "u"), (1, "u"), (2, "u"), (4, None), (5, "v")]
    df = spark.createDataFrame(rows, "id int, url string")
    once = curate.dedupe_keep_first(df, ["url"], ["id"])
    assert {tuple(r) for r in once.collect()} == {(1, "u"), (5, "v")}
    twice = curate.dedupe_keep_first(once, ["url"], ["id"])
    assert {tuple(r) for r in twice.collect()} == {(1, "u"), (5, "v")}


def test_pending_queries(spark):
    queue = spark.createDataFrame([(" a ",), ("a",), ("b",), ("",)], "value string")
    done = spark.createDataFrame([("b ",), ("b",)], "value string")
    assert [r["value"] for r in curate.pending_queries(queue, done).collect()] == ["a"]


def test_page_plan(spark):
    totals = spark.createDataFrame([("a", 99), ("b", 100), ("c", 251), ("d", 9999)], "category string, total bigint")
    rows = curate.page_plan(totals).groupBy("category").agg(F.max("page").alias("p")).collect()
    assert {tuple(r) for r in rows} == {("b", 1), ("c", 2), ("d", 5)}
    rounded_up = curate.page_plan(totals, ceil=True).groupBy("category").agg(F.max("page").alias("p"))
    assert {tuple(r) for r in rounded_up.collect()} == {("a", 1), ("b", 1), ("c", 3), ("d", 5)}


def test_flatten_skips_errors_and_broken_json(spark):
    ok = '{"status":"ok","articles":[{"source":{"id":"i","name":"n"},"title":"t","urlToImage":"p","publishedAt":"2024-01-01"}]}'
    raw = spark.createDataFrame(
        [("q", ok), ("q", '{"status":"error","code":"rateLimited","articles":[{"title":"x"}]}'), ("q", "{oops")],
        "query string, json string",
    )
    rows = curate.flatten_articles(raw).collect()
    assert len(rows) == 1
    assert (rows[0]["source_id"], rows[0]["url_to_image"], rows[0]["published_at"], rows[0]["category"]) == (
        "i", "p", "2024-01-01", "q",
    )


def test_digest_keys_tell_values_apart(spark):
    df = spark.createDataFrame([("a", "bc"), ("ab", "c"), (None, ""), (None, None)], "x string, y string")
    got = [r["d"] for r in df.select(curate.digest("x", "y").alias("d")).collect()]
    assert len(set(got[:3])) == 3 and None not in got[:3] and got[3] is None
