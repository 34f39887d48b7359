import random

import pytest
from pyspark.sql import functions as F

from newscorpus.operators import lookup, prep, summarize

PAIRS = [(1, "b a b c", "a zzz"), (2, "b", ""), (3, None, "a")]


@pytest.fixture()
def pairs(spark):
    return spark.createDataFrame(PAIRS, "id int, article string, highlights string")


def test_vocab_order_and_reserved_ids(spark, pairs):
    vocab = [tuple(r) for r in prep.build_vocab(pairs, ["article", "highlights"], 3).collect()]
    assert vocab == [("a", 3, 3), ("b", 3, 4), ("c", 1, 5)]


def test_encode_pad_decode(spark, pairs):
    vocab = prep.build_vocab(pairs, ["article", "highlights"], 3)
    enc = prep.encode_pairs(pairs.na.fill("", ["article"]), vocab, max_len=4, max_target_len=4)
    rows = {r["id"]: r for r in enc.collect()}
    assert rows[1]["input_ids"] == [4, 3, 4, 1]  # cut to max_len - 1, then the end id
    assert rows[1]["attention_mask"] == [1, 1, 1, 1]
    assert rows[1]["labels"] == [3, 2, 1]  # unknown word
    assert rows[2]["labels"] == [1] and rows[3]["input_ids"] == [1]
    fixed = {r["id"]: r for r in prep.pad_fixed(enc, {"labels": 5}).collect()}
    assert fixed[1]["labels"] == [3, 2, 1, 0, 0]
    longest = {r["id"]: r for r in prep.pad_longest(enc, ["input_ids", "labels"]).collect()}
    assert longest[2]["input_ids"] == [4, 1, 0, 0] and longest[2]["labels"] == [1, 0, 0]
    ignored = prep.pad_fixed(enc, {"labels": 5}).withColumn(
        "labels", F.transform("labels", lambda i: F.when(i == 0, -100).otherwise(i))
    )
    decoded = {r["id"]: r["decoded"] for r in prep.decode_ids(ignored, vocab, "labels").collect()}
    assert decoded == {1: "a", 2: "", 3: "a"}


def test_word_table_finds_every_word(spark):
    words = spark.range(5000).select(F.concat(F.lit("w"), "id").alias("word"), F.col("id").cast("int").alias("id"))
    table = lookup.word_ids(words, buckets=64)
    df = words.withColumn("t", table).select("id", lookup.word_id(F.col("t"), F.col("word"), 64).alias("got"))
    assert df.where(F.col("id") != F.col("got")).count() == 0
    assert df.where(F.col("got").isNull()).count() == 0


@pytest.mark.parametrize("map_words", [0, 1, 3, 100])
def test_encoding_is_the_same_on_both_sides_of_the_bound(spark, map_words):
    long = "l" * (lookup.MAP_WORD_BYTES + 1)
    words = ["a", "b", long, "c", "é"]
    vocab = spark.createDataFrame([(w, i) for i, w in enumerate(words, 3)], "word string, id int")
    texts = [f"a {long} zz c a", "", None, "é b", "é b", "zz"]
    df = spark.createDataFrame([(i, t, t) for i, t in enumerate(texts)], "id int, article string, highlights string")
    enc = prep.encode_pairs(df, vocab, max_len=5, max_target_len=3, map_words=map_words)
    got = {r["id"]: (r["input_ids"], r["labels"], r["attention_mask"]) for r in enc.collect()}
    assert got[0] == ([3, 5, 2, 6, 1], [3, 5, 1], [1] * 5)
    assert got[1] == ([1], [1], [1]) and got[2][0] is None
    assert got[3] == got[4] == ([7, 4, 1], [7, 4, 1], [1] * 3) and got[5][0] == [2, 1]
    back = prep.decode_ids(enc, vocab, "input_ids", map_words=map_words)
    assert set(back.columns) == {*enc.columns, "decoded"}
    text = {r["id"]: r["decoded"] for r in back.collect()}
    assert text == {0: f"a {long} c", 1: "", 2: None, 3: "é b", 4: "é b", 5: ""}


def test_samples_and_splits(spark):
    df = spark.range(100).withColumnRenamed("id", "k").repartition(7)
    assert [r["k"] for r in prep.head_sample(df, 3, ["k"]).collect()] == [0, 1, 2]
    n = {r["sample"]: r["count"] for r in prep.nested_samples(df, {"s": 2, "l": 10}, ["k"]).groupBy("sample").count().collect()}
    assert n == {"s": 2, "l": 10}
    a = {tuple(r) for r in prep.split_train_val(df, "k").collect()}
    assert a == {tuple(r) for r in prep.split_train_val(df.coalesce(1), "k").collect()}
    big = prep.split_train_val(spark.range(20_000), "id").where("split = 'val'").count()
    assert 0.18 < big / 20_000 < 0.22


def test_pair_columns_and_prefix(spark):
    df = spark.createDataFrame([("x", "y")], "Content string, Summary string")
    out = prep.select_pair_columns(df)
    assert out.columns == ["article", "highlights"]
    assert prep.add_task_prefix(out, F.lit("T5 Large")).first()["article"] == "summarize: x"
    assert prep.add_task_prefix(out, F.lit("Pegasus CNN")).first()["article"] == "x"
    with pytest.raises(ValueError):
        prep.select_pair_columns(spark.createDataFrame([("x",)], "other string"))


@pytest.mark.parametrize("heavy", [0, 1, 3, 100])
def test_join_by_frequency_is_the_inner_join(spark, heavy):
    rng = random.Random(6)
    rows = spark.createDataFrame([(i, rng.choice("aaaaaabbbcdxyz")) for i in range(300)], "i int, word string")
    table = spark.createDataFrame([("a", 9, 1.0), ("b", 5, 2.0), ("c", 2, 3.0), ("d", 1, 4.0)], "word string, df int, w double")
    got = lookup.join_by_frequency(rows, table, "word", "df", heavy).select("i", "word", "w")
    want = rows.join(table, "word").select("i", "word", "w")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def greedy(sentences, n):
    kept, seen = [], set()
    for k, s in enumerate(sentences):
        own = {tuple(s.split()[i : i + n]) for i in range(len(s.split()) - n + 1)}
        if not own & seen:
            kept.append((k, s))
            seen |= own
    return kept


@pytest.mark.parametrize("n", [1, 2, 3])
def test_block_repeats_is_greedy(spark, n):
    rng = random.Random(8)
    docs = [[" ".join(rng.choice("abc") for _ in range(rng.randint(1, 5))) for _ in range(7)] for _ in range(20)]
    # the second goes for the first; the third shares with the second only, and stays
    docs += [["a b c d", "b c d e f", "d e f g"], [], ["", "..", "x"]]
    df = spark.createDataFrame(list(enumerate(docs)), "id int, s array<string>").union(
        spark.createDataFrame([(99, None)], "id int, s array<string>")
    )
    got = {r["id"]: r["s"] and [tuple(x) for x in r["s"]] for r in summarize.block_repeats(df, "s", n).collect()}
    assert got.pop(99) is None
    assert got == {i: greedy(s, n) for i, s in enumerate(docs)} or {k: v or [] for k, v in got.items()} == {
        i: greedy(s, n) for i, s in enumerate(docs)
    }
    assert n < 3 or [k for k, _ in got[20]] == [0, 2]


def test_block_repeats_adds_no_exchange(spark):
    df = spark.createDataFrame([(1, ["a b c"])], "id int, s array<string>")
    assert "Exchange" not in summarize.block_repeats(df, "s")._jdf.queryExecution().executedPlan().toString()


def test_lead_scores_equal_scoring_each_lead(spark):
    rng = random.Random(9)
    vocabulary = ["a", "b", "C-d", "é", "x1", "...", "a.b.a"]
    rows = [
        (i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 60))), " ".join(rng.choice("abcdx") for _ in range(rng.randint(0, 9))))
        for i in range(30)
    ] + [(90, "", ""), (91, "a", ""), (92, "", "a"), (93, "a a a", "a"), (94, None, "a")]
    df = spark.createDataFrame(rows, "id int, t string, r string")
    sizes = {"m1": 1, "m7": 7, "m40": 40}
    got = summarize.score_leads(df, "t", "r", sizes)
    filled = df.na.fill("")
    leads = {m: summarize.tx.lead(F.col("t"), n) for m, n in sizes.items()}
    want = summarize.score_models(summarize.compare_models(filled, leads, ["r"]), "r")
    as_rows = lambda d: sorted(map(tuple, d.select("model", "rouge1", "rouge2", "n_pairs").collect()))
    assert as_rows(got) == as_rows(want)


def test_extractive_summary_keeps_text_order(spark):
    text = "common common. rare words here. common again. other unique things. common"
    df = spark.createDataFrame([(1, text), (2, "common. common"), (3, ""), (4, "common")], "id int, t string")
    got = {r["id"]: r["summary"] for r in summarize.extractive_summary(df, "id", "t", k=2).collect()}
    assert got[1] == "rare words here. other unique things"
    assert got[3] == ""


def test_plug_in_scorer_and_native_lead_agree(spark):
    rows = [(i, " ".join(f"w{j}" for j in range(i * 7)), "ref") for i in range(30)] + [(99, None, None)]
    df = spark.createDataFrame(rows, "article_id bigint, article string, highlights string")
    plugged = summarize.summarize_corpus(df, lambda: summarize.LeadScorer(10), max_input_words=12)
    native = summarize.lead_summary(df.na.fill(""), "article", 10)
    a = {r["article_id"]: r["summary"] for r in plugged.collect()}
    b = {r["article_id"]: r["summary"] for r in native.collect()}
    assert a == b and len(a) == 31


def test_twelve_variants(spark):
    names = [m for m, _ in summarize.model_variants()]
    assert len(names) == len(set(names)) == 12 and "T5 Base (2k)" in names


def test_held_words_do_not_pass_through_the_join(spark):
    """A row carries its ids through the join, not a copy of the words held in each task."""
    df = spark.createDataFrame([(0, "a b c", "a"), (1, "c", "b c")], "id int, article string, highlights string")
    vocab = spark.createDataFrame([("a", 3), ("b", 4), ("c", 5)], "word string, id int")
    enc = prep.encode_pairs(df, vocab, max_len=5, max_target_len=5, map_words=1)
    back = prep.decode_ids(enc.select("id", "input_ids"), vocab, "input_ids", map_words=1)
    for out, held in ((enc, "_ids"), (back.select("id", "decoded"), "_words")):
        nodes = [out._jdf.queryExecution().optimizedPlan()]
        joined = []
        while nodes:
            node = nodes.pop()
            nodes += [node.children().apply(k) for k in range(node.children().size())]
            if node.nodeName() == "Join":
                joined.append(node.output().mkString(" "))
        assert joined and not any(f" {held}#" in f" {x}" for x in joined)


def test_summary_cuts_terms_once_and_stops_at_k(spark):
    text = "one two three four. one two three five. six seven eight. nine ten eleven. one two three six. x y z"
    df = spark.createDataFrame([(1, text), (2, text + ". q r s"), (3, ""), (4, None)], "id int, t string")
    out = summarize.extractive_summary(df, "id", "t", k=2, no_repeat_ngram=3)
    assert out.columns == ["id", "t", "summary"]
    # the terms are read from the stored rows
    assert "p{L}" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert {r["id"]: len(r["summary"].split(". ")) if r["summary"] else 0 for r in out.collect()} == {1: 2, 2: 2, 3: 0, 4: 0}
    rng = random.Random(7)
    for _ in range(200):
        lines = "\n".join(" ".join(rng.choices("abc", k=rng.randint(0, 6))) for _ in range(8))
        order = rng.sample(range(8), 8)
        for most in range(1, 9):
            assert summarize._greedy(lines, order, 3, most) == summarize._greedy(lines, order, 3)[:most]
