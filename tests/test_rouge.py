import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from newscorpus.functions import rouge as rg
from newscorpus.functions.stemming import stem
from newscorpus.operators import evaluate


def dp(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a)):
        for j in range(len(b)):
            t[i + 1][j + 1] = t[i][j] + 1 if a[i] == b[j] else max(t[i][j + 1], t[i + 1][j])
    return t


def dp_hits(ref, pred):
    t, i, j, hits = dp(ref, pred), len(ref), len(pred), set()
    while i and j:
        if ref[i - 1] == pred[j - 1]:
            hits.add(i - 1)
            i, j = i - 1, j - 1
        elif t[i][j - 1] > t[i - 1][j]:
            j -= 1
        else:
            i -= 1
    return hits


def test_bit_parallel_lcs_equals_the_table():
    rng = random.Random(1)
    for _ in range(400):
        a = [rng.choice("abcd") for _ in range(rng.randint(0, 25))]
        b = [rng.choice("abcde") for _ in range(rng.randint(0, 25))]
        assert rg.lcs_length(a, b) == dp(a, b)[-1][-1]
        assert rg.lcs_hits(a, b) == dp_hits(a, b)


def test_rouge_n_equals_counters(spark):
    rng = random.Random(2)
    rows = [
        (i, " ".join(rng.choice("abcde") for _ in range(rng.randint(0, 30))),
         " ".join(rng.choice("abcdf") for _ in range(rng.randint(0, 30))))
        for i in range(150)
    ]
    df = spark.createDataFrame(rows, "pair_id int, prediction string, reference string")
    got = {r["pair_id"]: r for r in evaluate.score_pairs(df, ["rouge1", "rouge2", "rougeL"]).collect()}
    for i, p, r in rows:
        p, r = p.split(), r.split()
        for n in (1, 2):
            cp = Counter(zip(*[p[k:] for k in range(n)]))
            cr = Counter(zip(*[r[k:] for k in range(n)]))
            m = sum((cp & cr).values())
            f = 2 * m / (sum(cp.values()) + sum(cr.values())) if m else 0.0
            assert got[i][f"rouge{n}"]["f1"] == pytest.approx(f)
        m = dp(r, p)[-1][-1]
        assert got[i]["rougeL"]["f1"] == pytest.approx(2 * m / (len(p) + len(r)) if m else 0.0)


@pytest.mark.parametrize(
    "pred, ref, r1, r2, rl, rs",
    [
        ("the cat sat", "the cat sat", 1, 1, 1, 1),
        ("a b", "c d", 0, 0, 0, 0),
        ("", "a b", 0, 0, 0, 0),
        ("a a a", "a", 0.5, 0, 0.5, 0.5),
        ("word", "word", 1, 0, 1, 1),
        ("b\na", "a\nb", 1, 0, 0.5, 1),
    ],
)
def test_goldens(spark, pred, ref, r1, r2, rl, rs):
    df = spark.createDataFrame([(pred, ref)], "prediction string, reference string")
    row = evaluate.score_pairs(df).first()
    assert [row[m]["f1"] for m in evaluate.METRICS] == pytest.approx([r1, r2, rl, rs])


def test_swapping_sides_swaps_precision_and_recall(spark):
    df = spark.createDataFrame([("a b c d", "b d e")], "prediction string, reference string")
    a = evaluate.score_pairs(df).first()
    b = evaluate.score_pairs(df, prediction="reference", reference="prediction").first()
    for m in evaluate.METRICS:
        assert a[m]["precision"] == b[m]["recall"] and a[m]["f1"] == b[m]["f1"]


def test_union_lcs_clips_repeated_tokens():
    # one reference sentence matched by two prediction sentences
    assert rg.union_hits([["w1", "w2", "w3", "w4", "w5"]], [["w1", "w2", "w6", "w7", "w8"], ["w1", "w3", "w8", "w9", "w5"]]) == 4
    assert rg.union_hits([["a", "b"], ["a", "c"]], [["a", "b", "c"]]) == 3


@pytest.mark.parametrize(
    "word, expected",
    [
        # examples of the 1980 paper and the irregular forms
        ("caresses", "caress"), ("ponies", "poni"), ("ties", "tie"), ("cats", "cat"),
        ("feed", "feed"), ("agreed", "agre"), ("plastered", "plaster"), ("motoring", "motor"),
        ("sing", "sing"), ("conflated", "conflat"), ("sized", "size"), ("hopping", "hop"),
        ("falling", "fall"), ("hissing", "hiss"), ("fizzed", "fizz"), ("failing", "fail"),
        ("filing", "file"), ("happy", "happi"), ("relational", "relat"), ("conditional", "condit"),
        ("rational", "ration"), ("digitizer", "digit"), ("operator", "oper"),
        ("feudalism", "feudal"), ("decisiveness", "decis"), ("hopefulness", "hope"),
        ("formality", "formal"), ("sensibility", "sensibl"), ("triplicate", "triplic"),
        ("formative", "form"), ("formalize", "formal"), ("electrical", "electr"),
        ("goodness", "good"), ("revival", "reviv"), ("allowance", "allow"), ("inference", "infer"),
        ("adoption", "adopt"), ("activate", "activ"), ("effective", "effect"), ("probate", "probat"),
        ("rate", "rate"), ("cease", "ceas"), ("controll", "control"), ("roll", "roll"),
        ("news", "news"), ("dying", "die"), ("skies", "sky"), ("geology", "geolog"), ("dies", "die"),
    ],
)
def test_stemmer(word, expected):
    assert stem(word) == expected


def test_stemming_only_long_tokens(spark):
    df = spark.createDataFrame([("Cats was running as dogs did",)], "t string")
    got = df.select(rg.rouge_tokens(F.col("t"), stemmed=True).alias("v")).first()["v"]
    assert got == ["cat", "was", "run", "as", "dog", "did"]


def test_bootstrap_is_repeatable_and_brackets_the_mean(spark):
    rng = random.Random(3)
    df = spark.createDataFrame(
        [(i, (0.0, 0.0, rng.random())) for i in range(300)],
        "pair_id bigint, rouge1 struct<precision:double,recall:double,f1:double>",
    )
    a = evaluate.rouge_bootstrap(df, "pair_id", ["rouge1"], reps=101).first()
    b = evaluate.rouge_bootstrap(df.repartition(3), "pair_id", ["rouge1"], reps=101).first()
    mean = df.agg(F.avg("rouge1.f1")).first()[0]
    assert a["low"] < mean < a["high"]
    assert a["low"] == pytest.approx(b["low"]) and a["high"] == pytest.approx(b["high"])
    weights = evaluate.bootstrap_weights(df.select("pair_id"), "pair_id", 101)
    total = weights.agg(F.sum("weight")).first()[0] / (300 * 101)
    assert total == pytest.approx(1.0, abs=0.02)
    assert weights.agg(F.max("rep")).first()[0] == 100


def test_gen_len(spark):
    df = spark.createDataFrame([([5, 6, 1, 0],), ([1, 0, 0, 0],)], "ids array<int>")
    assert evaluate.gen_len(df, "ids").first()["gen_len"] == 2.0
