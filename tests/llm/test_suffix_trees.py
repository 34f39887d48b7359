"""Repeated windows of words against a table of all windows."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from newscorpus.llm import queries, suffix_trees, suffixes

LEAST = -(2**63)


def by_hand(rows, window):
    """(id, n_words, n_removed, n_spans, kept) of each row."""
    words = [re.findall(r"[^\x20\x09-\x0D]+", text or "") for _, text in rows]
    places = defaultdict(list)
    for row, (key, _) in enumerate(rows):
        for k in range(len(words[row]) - window + 1):
            places[tuple(words[row][k : k + window])].append((LEAST if key is None else key, row, k))
    gone = [set() for _ in rows]
    for found in places.values():
        for key, row, k in found:
            if any(o < key or (r == row and i < k) for o, r, i in found):
                gone[row] |= set(range(k, k + window))
    return [
        (key, len(w), len(g), sum(k - 1 not in g for k in g), " ".join(x for k, x in enumerate(w) if k not in g))
        for (key, _), w, g in zip(rows, words, gone)
    ]


def corpus(seed, window):
    rng = random.Random(seed)
    vocabulary = ["a", "b", "é", "Über", "x1", "日", "end."]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 4 * window))) for _ in range(30)]
    passage = " ".join(f"p{k}" for k in range(3 * window))
    for k in range(25):
        texts.append(f"own{k} {passage}\n\tmore{k % 3} " + " ".join(passage.split()[: rng.randint(1, 3 * window)]))
    texts += [None, "", " \n\x0b", texts[3], texts[4] + " tail", "same " * 5 * window, "nbsp x \x1c y " * window]
    texts += [" ".join(f"u{k}" for k in range(window - 1)), " ".join(f"v{k}" for k in range(window))] * 2
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    return [*rows, rows[0], rows[0], (None, passage), (7, passage + " " + passage), (7, passage)]


@pytest.mark.parametrize("window", [1, 2, 5, 20])
@pytest.mark.parametrize("unit, gram", [(1 << 22, 20_000), (150, 3)])
def test_repeats(spark, monkeypatch, window, unit, gram):
    monkeypatch.setattr(suffixes, "UNIT_BYTES", unit)
    monkeypatch.setattr(suffix_trees, "GRAM_SEGMENTS", gram)
    monkeypatch.setattr(suffix_trees, "BATCH", 50)
    rows = corpus(window, window)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    df = df.withColumns({c: F.lit("clash") for c in ("id", "unit", "words", "gram", "n", "at", "digest", "_row")})
    got = suffix_trees.repeats(df, window=window)
    found = [tuple(r[c] for c in ("id", "n_words", "n_removed", "n_spans", "kept")) for r in got.collect()]
    assert sorted(found, key=repr) == sorted(by_hand(rows, window), key=repr)


def test_equal_hashes_do_not_remove(spark, monkeypatch):
    """Hashes only exclude: with one hash for all words, words still decide."""
    monkeypatch.setattr(suffix_trees.xxhash, "xxh3_64_intdigest", lambda data: 5)
    rng = np.random.default_rng(3)
    rows = [(k, " ".join(map(str, rng.integers(0, 3, 40)))) for k in range(12)]
    units = [
        suffix_trees.Unit({"ids": [k], "sizes": [len(t)], "data": suffixes.zstandard.compress(t.encode())}, 4)
        for k, t in rows
    ]
    grams = np.sort(np.unique(np.concatenate([u.runs()[3] for u in units])))
    assert len(grams) == 1
    sent = [b for k, u in enumerate(units) for b in suffix_trees._segments(u, k, grams, np.array([9]), 8)]
    found = suffix_trees._subtree(4, suffix_trees.pa.Table.from_batches(sent).to_pandas())
    out = []
    for k, u in enumerate(units):
        own = found[found["unit"] == k]
        out += suffix_trees._finished(u, own["at"].to_numpy(), own["bits"].to_numpy()).to_pylist()
    assert [tuple(r.values()) for r in out] == by_hand(rows, 4)


def test_units_count_their_grams_once(spark, monkeypatch):
    plans, saved = [], suffix_trees.saved

    def noted(df, name):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return saved(df, name)

    monkeypatch.setattr(suffix_trees, "saved", noted)
    df = spark.createDataFrame([(1, "a b c d"), (2, "x a b c")], "doc_id bigint, text string")
    found = {r["id"]: r["kept"] for r in suffix_trees.repeats(df, window=3).collect()}
    assert found == {1: "a b c d", 2: "x"}
    # once to count the grams, once to send segments
    assert [p.count("MapInArrow") for p in plans] == [2]


def test_edges(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert suffix_trees.repeats(empty).count() == 0
    with pytest.raises(ValueError):
        suffix_trees.repeats(empty, window=0)
    long = " ".join(f"w{k % 4000}" for k in range(200_000))
    rows = [(1, long), (2, "only " + " ".join(f"w{k}" for k in range(100, 130)))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r["id"]: r for r in suffix_trees.repeats(df).collect()}
    # the long text repeats itself after 4000 words
    assert found[1]["n_removed"] == 196_000 and found[2]["kept"] == "only"


def test_query(spark, tmp_path):
    text = " ".join(map(str, range(30)))
    rows = [(1, text), (2, f"a {text}")]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = {r["doc_id"]: r for r in queries.op13_suffix_trees(spark, str(tmp_path)).collect()}
    assert found[2]["kept_sha256"] == hashlib.sha256(b"a").hexdigest() and found[1]["n_removed"] == 0
