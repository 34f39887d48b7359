"""The registered queries: contract, SQL comparison, and the plans they get."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from newscorpus.functions import sql as sqlf
from newscorpus.plans import bindings, catalog, oracle

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the driver's tables")
NO_ORACLE = {"rouge_tokens_stemmed", "rouge_corpus_stemmed"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


def ordered(rows):
    return sorted(rows, key=lambda t: tuple((x is None, str(x)) for x in t))


def test_names_agree():
    assert set(oracle.SQL) == set(catalog.QUERIES) - NO_ORACLE
    assert set(catalog.QUERIES) <= set(entry.queries()) and set(oracle.SQL) <= set(entry.oracle_sql())


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns[:3] == ["source_name", "field", "max_words"] and df.count() > 0


@pytest.mark.parametrize("name", sorted(oracle.SQL))
def test_query_equals_sql(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = [tuple(plain(r[c]) for c in cols) for r in df.collect()]
    cursor = duck.execute(oracle.SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    want = [tuple(plain(r[i]) for i in at) for r in cursor.fetchall()]
    assert ordered(got) == ordered(want)


@pytest.mark.parametrize("name", sorted(NO_ORACLE))
def test_query_without_sql_runs(spark, name):
    assert catalog.QUERIES[name](spark, SF).count() > 0


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name", ["detect_language", "encode_pairs", "chunk_text", "rouge_tokens", "compare_models", "text_lengths"]
)
def test_row_local_queries_do_not_shuffle_rows(spark, name):
    """Apart from spreading a one-file input and the bounded vocabulary subquery."""
    own = plan(catalog.QUERIES[name](spark, SF)).split("Subquery")[0]
    assert own.count("Exchange") == own.count("REPARTITION_BY_NUM")
    assert "Python" not in own


def test_rouge_adds_no_exchange_and_no_python(spark):
    base = plan(bindings.pairs(spark, SF)).count("Exchange")
    scored = plan(catalog.rouge_2(spark, SF))
    assert scored.count("Exchange") == base and "Python" not in scored


def test_dedupe_cuts_groups_before_the_shuffle(spark):
    text = plan(catalog.dedupe_by_text(spark, SF))
    assert "row_number(), 1, Partial" in text and "row_number(), 1, Final" in text


def test_top_words_is_a_top_k_over_partial_counts(spark):
    text = plan(catalog.top_words(spark, SF))
    assert "TakeOrderedAndProject" in text and "partial_count" in text


def test_no_cross_joins(spark):
    for name in ("pad_longest", "length_histogram", "extractive_summary", "run_summary", "daily_curation"):
        text = plan(catalog.QUERIES[name](spark, SF))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_sql_functions(spark):
    sqlf.register(spark)
    got = spark.sql(
        "SELECT word_count(' a b ') w, word_count(NULL) n, rouge_tokens('A-b') t, "
        "ema(array(1D, 2D, 4D), 0.5D) e, ema(CAST(array() AS ARRAY<DOUBLE>), 0.5D) z"
    ).first()
    assert tuple(got) == (2, None, ["a", "b"], [1.0, 1.5, 2.75], [])
    rows = spark.sql(
        "SELECT t.id, c.* FROM VALUES (1, 'a b c'), (2, ''), (3, NULL) AS t(id, x), LATERAL chunk_text(t.x, 2) AS c"
    ).collect()
    assert sorted(map(tuple, rows)) == [(1, 0, "a b"), (1, 1, "c")]


def test_head_sample_is_whole(spark, tmp_path):
    """The head of a training set is its first 2,000 rows."""
    rows = spark.range(2100).selectExpr("id AS doc_id", "'a b' AS text", "'en' AS lang", "'src0' AS source")
    rows.write.parquet(f"{tmp_path}/documents.parquet")
    got = [r["article_id"] for r in catalog.head_sample(spark, str(tmp_path)).collect()]
    assert got == list(range(2000))
