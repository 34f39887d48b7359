"""Batch summarization and comparison of summarizers."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator, Mapping, Sequence
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newscorpus.functions import text as tx
from newscorpus.operators import evaluate, lookup
from newscorpus.schemas import PREDICTION
from newscorpus.sources import scratch

#: Turns a batch of texts into a batch of summaries.
Scorer = Callable[[list[str]], list[str]]

# Model families, the sizes each was trained at and its task type.
MODEL_CONFIG: dict[str, dict] = {
    "T5 Base": {"type": "t5", "sizes": ["2k", "10k", "50k"]},
    "T5 Large": {"type": "t5", "sizes": ["2k", "10k", "50k"]},
    "Pegasus Base": {
        "type": "pegasus",
        "sizes": ["2k", "10k", "50k"],
    },
    "Pegasus CNN": {
        "type": "pegasus",
        "sizes": ["2k", "10k", "50k"],
    },
}


class LeadScorer:
    """The first words of the text; stands in where no model weights exist."""

    def __init__(self, n_words: int = 128):
        self.n_words = n_words

    def __call__(self, texts: list[str]) -> list[str]:
        return [" ".join(t.split()[: self.n_words]) for t in texts]


def summarize_corpus(
    df: DataFrame,
    load_scorer: Callable[[], Scorer],
    id_col: str = "article_id",
    text: str = "article",
    reference: str = "highlights",
    max_input_words: int | None = None,
) -> DataFrame:
    """Run a plug-in summarizer over every article in Arrow batches.

    ``load_scorer`` is called once per task and its result sees whole batches.
    Python receives the model input and nothing else; ids stay in the JVM.  With
    ``max_input_words``, for a model that takes no more, the input is cut there;
    without it the model gets the whole text.
    """

    @F.pandas_udf("string")
    def summary(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = load_scorer()
        for texts in batches:
            yield pd.Series(scorer(texts.fillna("").tolist()), dtype=object)

    columns = {
        "article_id": F.col(id_col).cast("bigint"),
        "original_text": F.col(text),
        "summary": summary(F.col(text) if max_input_words is None else tx.lead(F.col(text), max_input_words)),
        "original_summary": F.col(reference),
    }
    return df.select(*[columns[f.name].alias(f.name) for f in PREDICTION.fields])


def lead_summary(df: DataFrame, text: str, n_words: int = 128, name: str = "summary") -> DataFrame:
    return df.withColumn(name, tx.lead(F.col(text), n_words))


def sentence_scores(df: DataFrame, id_col: str, text: str) -> DataFrame:
    """Mean tf-idf weight of a sentence's words: (id, pos, score).

    Document frequencies count each word once per document, inside the row.  They
    are joined with the frequent words broadcast and the others shuffled, since a
    common word occurs in a large share of all documents.  The terms are cut once
    and stored, as they are read for the frequencies and again for the scores.
    """
    lines = df.select(F.col(id_col), _term_lines(tx.sentences(F.col(text))).alias("lines"))
    lines = scratch.saved(lines, "terms")
    return _line_scores(lines, id_col, "lines")


def _line_scores(df: DataFrame, id_col: str, lines: str) -> DataFrame:
    """The scores of stored lines of terms, a line for each sentence."""
    # one character as separator: the fast form of split
    distinct = F.array_distinct(F.split(F.replace(F.col(lines), F.lit("\n"), F.lit(" ")), " "))
    frequencies = (
        df.select(F.explode(distinct).alias("word")).where("word != ''").groupBy("word").agg(F.count("*").alias("df"))
    )
    n_docs = df.agg(F.count("*")).scalar()
    idf = frequencies.withColumn("idf", F.ln(n_docs / F.col("df")))
    cut = df.select(id_col, F.posexplode(F.split(F.col(lines), "\n")).alias("pos", "line"))
    tokens = cut.select(id_col, "pos", F.explode(F.split("line", " ")).alias("word")).where("word != ''")
    return (
        lookup.join_by_frequency(tokens, idf, "word", "df")
        .groupBy(id_col, "pos")
        .agg(F.round(F.avg("idf"), 6).alias("score"))
    )


def _term_lines(pieces: Column, unicode_words: bool = True) -> Column:
    """The terms of each piece as one line; a row's lines are one string."""
    lines = F.transform(pieces, lambda s: F.array_join(tx.terms(s, unicode_words=unicode_words), " "))
    return F.array_join(lines, "\n")


def unrepeated(sentences: Column, order: Column, n: int = 3) -> Column:
    """Positions of the sentences to keep, in ``order`` (positions, the best first).

    A greedy choice inside the row: a sentence goes if it shares an n-gram with one
    that was kept, so a dropped sentence blocks no other.  Python gets the row's
    terms as one string and looks at each n-gram once.
    """
    return _unrepeated(_term_lines(sentences), order, n)


def _unrepeated(lines: Column, order: Column, n: int, most: int | None = None) -> Column:
    """:func:`unrepeated` on lines of terms, or only the first ``most`` of its positions."""

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def choose(texts: pd.Series, orders: pd.Series) -> pd.Series:
        return pd.Series([_greedy(t, o, n, most) for t, o in zip(texts, orders, strict=True)], dtype=object)

    return choose(lines, order)


def _greedy(text: str | None, order: Sequence[int] | None, n: int, most: int | None = None) -> list[int] | None:
    if text is None or order is None:
        return None
    lines = text.split("\n")
    seen: set[tuple[str, ...]] = set()
    kept: list[int] = []
    for i in order:
        if len(kept) == most:
            break
        words = lines[i].split()
        grams = set(zip(*(words[k:] for k in range(n))))
        if seen.isdisjoint(grams):
            kept.append(int(i))
            seen |= grams
    return kept


def block_repeats(df: DataFrame, sentences: str, n: int = 3) -> DataFrame:
    """Sentences (an array, best first) without those that repeat an n-gram of a better one kept.

    The array becomes one of structs (pos, sentence).
    """
    order = F.transform(F.col(sentences), lambda _, i: i)
    kept = tx.let(
        F.struct(F.col(sentences).alias("s"), F.col("_kept").alias("at")),
        lambda x: F.transform(
            x["at"], lambda i: F.struct(i.cast("bigint").alias("pos"), F.get(x["s"], i).alias("sentence"))
        ),
    )
    return df.withColumn("_kept", unrepeated(F.col(sentences), order, n)).withColumn(sentences, kept).drop("_kept")


def extractive_summary(
    df: DataFrame,
    id_col: str,
    text: str,
    k: int = 3,
    no_repeat_ngram: int | None = None,
    name: str = "summary",
) -> DataFrame:
    """The k best sentences of each document in text order, joined by ``'. '``.

    A document's scores come back to it as one array; order, repeats and choice
    are worked out in its row.  Rows are stored with their terms, which are cut once
    for scores and repeats.
    """
    sents = tx.sentences(F.col(text))
    cut = scratch.saved(df.withColumn("_lines", _term_lines(sents)), "terms")
    scored = _line_scores(cut, id_col, "_lines")
    best = scored.groupBy(id_col).agg(
        F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("less"), "pos"))).getField("pos").alias("_best")
    )
    joined = cut.join(best, id_col, "left")
    if no_repeat_ngram is not None:
        # a later choice changes no earlier one, so the first k are all that is looked for
        joined = joined.withColumn("_best", _unrepeated(F.col("_lines"), F.col("_best"), no_repeat_ngram, k))
    summary = tx.let(
        F.struct(sents.alias("s"), F.sort_array(F.slice("_best", 1, k)).alias("at")),
        lambda x: F.array_join(F.transform(x["at"], lambda i: F.get(x["s"], i)), ". "),
    )
    return joined.withColumn(name, F.coalesce(summary, F.lit(""))).drop("_best", "_lines")


def model_variants(config: Mapping[str, dict] | None = None) -> list[tuple[str, str]]:
    """(``"Family (size)"``, task type) for every configured variant."""
    return [
        (f"{family} ({size})", spec["type"])
        for family, spec in (config or MODEL_CONFIG).items()
        for size in spec["sizes"]
    ]


def compare_models(
    df: DataFrame, summarizers: Mapping[str, Column], keep: Sequence[str]
) -> DataFrame:
    """Long form: each document once per named summarizer, with its summary.

    The variants are a fixed list, so they are exploded inside the row.
    """
    options = F.array(
        *[F.struct(F.lit(m).alias("model"), c.alias("summary")) for m, c in summarizers.items()]
    )
    return df.select(*keep, F.inline(options))


def compare_models_wide(
    df: DataFrame, summarizers: Mapping[str, Column], keep: Sequence[str]
) -> DataFrame:
    """Wide form: one summary column per named summarizer."""
    return df.select(*keep, *[c.alias(m) for m, c in summarizers.items()])


def score_models(
    compared: DataFrame, reference: str, metrics: Sequence[str] = ("rouge1", "rouge2")
) -> DataFrame:
    """Corpus ROUGE per model."""
    scored = evaluate.score_pairs(compared, metrics, prediction="summary", reference=reference)
    return evaluate.rouge_corpus(scored, metrics, by=["model"])


def score_leads(
    df: DataFrame, text: str, reference: str, sizes: Mapping[str, int], metrics: Sequence[str] = ("rouge1", "rouge2")
) -> DataFrame:
    """Corpus ROUGE-N of lead summaries of several lengths, as :func:`score_models` gives it.

    A shorter lead is a prefix of a longer one, so the text is cut and matched once:
    an n-gram of the longest lead is a match, in every lead that holds it, if the
    reference has it more often than the lead before it.  A lead's matches are
    those that end within it.
    """
    orders, lengths = [int(m.removeprefix("rouge")) for m in metrics], list(sizes.values())

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def scores(leads: pd.Series, references: pd.Series) -> pd.Series:
        rows = zip(leads, references, strict=True)
        return pd.Series([_lead_scores(a, b, lengths, orders) for a, b in rows], dtype=object)

    words = F.slice(tx.words(F.coalesce(F.col(text), F.lit(""))), 1, max(lengths))
    whole = F.array(F.coalesce(F.col(reference), F.lit("")))
    found = scores(_term_lines(words, unicode_words=False), _term_lines(whole, unicode_words=False))
    n = len(metrics)
    each = df.select(found.alias("f1")).select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(model).alias("model"), *[F.get("f1", n * i + j).alias(m) for j, m in enumerate(metrics)])
                    for i, model in enumerate(sizes)
                ]
            )
        )
    )
    return each.groupBy("model").agg(*[F.round(F.avg(m), 4).alias(m) for m in metrics], F.count("*").alias("n_pairs"))


def _lead_scores(lead: str, reference: str, lengths: Sequence[int], orders: Sequence[int]) -> list[float]:
    """F1 of each lead, for each n-gram order; a word is a line of its terms."""
    per_word = [line.split() for line in lead.split("\n")]
    tokens, ref = [t for terms in per_word for t in terms], reference.split()
    ends = list(accumulate(map(len, per_word)))
    n_tokens = [ends[min(size, len(ends)) - 1] for size in lengths]
    columns = []
    for n in orders:
        room = Counter(zip(*(ref[k:] for k in range(n))))
        matched = [0]
        for gram in zip(*(tokens[k:] for k in range(n))):
            matched.append(matched[-1] + (room[gram] > 0))
            room[gram] -= 1
        rest = max(len(ref) - n + 1, 0)
        own = [max(t - n + 1, 0) for t in n_tokens]
        columns.append([2.0 * matched[g] / (g + rest) if matched[g] else 0.0 for g in own])
    return [f1 for row in zip(*columns) for f1 in row]
