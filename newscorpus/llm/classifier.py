"""Quality classifier: boosted trees over statistics of each document."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newscorpus.llm import boosting
from newscorpus.llm.common import named, saved, texts

#: Most labelled rows that the trees are fitted on; of more, a hash picks so many.
FIT_ROWS = 50_000
#: Statistics of a document, in the order of ``statistics``.
FEATURES = (
    "log_bytes", "log_words", "word_length", "capitals", "digits", "spaces", "symbols", "exclaims",
    "commas", "stops", "bars", "beyond_ascii", "entropy", "distinct_words", "top_word",
    "repeated_windows", "odd_endings", "short_words", "longest_word", "line_words", "repeated_lines",
    "ended_lines",
)
_SYMBOLS = np.frombuffer(rb"#*$%&<>{}\^~=_@", np.uint8)
#: Bytes counted at once.
CHUNK = 1 << 22


def statistics(text: str) -> list[float]:
    """FEATURES of one text; shares are of bytes, words, windows or lines."""
    data = text.encode("utf-8", "replace")
    count = np.zeros(256, np.int64)
    for at in range(0, len(data), CHUNK):
        count += np.bincount(np.frombuffer(data[at : at + CHUNK], np.uint8), minlength=256)
    size = max(len(data), 1)
    capitals, small = count[65:91].sum(), count[97:123].sum()
    p = count[count > 0] / size
    words = data.split()
    n = max(len(words), 1)
    often = Counter(words)
    windows = max(len(words) - 2, 0)
    repeated = windows - len(set(zip(words, words[1:], words[2:])))
    lines = [x for x in data.split(b"\n") if x.strip()]
    n_lines = max(len(lines), 1)
    return [
        np.log1p(len(data)),
        np.log1p(len(words)),
        sum(map(len, words)) / n,
        capitals / max(capitals + small, 1),
        count[48:58].sum() / size,
        (count[9:14].sum() + count[32]) / size,
        count[_SYMBOLS].sum() / size,
        (count[33] + count[63]) / size,
        (count[44] + count[58] + count[59]) / size,
        count[46] / size,
        count[124] / size,
        count[128:].sum() / size,
        -(p * np.log2(p)).sum() if len(p) else 0.0,
        len(often) / n,
        max(often.values(), default=0) / n,
        repeated / max(windows, 1),
        sum(w[-1:] in b"!#*$%&|" for w in words) / n,
        sum(len(w) < 3 for w in words) / n,
        np.log1p(max(map(len, words), default=0)),
        np.log1p(len(words) / n_lines),
        1 - len(set(lines)) / n_lines,
        sum(x.rstrip()[-1:] in b".!?" for x in lines) / n_lines,
    ]


def features(text: Column) -> Column:
    @F.pandas_udf("array<double>")
    def of(column: pd.Series) -> pd.Series:
        return pd.Series([np.array(statistics(t), float) for t in column])

    return of(text)


def describe(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, x) of every row: its statistics, saved so that texts are read once."""
    docs = texts(df, id_col, text_col)
    return saved(docs.select("id", features(F.col("text")).alias("x")), "statistics")


def fit(described: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> boosting.Trees:
    """Trees from the labelled rows, FIT_ROWS of them at most, picked by hash.

    Rows without id or label are left out; a label counts once for each row of
    its id.
    """
    known = labels.select(named(id_col).alias("id"), named(label_col).alias("y")).where("y is not null")
    rows = described.join(known, "id")
    share = FIT_ROWS / max(rows.count(), 1)
    if share < 1:
        # a little under the bound, so that the bound itself hardly ever cuts
        picked = F.pmod(F.xxhash64(F.lit("fit"), "id"), F.lit(1 << 20)) < int(share * 0.97 * (1 << 20))
        rows = rows.where(picked).limit(FIT_ROWS)
    # an order of its own: the sums of the histograms do not depend on the fetch
    sample = rows.select("id", "x", "y").toArrow().sort_by("id")
    x = np.array(sample["x"].to_pylist(), float).reshape(-1, len(FEATURES))
    return boosting.fit(x, sample["y"].to_numpy().astype(float))


def score(described: DataFrame, trees: boosting.Trees) -> DataFrame:
    """(id, score) of every row of ``described``.

    NULL and empty texts have statistics of 0 and score like any other; equal
    rows score alike and each keep their row; without labelled rows all score
    0.5; an empty table gives none.
    """

    @F.pandas_udf("double")
    def of(column: pd.Series) -> pd.Series:
        return pd.Series(trees.score(np.stack(column.to_list())) if len(column) else np.zeros(0))

    return described.select("id", of("x").alias("score"))
