"""ROUGE expressions over one pair per row.

ROUGE-N is a multiset intersection.  Both texts of a pair sit in the same row,
so it is computed there with array expressions: sort the tagged n-grams of both
sides together and count in one pass.  Exploding n-grams and grouping by
(pair, n-gram) would give the same numbers but shuffle several times the corpus.
Only what SQL arrays cannot express well (LCS, stemming) is an Arrow UDF, and
those are row-local too.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newscorpus.functions import text as tx
from newscorpus.functions.stemming import stem

STRINGS = T.ArrayType(T.StringType())


@F.pandas_udf(STRINGS)
def stem_tokens(tokens: pd.Series) -> pd.Series:
    """Stem tokens longer than three letters."""
    return tokens.map(lambda ts: None if ts is None else [stem(t) if len(t) > 3 else t for t in ts])


def rouge_tokens(text: Column, stemmed: bool = False) -> Column:
    """Lower-cased ``[a-z0-9]`` runs, optionally stemmed."""
    tokens = tx.terms(text, unicode_words=False)
    return stem_tokens(tokens) if stemmed else tokens


def overlap(left: Column, right: Column) -> Column:
    """Size of the multiset intersection of two string arrays.

    Every shared value counts once by a set intersection; what is left, the
    repeats of a value on each side, is counted by :func:`_overlap_sorted`.
    """

    def repeats(s: Column) -> Column:
        return F.filter(s, lambda x, i: (i > 0) & (F.get(s, i - 1) == x))

    return tx.let(
        F.struct(F.sort_array(left).alias("l"), F.sort_array(right).alias("r")),
        lambda s: F.size(F.array_intersect(s["l"], s["r"]))
        + _overlap_sorted(repeats(s["l"]), repeats(s["r"])),
    )


def _overlap_sorted(left: Column, right: Column) -> Column:
    """The same by one fold over the sorted union of tagged values.

    The state holds the running value, its count on each side and the total, so
    memory per row is constant.
    """

    def tag(side: int):
        return lambda g: F.struct(g.alias("g"), F.lit(side).alias("s"))

    # sort_array compares natively; array_sort would run a lambda per comparison
    tagged = F.sort_array(F.concat(F.transform(left, tag(0)), F.transform(right, tag(1))))
    start = F.struct(
        F.lit("").alias("g"), F.lit(0).alias("l"), F.lit(0).alias("r"), F.lit(0).alias("m")
    )

    def step(acc: Column, x: Column) -> Column:
        same = acc["g"] == x["g"]
        return F.struct(
            x["g"].alias("g"),
            (F.when(same, acc["l"]).otherwise(0) + (1 - x["s"])).alias("l"),
            (F.when(same, acc["r"]).otherwise(0) + x["s"]).alias("r"),
            # left entries sort first, so a right entry is matched while r < l
            (acc["m"] + F.when(same & (x["s"] == 1) & (acc["r"] < acc["l"]), 1).otherwise(0)).alias(
                "m"
            ),
        )

    return F.aggregate(tagged, start, step, lambda acc: acc["m"].cast("bigint"))


def prf(matched: Column, n_pred: Column, n_ref: Column) -> Column:
    """Struct of precision, recall and F1; zero whenever there is no match."""
    p = F.when(n_pred > 0, matched / n_pred).otherwise(F.lit(0.0))
    r = F.when(n_ref > 0, matched / n_ref).otherwise(F.lit(0.0))
    f = F.when(matched > 0, 2.0 * matched / (n_pred + n_ref)).otherwise(F.lit(0.0))
    return F.struct(p.alias("precision"), r.alias("recall"), f.alias("f1"))


def rouge_n(pred_tokens: Column, ref_tokens: Column, n: int) -> Column:
    """ROUGE-N struct of two token arrays."""
    return tx.let(
        F.struct(
            tx.ngrams(pred_tokens, n).alias("p"),
            tx.ngrams(ref_tokens, n).alias("r"),
        ),
        # a second binding, as prf names the overlap several times
        lambda g: tx.let(
            overlap(g["p"], g["r"]),
            lambda m: prf(m, F.array_size(g["p"]), F.array_size(g["r"])),
        ),
    )


def _positions(tokens: list[str]) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, w in enumerate(tokens):
        masks[w] = masks.get(w, 0) | (1 << i)
    return masks


def _lcs_rows(ref: list[str], pred: list[str]) -> list[int]:
    """Bit-parallel LCS state after each prediction token.

    Bit i of a row is 0 exactly where the LCS of ``ref[:i+1]`` is one longer
    than that of ``ref[:i]``.
    """
    full = (1 << len(ref)) - 1
    masks = _positions(ref)
    row = full
    rows = [row]
    for w in pred:
        u = row & masks.get(w, 0)
        row = ((row + u) | (row - u)) & full
        rows.append(row)
    return rows


def lcs_length(ref: list[str], pred: list[str]) -> int:
    if not len(ref) or not len(pred):
        return 0
    return len(ref) - _lcs_rows(ref, pred)[-1].bit_count()


def lcs_hits(ref: list[str], pred: list[str]) -> set[int]:
    """Reference positions on one LCS; on equal choices step back in the reference."""
    if not len(ref) or not len(pred):
        return set()
    rows = _lcs_rows(ref, pred)
    i, j = len(ref), len(pred)
    # length of the LCS of ref[:i] and pred[:j], kept up to date while walking
    length = i - rows[j].bit_count()
    hits: set[int] = set()
    while i > 0 and j > 0 and length > 0:
        if ref[i - 1] == pred[j - 1]:
            hits.add(i - 1)
            i, j = i - 1, j - 1
            length -= 1
            continue
        up = length - (0 if rows[j] >> (i - 1) & 1 else 1)
        left = i - (rows[j - 1] & ((1 << i) - 1)).bit_count()
        if left > up:
            j, length = j - 1, left
        else:
            i, length = i - 1, up
    return hits


def union_hits(ref_sents: list[list[str]], pred_sents: list[list[str]]) -> int:
    """Clipped number of reference tokens on the union LCS of each sentence."""
    left: dict[str, int] = {}
    right: dict[str, int] = {}
    for side, sents in ((left, ref_sents), (right, pred_sents)):
        for s in sents:
            for w in s:
                side[w] = side.get(w, 0) + 1
    hits = 0
    for r in ref_sents:
        union: set[int] = set()
        for p in pred_sents:
            union |= lcs_hits(r, p)
        for i in sorted(union):
            w = r[i]
            if left[w] > 0 and right.get(w, 0) > 0:
                hits += 1
                left[w] -= 1
                right[w] -= 1
    return hits


@F.pandas_udf(T.LongType())
def lcs_udf(pred: pd.Series, ref: pd.Series) -> pd.Series:
    return pd.Series(
        [
            None if p is None or r is None else lcs_length(list(r), list(p))
            for p, r in zip(pred, ref, strict=True)
        ],
        dtype="Int64",
    )


@F.pandas_udf(T.LongType())
def union_lcs_udf(pred: pd.Series, ref: pd.Series) -> pd.Series:
    return pd.Series(
        [
            None if p is None or r is None else union_hits([list(s) for s in r], [list(s) for s in p])
            for p, r in zip(pred, ref, strict=True)
        ],
        dtype="Int64",
    )


def rouge_l(pred_tokens: Column, ref_tokens: Column) -> Column:
    """ROUGE-L struct of two token arrays."""
    return prf(
        lcs_udf(pred_tokens, ref_tokens), F.array_size(pred_tokens), F.array_size(ref_tokens)
    )


def sentence_tokens(text: Column, stemmed: bool = False) -> Column:
    """One token array per non-empty line."""
    lines = F.array_remove(F.split(text, "\n"), "")
    tokens = F.transform(lines, lambda s: tx.terms(s, unicode_words=False))
    return stem_sentences(tokens) if stemmed else tokens


@F.pandas_udf(T.ArrayType(STRINGS))
def stem_sentences(sents: pd.Series) -> pd.Series:
    return sents.map(
        lambda ss: None
        if ss is None
        else [[stem(t) if len(t) > 3 else t for t in ts] for ts in ss]
    )


def rouge_lsum(pred_sents: Column, ref_sents: Column) -> Column:
    """Summary-level ROUGE-L struct of two arrays of token arrays."""
    return prf(
        union_lcs_udf(pred_sents, ref_sents),
        F.array_size(F.flatten(pred_sents)),
        F.array_size(F.flatten(ref_sents)),
    )
