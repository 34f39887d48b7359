"""Language identification with hyperdimensional trigram profiles."""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newscorpus.llm.common import named, texts

#: Dimensions of a vector.
DIMENSIONS = 512
#: Seed of the letters' random vectors.
SEED = 20240229
#: Characters that are handled at once.
CHUNK = 1 << 19
#: Trigram vectors that are made at a time.
BLOCK = 1 << 12
#: Most languages that a model may hold; more is an error.
MAX_LANGUAGES = 2000
UNDETERMINED = "und"


@functools.cache
def _folding() -> np.ndarray:
    """Code point -> lower-case letter, 0 for what is no letter."""
    fold = np.zeros(0x110000, np.int32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            fold[i] = ord(low) if len(low) == 1 else i
    return fold


@functools.lru_cache(maxsize=1 << 16)
def _letter(code: int) -> np.ndarray:
    return np.random.default_rng((SEED, code)).integers(0, 2, DIMENSIONS, np.int8) * 2 - 1


def _bound(letters: np.ndarray, grams: np.ndarray, bits: int) -> np.ndarray:
    """Trigram vectors: the first letter's turned twice, the second's once, the last's as it is."""
    base = np.stack([_letter(int(c)) for c in letters])
    mask = (1 << bits) - 1
    first = np.roll(base, 2, axis=1)[grams >> 2 * bits]
    second = np.roll(base, 1, axis=1)[grams >> bits & mask]
    return (first * second * base[grams & mask]).astype(np.float32)


def _pieces(column) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    """Texts as folded letters, each with a neighbour on both sides, CHUNK characters at a time."""
    fold = _folding()
    rows, parts, size = [], [], 0
    for row, text in enumerate(column):
        for at in range(0, len(text), CHUNK):
            codes = np.frombuffer(
                text[max(at - 1, 0) : at + CHUNK + 1].encode("utf-32-le", "surrogatepass"), "<u4"
            )
            piece = fold[codes]
            if at == 0:
                piece = np.concatenate([[0], piece])
            if at + CHUNK >= len(text):
                piece = np.concatenate([piece, [0]])
            rows.append(row)
            parts.append(piece)
            size += len(piece)
            if size >= CHUNK:
                yield rows, parts
                rows, parts, size = [], [], 0
    if rows:
        yield rows, parts


def _profiles(column) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, gram index, count, gram vectors) of the trigrams around every letter."""
    for rows, parts in _pieces(column):
        codes = np.concatenate(parts)
        letters = np.unique(codes)
        bits = max(1, int(len(letters)).bit_length())
        index = np.zeros(int(letters[-1]) + 1, np.int64)
        index[letters] = np.arange(len(letters))
        small = index[codes]
        owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        middle = np.flatnonzero(codes[1:-1]) + 1
        # a piece's own edges only serve as neighbours
        middle = middle[(owner[middle - 1] == owner[middle]) & (owner[middle + 1] == owner[middle])]
        key = owner[middle] << 3 * bits | small[middle - 1] << 2 * bits | small[middle] << bits | small[middle + 1]
        key, count = np.unique(key, return_counts=True)
        grams, at = np.unique(key & ((1 << 3 * bits) - 1), return_inverse=True)
        # bounded: a block of vectors at a time
        for low in range(0, len(grams), BLOCK):
            block = (at >= low) & (at < low + BLOCK)
            yield (
                np.array(rows)[key[block] >> 3 * bits],
                at[block] - low,
                count[block].astype(np.float32),
                _bound(letters, grams[low : low + BLOCK], bits),
            )


def bundle(column, n: int) -> np.ndarray:
    """One vector a text: the sum of its trigrams' vectors."""
    out = np.zeros((n, DIMENSIONS), np.float32)
    for rows, at, count, vectors in _profiles(column):
        if not len(rows):
            continue
        edges = np.flatnonzero(np.diff(rows)) + 1
        for low, high in zip([0, *edges], [*edges, len(rows)]):
            out[rows[low]] += count[low:high] @ vectors[at[low:high]]
    return out


@dataclass(frozen=True)
class Profiles:
    """One unit vector a language, in the order of their names."""

    languages: tuple[str, ...]
    prototypes: np.ndarray


def train(df: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Profiles:
    """Prototypes from all rows that have a language.

    Bundling is a sum, so tasks add up their texts by language and return one
    vector for each; rows without text add nothing.
    """

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            names, code = np.unique(batch["lang"].to_numpy(str), return_inverse=True)
            sums = np.zeros((len(names), DIMENSIONS))
            for rows, at, count, vectors in _profiles(batch["text"]):
                for k in range(len(names)):
                    own = code[rows] == k
                    weights = np.bincount(at[own], count[own], len(vectors))
                    sums[k] += weights.astype(np.float32) @ vectors
            for name, vector in zip(names, sums):
                total[name] = total.get(name, 0) + vector
        if total:
            yield pd.DataFrame({"lang": list(total), "vector": [v.tolist() for v in total.values()]})

    source = df.where(named(lang_col).isNotNull()).select(
        F.coalesce(named(text_col), F.lit("")).alias("text"), named(lang_col).alias("lang")
    )
    parts = source.mapInPandas(gather, "lang string, vector array<double>")
    sums = parts.select("lang", F.posexplode("vector").alias("k", "x")).groupBy("lang", "k").agg(F.sum("x").alias("x"))
    rows = (
        sums.groupBy("lang")
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "x"))), lambda s: s["x"]).alias("v"))
        .limit(MAX_LANGUAGES + 1)
        .collect()
    )
    if len(rows) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    rows = sorted((r for r in rows if any(r["v"])), key=lambda r: r["lang"])
    vectors = np.array([r["v"] for r in rows]).reshape(len(rows), DIMENSIONS)
    return Profiles(
        tuple(r["lang"] for r in rows),
        (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)).astype(np.float32),
    )


def predict(text: Column, model: Profiles) -> Column:
    """Struct (lang_pred, score) of a text: the nearest prototype and its cosine.

    ``und`` with score 0 for NULL and for texts without a letter, and for all
    texts if nothing was learned; ties go to the first name.  A negative cosine
    scores 0.
    """
    names, prototypes = np.array([*model.languages, UNDETERMINED], object), model.prototypes

    @F.pandas_udf("lang_pred string, score double")
    def of(column: pd.Series) -> pd.DataFrame:
        vectors = bundle(column, len(column))
        norm = np.linalg.norm(vectors, axis=1)
        known = norm > 0
        if not len(prototypes):
            known[:] = False
        best, score = np.full(len(column), len(names) - 1), np.zeros(len(column))
        if known.any():
            cosine = vectors[known] @ prototypes.T / norm[known, None]
            best[known] = cosine.argmax(axis=1)
            score[known] = np.clip(cosine.max(axis=1), 0, 1)
        return pd.DataFrame({"lang_pred": names[best], "score": score})

    return of(text)


def identify(df: DataFrame, model: Profiles, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) of every row; repeated rows each keep theirs."""
    return texts(df, id_col, text_col).select("id", predict(F.col("text"), model).alias("p")).select("id", "p.*")


def keep_identified(df: DataFrame, model: Profiles, text_col: str = "text", at_least: float = 0.0) -> DataFrame:
    """``df`` without the rows whose language stays undetermined or below ``at_least``."""
    guess = predict(F.coalesce(named(text_col), F.lit("")), model)
    marked = df.select(F.struct("*").alias("row"), guess.alias("guess"))
    sure = (F.col("guess.lang_pred") != UNDETERMINED) & (F.col("guess.score") >= at_least)
    return marked.where(sure).select("row.*")
