"""Token counts from the pieces of each distinct pre-token."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newscorpus.llm.common import saved, texts
from newscorpus.llm.lexicon import count_pieces, piece_sums


def _load(path: str):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    special = sorted((t.content for t in tokenizer.get_added_tokens_decoder().values()), key=len, reverse=True)
    for t in tokenizer.get_added_tokens_decoder().values():
        if t.lstrip or t.rstrip or t.single_word or t.normalized:
            raise ValueError(f"added token {t.content!r} takes its neighbours into account")
    return tokenizer, special


def _parts(special: list[str]) -> Callable[[str], list[str]]:
    """Cuts a text at the added tokens: those are every second part."""
    if not special:
        return lambda text: [text]
    apart = re.compile("(" + "|".join(map(re.escape, special)) + ")")
    return lambda text: apart.split(text) if apart.search(text) else [text]


#: The byte-level pre-tokenizer's pattern (fixed by its library).
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Code points that every Unicode version classes alike; other texts go to the library.
_SETTLED = re.compile("[^\x00-\u04ff]")


def pre_tokens(path: str) -> Callable[[], Callable[[str], list[str]]]:
    """Cuts texts as the tokenizer at ``path`` does before it merges; drops added tokens."""

    def make():
        import json

        import regex

        tokenizer, special = _load(path)
        parts = _parts(special)
        normalize = tokenizer.normalizer.normalize_str if tokenizer.normalizer else None
        pre = tokenizer.pre_tokenizer.pre_tokenize_str
        with open(path, encoding="utf-8") as f:
            kind = json.load(f)["pre_tokenizer"]
        plain = kind["type"] == "ByteLevel" and kind["use_regex"] and not kind["add_prefix_space"]
        quick = regex.compile(BYTE_LEVEL).findall

        def cut(text: str) -> list[str]:
            out = []
            for part in parts(text)[::2]:
                part = normalize(part) if normalize else part
                if plain and not _SETTLED.search(part):
                    out += quick(part)
                else:
                    out += [part[low:high] for _, (low, high) in pre(part)]
            return out

        return cut

    return make


def token_counts(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens) of every row, as ``tokenizers`` counts whole texts.

    No begin or end is added; added tokens inside a text count one each.
    Every distinct pre-token of the corpus is merged once and only counted.
    NULL and empty texts have no tokens; repeated rows each keep their row; an
    empty table gives none.
    """
    docs = texts(df, id_col, text_col)
    cut = pre_tokens(tokenizer_path)

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokenizer = _load(tokenizer_path)[0]
        pre, merged = tokenizer.pre_tokenizer.pre_tokenize_str, tokenizer.model.tokenize
        for batch in batches:
            pieces = (bytes(p).decode() for p in batch["piece"])
            yield batch.assign(n_pieces=[sum(len(merged(p)) for p, _ in pre(piece)) for piece in pieces])

    def sizes():
        parts = _parts(_load(tokenizer_path)[1])
        return lambda run: [(len(text.encode()), len(parts(text)) // 2) for text in run]

    counted = count_pieces(docs, cut).mapInPandas(merge, "piece binary, n bigint, n_pieces bigint")
    lexicon = saved(counted, "pre_tokens")
    sums = piece_sums(docs, cut, lexicon, ["n_pieces"], sizes, ["n_bytes", "n_added"], bytes.decode)
    return sums.select(
        "id", F.col("n_bytes").cast("bigint").alias("n_bytes"),
        F.round(F.coalesce("total_n_pieces", F.lit(0.0)) + F.col("n_added")).cast("bigint").alias("n_tokens"),
        F.explode(F.sequence(F.lit(1).cast("bigint"), "copies")).alias("_copy"),
    ).drop("_copy")
