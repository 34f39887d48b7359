"""Training-set preparation: samples, splits, vocabulary, encoding, padding."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newscorpus.functions import text as tx
from newscorpus.operators import lookup, topn

PAD, END, UNKNOWN, FIRST_WORD = 0, 1, 2, 3
IGNORED_LABEL = -100

#: Accepted spellings of the two text columns.
PAIR_COLUMNS: dict[str, list[str]] = {
    "article": ["article", "Content", "clean_text"],
    "highlights": ["highlights", "Summary"],
}


def head_sample(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """The first n rows along an explicit order, in that order."""
    return topn.first_rows(df, n, order, rank="_rank").orderBy("_rank").drop("_rank")


def nested_samples(df: DataFrame, sizes: Mapping[str, int], order: Sequence[str]) -> DataFrame:
    """The first n rows for every named size, tagged ``sample``; ``rank`` counts from 1."""
    ranked = topn.first_rows(df, max(sizes.values()), order)
    options = F.array(
        *[F.struct(F.lit(k).alias("sample"), F.lit(v).alias("size")) for k, v in sizes.items()]
    )
    return (
        ranked.withColumn("s", F.explode(options))
        .where(F.col("rank") <= F.col("s.size"))
        .withColumn("sample", F.col("s.sample"))
        .drop("s")
    )


def split_train_val(df: DataFrame, key: str, percent: int = 20, seed: int = 42) -> DataFrame:
    """Add ``split`` from a hash of (seed, key), whatever the row order or layout.

    md5 is used because other engines have it too, so the split can be rebuilt.
    """
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    val = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 100 < percent
    return df.withColumn("split", F.when(val, "val").otherwise("train"))


def split_by_modulus(df: DataFrame, key: str, modulus: int = 5) -> DataFrame:
    """Add ``split`` from the key's remainder; every ``modulus``-th key is val."""
    return df.withColumn(
        "split", F.when(F.pmod(F.col(key), F.lit(modulus)) == 0, "val").otherwise("train")
    )


def select_pair_columns(
    df: DataFrame, config: Mapping[str, Sequence[str]] | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """Rename whichever alias is present to ``article`` and ``highlights``."""
    cols = []
    for target, aliases in (config or PAIR_COLUMNS).items():
        present = [a for a in aliases if a in df.columns]
        if not present:
            raise ValueError(f"none of {list(aliases)} is a column")
        cols.append(F.coalesce(*[F.col(a) for a in present]).alias(target))
    return df.select(*keep, *cols)


def add_task_prefix(df: DataFrame, family: Column, col: str = "article") -> DataFrame:
    """T5 models expect a task prefix, the others none."""
    return df.withColumn(
        col,
        F.when(family.startswith("T5"), F.concat(F.lit("summarize: "), F.col(col))).otherwise(
            F.col(col)
        ),
    )


def build_vocab(df: DataFrame, cols: Sequence[str], size: int) -> DataFrame:
    """The ``size`` most frequent words of ``cols`` with ids from 3 up.

    Counting combines map-side, so a frequent word costs one row per task; the
    words are numbered range by range.  Rows come in the order of their ids.
    """
    tokens = F.flatten(F.array(*[F.coalesce(tx.words(F.col(c)), _no_words()) for c in cols]))
    counted = df.select(F.explode(tokens).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    top = topn.first_rows(counted, size, ["n", "word"], descending=["n"], rank="id")
    return top.withColumn("id", (F.col("id") + (FIRST_WORD - 1)).cast("int")).orderBy("id")


def _no_words() -> Column:
    return F.array().cast("array<string>")


def encode(values: Column) -> Column:
    """Ids of a text's words (NULL: not in the vocabulary), closed by the end id."""
    return F.concat(F.transform(values, lambda i: F.coalesce(i, F.lit(UNKNOWN))), F.array(F.lit(END)))


def encode_pairs(
    df: DataFrame,
    vocab: DataFrame,
    max_len: int = 512,
    max_target_len: int = 128,
    article: str = "article",
    highlights: str = "highlights",
    map_words: int = lookup.MAP_WORDS,
) -> DataFrame:
    """Add ``input_ids``, ``attention_mask`` and ``labels``.

    The ``map_words`` most frequent words are a bounded constant, so texts of such
    words are encoded where they are read.  Only if the vocabulary has more, or
    longer ones, the words not found there are joined to the rest: that join
    meets no frequent word.  The vocabulary's size is looked at here, so give a
    table that is stored.
    """
    near = lookup.held(map_words, FIRST_WORD)
    rest = vocab.where(~near)
    joins = not rest.isEmpty()
    held, out = lookup.word_ids(vocab.where(near)), df
    for target, text, length in (
        ("input_ids", article, max_len),
        ("labels", highlights, max_target_len),
    ):
        out = out.withColumn("_ids", held)
        words = F.slice(tx.words(F.col(text)), 1, length - 1)
        ids = F.transform(words, lambda w: lookup.word_id(F.col("_ids"), w))
        if joins:
            missing = F.transform(words, lambda w: F.when(lookup.word_id(F.col("_ids"), w).isNull(), w))
            # settled below the join: neither a text nobody asks for nor the held words pass through it
            out = lookup.join_tokens(
                out.withColumn("_near", ids), F.col(text), missing, rest, "word", "id", "_rest", spent=["_ids"]
            )
            ids = lookup.in_order(F.col("_near"), F.col("_rest"))
        out = out.withColumn(target, encode(ids)).drop("_ids", "_near", "_rest")
    return out.withColumn("attention_mask", F.array_repeat(F.lit(1), F.array_size("input_ids")))


def _pad(ids: Column, length: Column | int, fill: int = PAD) -> Column:
    n = F.lit(length) if isinstance(length, int) else length
    missing = F.greatest(n - F.array_size(ids), F.lit(0))
    return F.concat(ids, F.array_repeat(F.lit(fill), missing))


def pad_fixed(df: DataFrame, lengths: Mapping[str, int]) -> DataFrame:
    """Pad each id column with zeros to its fixed length."""
    return df.withColumns({c: _pad(F.col(c), n) for c, n in lengths.items()})


def pad_longest(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pad each id column to the longest array of the whole set.

    The maximum is a scalar subquery, one number per column.
    """
    longest = df.agg(F.struct(*[F.max(F.array_size(c)).alias(c) for c in cols]).alias("m")).scalar()
    padded = df.withColumn("_m", longest)
    return padded.withColumns({c: _pad(F.col(c), F.col("_m")[c]) for c in cols}).drop("_m")


def decode_ids(
    df: DataFrame, vocab: DataFrame, col: str, name: str = "decoded", map_words: int = lookup.MAP_WORDS
) -> DataFrame:
    """Ids back to text: ignored labels become padding, reserved and unknown ids are dropped.

    As in :func:`encode_pairs`, only ids beyond the first ``map_words`` are joined,
    and only if the vocabulary has such.
    """
    rest = vocab.where(~lookup.held(map_words, FIRST_WORD))
    joins = not rest.isEmpty()
    out = df.withColumn("_words", lookup.id_words(vocab, FIRST_WORD, map_words))
    clean = F.filter(
        F.transform(F.col(col), lambda i: F.when(i == IGNORED_LABEL, PAD).otherwise(i)),
        lambda i: i >= FIRST_WORD,
    )
    words = F.transform(clean, lambda i: F.get(F.col("_words"), i - FIRST_WORD))
    if joins:
        missing = F.transform(clean, lambda i: F.when(F.get(F.col("_words"), i - FIRST_WORD).isNull(), i))
        source = F.array_join(F.transform(F.col(col), lambda i: i.cast("string")), " ", "-")
        out = lookup.join_tokens(
            out.withColumn("_near", words), source, missing, rest, "id", "word", "_rest", spent=["_words"]
        )
        words = lookup.in_order(F.col("_near"), F.col("_rest"))
    return out.withColumn(name, F.array_join(words, " ")).drop("_words", "_near", "_rest")


def chunk_text(df: DataFrame, col: str, max_tokens: int = 512) -> DataFrame:
    """One row per run of at most ``max_tokens`` words; empty text gives none."""
    keep = [c for c in df.columns if c != col]
    return df.select(
        *keep,
        F.posexplode(tx.chunks(F.col(col), max_tokens)).alias("chunk_no", "chunk"),
    )
