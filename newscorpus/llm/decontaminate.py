"""Benchmark decontamination by winnowed word k-grams; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newscorpus.llm.common import ascii_lower, named, saved, texts

#: What is no part of a word, after A-Z became a-z.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Largest benchmark side, in bytes, that is broadcast; beyond it the join shuffles.
BROADCAST_BYTES = 64 << 20


def word_list(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(text), SEPARATORS), "")


def winnow(words: DataFrame, length: int, gram: int, out: str, distinct: bool = True) -> DataFrame:
    """Adds ``out``: the fingerprints of ``words``, as hash << 32 | position.

    Of every ``length - gram + 1`` consecutive k-grams the one of the least
    hash is kept, the first on ties.  So two texts that share ``length`` words
    share a fingerprint at the same place within them.  Without ``distinct``
    there is one for each window, in their order.
    """
    # the hash of a gram, on the high half
    hashed = F.transform(
        "words",
        lambda _, i: F.shiftleft(
            F.xxhash64(F.lit(length), F.slice("words", i + 1, gram)).bitwiseAND(0x7FFFFFFF), 32
        )
        + i,
    )
    span = length - gram + 1
    out_df = words.withColumn("_h", F.slice(hashed, 1, F.greatest(F.size("words") - gram + 1, F.lit(0))))
    if span == 1:
        return out_df.withColumnRenamed("_h", out)
    least = F.transform("_h", lambda _, i: F.array_min(F.slice("_h", i + 1, span)))
    kept = F.slice(least, 1, F.greatest(F.size("_h") - span + 1, F.lit(0)))
    return out_df.withColumn(out, F.array_distinct(kept) if distinct else kept).drop("_h")


def decontaminate(
    df: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 10,
    gram: int = 5,
) -> DataFrame:
    """(id, digest, n_words, n_hit, items) of every row of ``df``; digest: XXH64 of its text.

    A window is ``window`` consecutive words of an item; an item of fewer words
    is one window as a whole.  ``n_hit`` counts the words inside any occurrence
    of a window; ``items`` holds the ids, as sorted strings, of the items that
    occur.  Items of one id count once; an item without id makes hits but is
    not listed.  NULL, empty and wordless texts have no words, and such items
    occur nowhere.  Repeated rows each keep their row.  Empty tables on either
    side give no rows and no hits.

    Fingerprint hits are extended to whole windows by comparing the words, so
    equal hashes of different words make no hit.  Texts may be of any length.
    """
    hits, occurrences = _window_hits(
        texts(df, id_col, text_col), texts(benchmark, item_id_col, item_text_col), window, gram
    )
    hits = saved(hits, "window_hits")
    listed = (
        hits.where(F.size("windows") > 0)
        .select(F.col("id").alias("of"), F.col("digest").alias("of_digest"), F.explode("windows").alias("wid"))
        .join(occurrences, "wid")
        .groupBy("of", "of_digest")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    )
    same = F.col("id").eqNullSafe(F.col("of")) & (F.col("digest") == F.col("of_digest"))
    return hits.join(listed, same, "left").select(
        "id", "digest", "n_words", "n_hit", F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.explode(F.sequence(F.lit(1).cast("bigint"), "copies")).alias("_copy"),
    ).drop("_copy")


def _window_hits(docs: DataFrame, items: DataFrame, window: int, gram: int) -> tuple[DataFrame, DataFrame]:
    """Hits of every text, and the items of every window.

    Hits: (id, digest, n_words, copies, n_hit, windows), a row for each id and
    text; ``windows`` names the distinct windows that occur.  Items: (wid, item).
    A document meets each distinct window, however many items and places hold
    it, so neither boilerplate nor one repeated word multiplies the hits.
    """
    items = items.select(F.col("id").cast("string").alias("item"), word_list(F.col("text")).alias("words"))
    items = saved(items.where(F.size("words") > 0), "items")
    short = [
        r[0] for r in items.where(F.size("words") < window).select(F.size("words")).distinct().collect()
    ]  # at most window - 1 numbers
    levels = [(window, gram), *((n, n) for n in sorted(short))]

    docs = docs.select("id", F.xxhash64("text").alias("digest"), word_list(F.col("text")).alias("words"))
    marks = [f"_f{n}" for n, _ in levels]
    side = None
    for (length, k), mark in zip(levels, marks):
        docs = winnow(docs, length, k, mark)
        fits = F.size("words") >= length if length == window else F.size("words") == length
        own = winnow(items.where(fits), length, k, "marks", distinct=False).select(
            "item", "words", F.lit(length).alias("length"),
            # exploded by its bare name, the marks would be computed in a filter as well, anew for each word
            F.posexplode(F.concat("marks", F.array().cast("array<bigint>"))).alias("first", "mark"),
        )
        side = own if side is None else side.union(own)
    words = F.slice("words", F.col("first") + 1, F.col("length"))
    side = side.select(
        "item", "length", words.alias("there"), F.shiftright("mark", 32).alias("hash"),
        (F.col("mark").bitwiseAND(0x7FFFFFFF) - F.col("first")).cast("int").alias("offset"),
    )
    # words hold no space; one sequence of words has one hash and one offset
    side = saved(side.distinct().withColumn("wid", F.sha2(F.array_join("there", " "), 256)), "item_windows")
    occurrences = side.select("wid", "item").where("item is not null")
    side = saved(side.select("wid", "length", "there", "hash", "offset").distinct(), "windows")
    bytes_ = side.agg(F.sum(F.length(F.array_join("there", " ")) * 4 + 256)).first()[0] or 0

    # the mark -1 stands for the row itself
    spread = docs.select(
        "id", "digest", "words", F.explode(F.concat(F.array(F.lit(-1).cast("bigint")), *marks)).alias("mark")
    ).withColumns({
        "hash": F.shiftright("mark", 32),
        "at": F.col("mark").bitwiseAND(0x7FFFFFFF).cast("int"),
        "n": F.size("words"),
    })
    if bytes_ <= BROADCAST_BYTES:
        met = spread.join(F.broadcast(side), "hash", "left").withColumnRenamed("words", "near").withColumn("from", F.lit(0))
    else:
        reach = max(n - k for n, k in levels)
        start = F.greatest(F.col("at") - reach, F.lit(0))
        near = F.slice("words", start + 1, 2 * reach + window)
        spread = spread.select("id", "digest", "n", "mark", "hash", "at", near.alias("near"), start.alias("from"))
        met = spread.where("mark >= 0").join(side, "hash")
        met = met.unionByName(spread.where("mark < 0"), allowMissingColumns=True)
    met = met.where("mark < 0 or offset is not null")
    first = F.col("at") - F.col("offset")
    here = F.slice("near", F.greatest(first - F.col("from"), F.lit(0)) + 1, F.col("length"))
    # no filter on this: it would move below, next to the join, and every mark's row would
    # be kept with all words of its text
    hit = (F.col("mark") >= 0) & (first >= 0) & (here == F.col("there"))
    met = met.select(
        "id", "digest", "n", "wid", "length", first.alias("first"), (F.col("mark") < 0).alias("own"), hit.alias("hit")
    )
    grouped = met.groupBy("id", "digest").agg(
        F.max("n").cast("bigint").alias("n_words"),
        F.count(F.when(F.col("own"), True)).alias("copies"),
        F.collect_set(F.when(F.col("hit"), F.struct("first", "length"))).alias("hits"),
        F.collect_set(F.when(F.col("hit"), F.col("wid"))).alias("windows"),
    )
    covered = F.flatten(F.transform("hits", lambda h: F.sequence(h["first"], h["first"] + h["length"] - 1)))
    n_hit = F.size(F.array_distinct(covered)).cast("bigint")
    return grouped.select("id", "digest", "n_words", "copies", n_hit.alias("n_hit"), "windows"), occurrences


def keep_clean(
    df: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 10,
    gram: int = 5,
) -> DataFrame:
    """``df`` without the rows that hold a benchmark window; columns of any name stay."""
    hits, _ = _window_hits(
        texts(df, id_col, text_col), texts(benchmark, item_id_col, item_text_col), window, gram
    )
    bad = hits.where("n_hit > 0").select(F.struct("id", "digest").alias("bad"))
    rows = df.select(
        F.struct("*").alias("row"), named(id_col).alias("id"),
        F.xxhash64(F.coalesce(named(text_col), F.lit(""))).alias("digest"),
    )
    same = F.col("id").eqNullSafe(F.col("bad.id")) & (F.col("digest") == F.col("bad.digest"))
    return rows.join(bad, same, "left_anti").select("row.*")
