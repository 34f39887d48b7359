"""SimHash near-duplicates, compared exactly tile by tile."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newscorpus.llm.common import named, saved, texts
from newscorpus.llm.components import components

#: XXH64 seed of a shingle.
SEED = 42
#: A fingerprint is cut into so many parts; their bit counts name its tile.
PARTS = 4
#: Fingerprints of a tile that are compared as one block.
BLOCK = 2048
#: Shingles whose bits are counted at once.
CHUNK = 1 << 16


def simhash(text: str | None, shingle: int) -> int:
    """64-bit fingerprint as an unsigned number; a text without words gives 0."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        pieces: Iterator = iter([words])
        total = 1
    else:
        pieces = zip(*(words[k:] for k in range(shingle)))
        total = len(words) - shingle + 1
    ones = np.zeros(64, np.int64)
    while part := [xxhash.xxh64_intdigest(b" ".join(p), SEED) for p in itertools.islice(pieces, CHUNK)]:
        bits = np.unpackbits(np.array(part, "<u8").view(np.uint8), bitorder="little")
        ones += bits.reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def fingerprint(text: Column, shingle: int) -> Column:
    """Fingerprint of a text as BIGINT (the 64 bits, signed)."""

    @F.pandas_udf("bigint")
    def of(column: pd.Series) -> pd.Series:
        values = np.array([simhash(t, shingle) for t in column], np.uint64)
        return pd.Series(values.view(np.int64))

    return of(text)


def simhash_groups(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 3
) -> DataFrame:
    """(id, fingerprint, root, component_id) of every row.

    Fingerprints link at ``radius`` or fewer differing bits.  ``root`` is the
    component's smallest fingerprint; ``component_id`` its smallest id, NULL if
    all its ids are NULL.  NULL, empty and blank texts have fingerprint 0 and
    link like any other; repeated rows and copies share a fingerprint, of which
    only one is compared.  An empty table gives no rows.
    """
    docs = saved(
        texts(df, id_col, text_col).select("id", fingerprint(F.col("text"), shingle).alias("fp")),
        "fingerprints",
    )
    distinct = saved(docs.groupBy("fp").agg(F.min("id").alias("least")), "distinct")
    root = components(links(distinct.select("fp"), radius))
    placed = distinct.join(root.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "least"
    )
    smallest = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    known = placed.select("fp", "root").join(smallest, "root")
    return docs.join(known, "fp").select(
        "id", F.col("fp").alias("fingerprint"), "root", "component_id"
    )


def links(distinct: DataFrame, radius: int) -> DataFrame:
    """Links (u, v) that join all fingerprints ``fp`` within ``radius`` bits.

    The bit counts of two fingerprints' parts differ by no more, in sum, than
    their bits do: tiles (equal bit counts) farther apart are skipped.  Within
    a block pair only a spanning forest of the links found is returned, so the
    links grow with the fingerprints and not with their pairs.
    """
    width = 64 // PARTS
    tile = [
        F.bit_count(F.shiftrightunsigned("fp", width * k).bitwiseAND(2**width - 1)).cast("int")
        for k in range(PARTS)
    ]
    tiled = distinct.select("fp", F.array(*tile).alias("tile"))
    # at most (64 / PARTS + 1) ** PARTS tiles
    parts = tiled.groupBy("tile").agg(F.ceil(F.count("*") / BLOCK).alias("parts"))
    blocks = (
        tiled.join(F.broadcast(parts), "tile")
        .groupBy("tile", F.pmod(F.xxhash64("fp"), F.col("parts")).alias("part"))
        .agg(F.collect_list("fp").alias("fps"))
    )
    blocks = saved(blocks, "tiles")
    # each pair of tiles once: the step's first difference is not negative
    steps = [
        s
        for s in itertools.product(range(-radius, radius + 1), repeat=PARTS)
        if sum(map(abs, s)) <= radius and s >= (0,) * PARTS
    ]
    step = F.explode(F.array(*[F.array(*map(F.lit, s)) for s in steps])).alias("step")
    left = blocks.select("tile", F.col("part").alias("p"), F.col("fps").alias("a"), step)
    still = F.array_min("step").eqNullSafe(0) & F.array_max("step").eqNullSafe(0)
    left = left.select(
        F.zip_with("tile", "step", lambda x, y: x + y).alias("tile"), still.alias("same"), "p", "a"
    )
    met = left.join(blocks.withColumnRenamed("fps", "b"), "tile").where("not same or p <= part")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield _forest(*_near(list(batch["a"]), list(batch["b"]), radius))

    return met.select("a", "b").mapInPandas(compare, "u bigint, v bigint")


def _near(left: list[np.ndarray], right: list[np.ndarray], radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs within ``radius`` bits, of the block pairs left[k], right[k]."""
    us, vs, small = [], [], []
    waiting = 0
    for a, b in zip(left, right):
        if len(a) * len(b) >= CHUNK:
            i, j = np.nonzero(_distance(a[:, None], b[None, :]) <= radius)
            us.append(a[i])
            vs.append(b[j])
            continue
        small.append((a, b))
        waiting += len(a) * len(b)
        if waiting >= 64 * CHUNK:
            _near_small(small, radius, us, vs)
            small, waiting = [], 0
    if small:
        _near_small(small, radius, us, vs)
    empty = np.zeros(0, np.int64)
    return np.concatenate(us or [empty]), np.concatenate(vs or [empty])


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    # bitwise_count takes the absolute value of signed numbers
    return np.bitwise_count((a ^ b).view(np.uint64))


def _near_small(pairs: list[tuple], radius: int, us: list, vs: list) -> None:
    """All pairs of many small blocks in one pass."""
    a, b = (np.concatenate(side) for side in zip(*pairs))
    la, lb = (np.array([len(x) for x in side]) for side in zip(*pairs))
    times = np.repeat(lb, la)
    u = np.repeat(a, times)
    start = np.repeat(np.repeat(np.cumsum(lb) - lb, la), times)
    within = np.arange(len(u)) - np.repeat(np.cumsum(times) - times, times)
    v = b[start + within]
    near = _distance(u, v) <= radius
    us.append(u[near])
    vs.append(v[near])


def _forest(u: np.ndarray, v: np.ndarray) -> pd.DataFrame:
    """Star links of the groups that the links (u, v) form."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    i, j = at[: len(u)], at[len(u) :]
    i, j = i[i != j], j[i != j]
    label = np.arange(len(nodes))
    while len(i):
        least = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, least)
        np.minimum.at(new, j, least)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = label != np.arange(len(nodes))
    return pd.DataFrame({"u": nodes[moved], "v": nodes[label[moved]]})


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 3) -> DataFrame:
    """``df`` with one row of each component: the one of the smallest id.

    Rows without id come last in that order.  Rows of one id and fingerprint are
    told apart by a digest of their text and then of the whole row; equal rows
    count as one.  Columns of any name stay.
    """
    groups = simhash_groups(df, id_col, text_col, shingle, radius)
    order = F.struct(F.col("id").isNull(), F.col("id"), F.col("fingerprint"))
    best = groups.groupBy("root").agg(F.min(order).alias("w")).select(
        F.struct(F.col("w.id").alias("id"), F.col("w.fingerprint").alias("fp")).alias("kept")
    )
    text = F.coalesce(named(text_col), F.lit(""))
    rows = df.select(F.struct("*").alias("row"), named(id_col).alias("id"), fingerprint(text, shingle).alias("fp"))
    same = F.col("id").eqNullSafe(F.col("kept.id")) & (F.col("fp") == F.col("kept.fp"))
    # maps have no digest; rows that hold one are told apart by their text
    whole = [] if "map<" in df.schema.simpleString() else [F.xxhash64("row")]
    first = F.min_by("row", F.struct(F.sha2(F.coalesce(F.col("row").getField(text_col), F.lit("")), 256), *whole))
    return rows.join(best, same).groupBy("id", "fp").agg(first.alias("row")).select("row.*")
