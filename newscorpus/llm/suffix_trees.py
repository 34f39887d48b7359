"""Repeated word strings of the corpus, by prefix-partitioned suffix trees.

A suffix is a text from one of its words on, cut after ``window`` words.  Its
prefix runs from its first word to the end of the least word gram (by hash)
among those of the window: between ``gram`` and ``window`` words, and the same
wherever the suffix stands.

1. Every unit of documents counts the grams that end its prefixes; a prefix
   whose gram occurs once in the corpus belongs to a leaf at once, and most do.
2. The other suffixes go to the group of their gram, neighbours that share the
   gram as one segment of words.  A group of many grams is sized for memory; a
   gram that alone is too frequent is dealt over several groups.
3. A group builds its subtree from the root down, some words a step; a node
   with one suffix left is a leaf and leaves.  An internal node as deep as the
   window is a repeat: all its suffixes but the first are found.  Words
   themselves are compared here, hashes have only excluded.
4. Suffixes of a dealt gram that are first in their group take the longest
   prefix, the window itself, and meet by its digest, with partial minima.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newscorpus.llm.common import bucketed, saved
from newscorpus.llm.suffixes import pack

#: Bytes of corpus text for which there is one group.
GROUP_BYTES = 4 << 20
#: Segments of one gram beyond which it is dealt over several groups.
GRAM_SEGMENTS = 20_000
#: Rows of one Arrow batch that a task returns.
BATCH = 20_000
#: Offsets of a segment's windows are bits of one number.
LONGEST = 120

_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


class Unit:
    """The words of some documents, end to end."""

    def __init__(self, row: dict, window: int):
        data = zstandard.ZstdDecompressor().decompress(row["data"])
        self.ids, self.window, self.gram = row["ids"], window, max(1, window // 2)
        self.words, sizes, low = [], [], 0
        for size in row["sizes"]:
            own = data[low : low + size].split()  # bytes split at ASCII white space
            self.words += own
            sizes.append(len(own))
            low += size
        self.size = np.array(sizes, np.int64)
        self.end = np.cumsum(self.size)

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(begin, windows, document, gram) of neighbouring windows with one least gram."""
        n, span = len(self.words), self.window - self.gram + 1
        none = np.zeros(0, np.int64)
        if n < self.window:
            return none, none, none, none
        known = {w: xxhash.xxh3_64_intdigest(w) for w in set(self.words)}
        word = np.fromiter(map(known.__getitem__, self.words), np.uint64, n)
        grams = np.zeros(n - self.gram + 1, np.uint64)
        for k in range(self.gram):
            grams = grams * _STEP + word[k : k + len(grams)]
        grams ^= grams >> np.uint64(32)
        grams *= _MIX
        grams ^= grams >> np.uint64(29)
        at = _least_at(grams, span)
        doc = np.repeat(np.arange(len(self.size)), self.size)
        whole = doc[: len(at)] == doc[self.window - 1 :]
        new = np.append(True, (at[1:] != at[:-1]) | ~whole[:-1])
        begin = np.flatnonzero(whole & new)
        stop = np.flatnonzero(whole & np.append(new[1:] | ~whole[1:], True)) + 1
        return begin, stop - begin, doc[begin], grams[at[begin]].view(np.int64)


def _least_at(values: np.ndarray, span: int) -> np.ndarray:
    """Where the first of the least of every ``span`` neighbours is, by doubling."""
    at, width = np.arange(len(values)), 1
    while width < span:
        step = min(width, span - width)
        left, right = at[:-step], at[step:]
        at = np.where(values[left] <= values[right], left, right)
        width += step
    return at


def deep_nodes(codes: np.ndarray, start: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffix, node) of all suffixes below an internal node of ``depth`` words.

    The tree of the suffixes at ``start`` grows downwards: each step parts every
    node by its next words, as many as fit one number, and drops what is alone.
    """
    live, node = np.arange(len(start)), np.zeros(len(start), np.int64)
    symbols, at = int(codes.max(initial=0)) + 1, 0
    while at < depth and len(live):
        key, room = node, (2**62) // (int(node.max()) + 1)
        while at < depth:
            key = key * symbols + codes[start[live] + at]
            at, room = at + 1, room // symbols
            if room <= symbols:
                break
        _, node, n = np.unique(key, return_inverse=True, return_counts=True)
        inner = n[node] > 1
        live, node = live[inner], node[inner]
    return live, node


def _subtree(window: int, rows: pd.DataFrame) -> pd.DataFrame:
    """What a group finds: offsets of segments that repeat, and firsts of dealt grams."""
    words = b" ".join(rows["words"]).split(b" ")
    known = {w: k for k, w in enumerate(dict.fromkeys(words))}
    codes = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
    n = rows["n"].to_numpy(np.int64)
    low = np.cumsum(n + window - 1) - (n + window - 1)
    segment = np.repeat(np.arange(len(n)), n)
    offset = np.arange(len(segment)) - np.repeat(np.cumsum(n) - n, n)
    start = low[segment] + offset
    suffix, node = deep_nodes(codes, start, window)
    key, unit, doc, at = (rows[c].to_numpy(np.int64) for c in ("id", "unit", "doc", "at"))
    of = segment[suffix]
    order = np.lexsort((at[of] + offset[suffix], doc[of], unit[of], key[of], node))
    suffix, node, of = suffix[order], node[order], of[order]
    same = np.append(False, node[1:] == node[:-1])
    first = np.maximum.accumulate(np.where(same, 0, np.arange(len(node))))
    # after the node's least id, or after another place of the same row
    before = np.append(False, (unit[of[1:]] == unit[of[:-1]]) & (doc[of[1:]] == doc[of[:-1]])) & same
    late = (key[of] > key[of[first]]) | before
    found = np.zeros(len(start), bool)
    found[suffix[late]] = True
    bits = np.zeros(len(n), np.int64)
    np.add.at(bits, segment[found], np.int64(1) << offset[found])
    some = np.flatnonzero(bits)
    out = [pd.DataFrame({"unit": unit[some], "at": at[some], "bits": bits[some], "id": key[some], "digest": None})]
    left = np.flatnonzero(~found & rows["dealt"].to_numpy(bool)[segment])
    if len(left):
        digests = [hashlib.sha256(b" ".join(words[s : s + window])).digest() for s in start[left].tolist()]
        of = segment[left]
        out.append(
            pd.DataFrame({"unit": unit[of], "at": at[of] + offset[left], "bits": 1, "id": key[of], "digest": digests})
        )
    return pd.concat(out)


def repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 20) -> DataFrame:
    """(id, n_words, n_removed, n_spans, kept) of every row of ``df``.

    Words are what ASCII white space parts.  Removed is each word covered by
    ``window`` consecutive words of the text that also start earlier: in a row of
    a smaller id, or before in the same row.  ``n_spans`` counts maximal removed
    runs; ``kept`` joins the other words by one space.  Ids are whole numbers; a
    NULL id is smaller than all others; rows of one id remove nothing from each
    other, and each keeps its row.  NULL, empty and shorter texts keep all; an
    empty table gives no rows.  A very long text is a unit of its own and takes
    memory in proportion to it.  Columns of ``df`` besides the two named play no
    part.
    """
    if not 0 < window <= LONGEST:
        raise ValueError(f"a window has 1 to {LONGEST} words")
    units = bucketed(pack(df, id_col, text_col), "unit", "units")
    size = units.select(F.aggregate("sizes", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("n"))
    groups = max(8, -(-(size.agg(F.sum("n")).first()[0] or 0) // GROUP_BYTES))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                gram, n = np.unique(Unit(row, window).runs()[3], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(gram), pa.array(np.full(len(gram), row["unit"])), pa.array(n)], ["gram", "unit", "n"]
                )

    grams = units.mapInArrow(counted, "gram bigint, unit bigint, n bigint")
    # a unit sends a gram once, so a gram's rows are at most as many as the units
    shared = grams.withColumn("total", F.sum("n").over(Window.partitionBy("gram"))).where("total > 1")
    answers = shared.groupBy("unit").agg(F.sort_array(F.collect_list(F.struct("gram", "total"))).alias("shared"))
    answers = answers.select("unit", "shared.gram", "shared.total")

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                gram, total = (batch.column(c)[k].values.to_numpy() for c in ("gram", "total"))
                row = {c: batch.column(c)[k].as_py() for c in ("unit", "ids", "sizes", "data")}
                yield from _segments(Unit(row, window), row["unit"], gram, total, groups)

    sent = units.join(answers, "unit").mapInArrow(segments, _SEGMENT)
    found = sent.groupBy("part", "deal").applyInPandas(
        lambda rows: _subtree(window, rows), "unit bigint, at bigint, bits bigint, id bigint, digest binary"
    )
    found = saved(found, "found")
    firsts = found.where("digest IS NOT NULL")
    least = firsts.groupBy("digest").agg(F.min("id").alias("least"))
    late = firsts.join(least, "digest").where("id > least")
    both = found.where("digest IS NULL").select("unit", "at", "bits").union(late.select("unit", "at", "bits"))
    removed = both.groupBy("unit").agg(F.collect_list(F.struct("at", "bits")).alias("removed"))
    removed = removed.select("unit", "removed.at", "removed.bits")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                at, bits = (batch.column(c)[k].values for c in ("at", "bits"))
                row = {c: batch.column(c)[k].as_py() for c in ("ids", "sizes", "data")}
                none = np.zeros(0, np.int64)
                yield _finished(Unit(row, window), *(none if v is None else v.to_numpy() for v in (at, bits)))

    return units.join(removed, "unit", "left").mapInArrow(
        finish, "id bigint, n_words bigint, n_removed bigint, n_spans bigint, kept string"
    )


_SEGMENT = (
    "part bigint, deal bigint, dealt boolean, unit bigint, doc bigint, id bigint, at bigint, n bigint, words binary"
)


def _segments(
    unit: Unit, number: int, shared: np.ndarray, total: np.ndarray, groups: int
) -> Iterator[pa.RecordBatch]:
    """The unit's segments whose gram is among the sorted ``shared``."""
    begin, n, doc, gram = unit.runs()
    place = np.minimum(np.searchsorted(shared, gram), len(shared) - 1)
    keep = np.flatnonzero(shared[place] == gram)
    begin, n, doc, gram, total = begin[keep], n[keep], doc[keep], gram[keep], total[place[keep]]
    parts = -(-total // GRAM_SEGMENTS)
    spread = xxhash.xxh3_64_intdigest(number.to_bytes(8, "little")) >> 1
    deal = np.where(parts > 1, 1 + spread % parts, 0)
    ids = np.array([-(2**63) if i is None else i for i in unit.ids], np.int64)
    for low in range(0, len(begin), BATCH):
        own = slice(low, low + BATCH)
        text = [
            b" ".join(unit.words[b:e])
            for b, e in zip(begin[own].tolist(), (begin[own] + n[own] + unit.window - 1).tolist())
        ]
        columns = (gram[own] % groups, deal[own], deal[own] > 0, np.full(len(text), number), doc[own], ids[doc[own]])
        yield pa.RecordBatch.from_arrays(
            [*map(pa.array, (*columns, begin[own], n[own])), pa.array(text, pa.binary())],
            [c.split()[0] for c in _SEGMENT.split(", ")],
        )


def _finished(unit: Unit, at: np.ndarray, bits: np.ndarray) -> pa.RecordBatch:
    """One unit's result rows."""
    change = np.zeros(len(unit.words) + 1, np.int64)
    for offset in range(unit.window):
        hit = at[bits >> offset & 1 > 0] + offset if offset < 63 else at[:0]
        np.add.at(change, hit, 1)
        np.add.at(change, hit + unit.window, -1)
    gone = np.cumsum(change)[:-1] > 0
    rows = []
    for key, low, high in zip(unit.ids, (unit.end - unit.size).tolist(), unit.end.tolist()):
        own, words = gone[low:high], unit.words[low:high]
        n_gone = int(own.sum())
        spans = int(own[:1].sum() + (own[1:] & ~own[:-1]).sum())
        kept = b" ".join(compress(words, (~own).tolist()) if n_gone else words).decode()
        rows.append((None if key == -(2**63) else key, high - low, n_gone, spans, kept))
    kinds = [pa.int64()] * 4 + [pa.string()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)], ["id", "n_words", "n_removed", "n_spans", "kept"]
    )
