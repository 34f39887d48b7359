"""Repeated byte strings of the corpus, by distributed prefix doubling.

Full doubling sorts every position of the corpus once for each offset.  Here a
position takes part only while its rank is shared:

1. a 50-byte window is first ranked by the least of its 25-byte grams, the same
   wherever the window stands; neighbouring windows mostly have one and form a
   run; windows whose rank stands in one document only drop out;
2. runs left are reranked by the 75 bytes from their begin, which hold all their
   windows: a rank shared with a smaller id settles them all;
3. the windows still open are ranked by the least of their 40-byte grams, again
   a run at a time; those whose rank stands in one document only drop out;
4. the windows left are reranked by their 50 bytes.

A rank is a hash of its bytes (40 bits for the first and third, which only
exclude; 64 for the others).  Each unit (some documents) sends its sorted distinct ranks,
packed, to the rank's range; there they meet those of all other units, and one
bit a rank goes back.  A rank comes once from a unit, however many of its
documents hold it, so no string is a hot key.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newscorpus.llm.common import named, saved
from newscorpus.sources.scratch import new_path

#: Bytes of documents that are packed into one unit.
UNIT_BYTES = 4 << 20
#: Bytes of text whose ranks meet in one group.
RANGE_BYTES = 16 << 20
#: Bytes hashed at once.
SEGMENT = 1 << 19

#: Bits less of the ranks that only exclude: 40 are left, so few meet by chance in a large corpus.
_LESS = np.uint64(24)
_STEP = 0x9E3779B97F4A7C15


class Unit:
    """Some documents as one buffer: ``start`` and ``end`` of each, and its id."""

    def __init__(self, ids: np.ndarray, sizes: np.ndarray, data: bytes, window: int):
        self.ids, self.window, self.gram = ids, window, window // 2
        self.long_gram = max(self.gram, window * 4 // 5)
        self.buffer = np.frombuffer(data, np.uint8)
        self.end = np.cumsum(sizes)
        self.start = self.end - sizes
        self.doc = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)

    def fits(self, at: np.ndarray, length: int) -> np.ndarray:
        """Whether the string of ``length`` at ``at`` stays within its document."""
        return at + length <= self.end[self.doc[at]]

    def hashes(self, at: np.ndarray, length: int) -> np.ndarray:
        """64-bit ranks of the strings of ``length`` at the sorted positions ``at``."""
        out = np.zeros(len(at), np.uint64)
        for low in range(0, len(self.buffer), SEGMENT):
            i, j = np.searchsorted(at, (low, low + SEGMENT))
            if i < j:
                sums = _prefix_sums(self.buffer[low : low + SEGMENT + length])
                out[i:j] = _between(sums, at[i:j] - low, length)
        return out

    def runs(self, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(begin, stop, rank) of neighbouring windows of one least gram of ``gram`` bytes, and its rank."""
        span = self.window - gram + 1
        out = [[np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]]
        for low in range(0, len(self.buffer), SEGMENT):
            part = self.buffer[low : low + SEGMENT + self.window - 1]
            if len(part) < self.window:
                continue
            grams = _all_between(_prefix_sums(part), gram)
            least = _sliding(grams, span, np.minimum)
            whole = self.doc[low : low + len(least)] == self.doc[low + self.window - 1 : low + len(part)]
            change = least[1:] != least[:-1]
            begin = np.flatnonzero(whole & np.append(True, change | ~whole[:-1]))
            stop = np.flatnonzero(whole & np.append(change | ~whole[1:], True)) + 1
            for to, values in zip(out, (begin + low, stop + low, least[begin])):
                to.append(values)
        begin, stop, rank = map(np.concatenate, out)
        # a run that goes on in the next segment is one
        first = np.append(True, (begin[1:] != stop[:-1]) | (rank[1:] != rank[:-1])) if len(begin) else np.zeros(0, bool)
        last = np.append(first[1:], True) if len(begin) else first
        return begin[first], stop[last], rank[first]


@functools.cache
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(size, _STEP, np.uint64)
    down = np.full(size, pow(_STEP, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


@functools.cache
def _byte_values() -> np.ndarray:
    return np.random.default_rng(50).integers(1, 2**64, 256, np.uint64, endpoint=False)


def _prefix_sums(part: np.ndarray) -> np.ndarray:
    up = _powers(SEGMENT + 4096)[0]
    out = np.zeros(len(part) + 1, np.uint64)
    values = _byte_values().take(part)
    values *= up[: len(part)]
    np.cumsum(values, out=out[1:])
    return out


def _between(sums: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    return _mixed((sums[at + length] - sums[at]) * _powers(SEGMENT + 4096)[1][at])


def _all_between(sums: np.ndarray, length: int) -> np.ndarray:
    """The same at every place, without picking places."""
    return _mixed((sums[length:] - sums[:-length]) * _powers(SEGMENT + 4096)[1][: len(sums) - length])


def _mixed(h: np.ndarray) -> np.ndarray:
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def _sliding(values: np.ndarray, span: int, pick: np.ufunc) -> np.ndarray:
    """Least or greatest of every ``span`` neighbours, by doubling."""
    out, width = values, 1
    while 2 * width <= span:
        out = pick(out[:-width], out[width:])
        width *= 2
    rest = span - width
    return pick(out[: len(out) - rest], out[rest:]) if rest else out


def _sealed(values: np.ndarray) -> bytes:
    """Compressed byte planes: sorted ranks, and ids of one unit, share high bytes."""
    planes = values.view(np.uint8).reshape(len(values), -1).T
    return zstandard.compress(planes.tobytes(), 1)


def _opened(data: bytes, kind: str) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


class Ranks:
    """The distinct ranks of a unit, by range and rank; each with its least id."""

    def __init__(self, ranks: np.ndarray, ids: np.ndarray, ranges: int):
        group = (ranks % np.uint64(ranges)).astype(np.int64)
        keys = [ranks, group]
        if len(ranks) and int(ranks.max()) < 1 << 40 and ranges < 1 << 23:
            keys = [group << 40 | ranks.view(np.int64)]  # one key sorts faster
        if (ids[1:] < ids[:-1]).any():
            keys = [ids, *keys]
        order = np.lexsort(keys)
        ranks, self._ids = ranks[order], ids[order]
        new = np.append(True, ranks[1:] != ranks[:-1]) if len(ranks) else np.zeros(0, bool)
        self.distinct, self.least = ranks[new], self._ids[new]
        self.group = group[order][new]
        self._of, self._order = np.cumsum(new) - 1, order

    def rows(self, unit: int, width: str, with_ids: bool) -> Iterator[tuple[int, int, bytes, bytes]]:
        edges = np.flatnonzero(np.diff(self.group)) + 1
        for low, high in zip([0, *edges], [*edges, len(self.group)]):
            if low < high:
                ids = _sealed(self.least[low:high].astype("<i8")) if with_ids else b""
                yield int(self.group[low]), unit, _sealed(self.distinct[low:high].astype(width)), ids

    def bits(self, answers) -> np.ndarray:
        """The answers' bits, one for each distinct rank; unasked ranges: False."""
        out = np.zeros(len(self.distinct), bool)
        if answers is not None:
            for a in answers:
                low, high = np.searchsorted(self.group, (a["range"], a["range"] + 1))
                out[low:high] = np.unpackbits(np.frombuffer(a["bits"], np.uint8), count=high - low)
        return out

    def per_entry(self, of_distinct: np.ndarray) -> np.ndarray:
        out = np.zeros(len(self._order), of_distinct.dtype)
        out[self._order] = of_distinct[self._of]
        return out


class Search:
    """What a unit asks in each round, and what follows from the answers."""

    def __init__(self, unit: Unit, ranges: int):
        self.unit, self.ranges = unit, ranges
        self.begin, self.stop, rank = unit.runs(unit.gram)
        self.first = self._ranks(rank >> _LESS, self.begin)

    def _ranks(self, ranks: np.ndarray, at: np.ndarray) -> Ranks:
        return Ranks(ranks, self.unit.ids[self.unit.doc[at]], self.ranges)

    def _shared(self, ranks: Ranks, at: np.ndarray, answers) -> np.ndarray:
        """Entries whose string starts in a document of a smaller id too."""
        elsewhere = ranks.per_entry(ranks.bits(answers))
        return elsewhere | (self.unit.ids[self.unit.doc[at]] > ranks.per_entry(ranks.least))

    def _alive(self, ranks: Ranks, at: np.ndarray, answers) -> np.ndarray:
        """Entries whose rank stands in another unit, or in two documents of this one."""
        differs = self.unit.ids[self.unit.doc[at]] > ranks.per_entry(ranks.least)
        many = np.zeros(len(ranks.distinct), bool)
        many[ranks.per_entry(np.arange(len(many)))[differs]] = True
        return ranks.per_entry(many | ranks.bits(answers))

    def rerank_runs(self, answers) -> Ranks:
        self.alive = self._alive(self.first, self.begin, answers)
        # all windows of a run lie within ``reach`` bytes of its begin
        span = self.unit.window - self.unit.gram + 1
        reach = self.unit.window + span - 1
        fits = (self.stop - self.begin <= span) & self.unit.fits(self.begin, reach)
        self.asked = np.flatnonzero(self.alive & fits)
        at = self.begin[self.asked]
        self.second = self._ranks(self.unit.hashes(at, reach), at)
        del self.first
        return self.second

    def rerank_grams(self, answers) -> Ranks:
        self.settled = np.zeros(len(self.begin), bool)
        self.settled[self.asked] = self._shared(self.second, self.begin[self.asked], answers)
        del self.second
        still = self.alive & ~self.settled
        n = (self.stop - self.begin)[still]
        self.left = np.repeat(self.begin[still], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        # the windows still open, as runs of one least long gram
        begin, _, rank = self.unit.runs(self.unit.long_gram)
        run = np.searchsorted(begin, self.left, "right") - 1
        new = np.append(True, run[1:] != run[:-1]) if len(run) else np.zeros(0, bool)
        self.of_run, self.run_at = np.cumsum(new) - 1, begin[run[new]]
        self.grams = self._ranks(rank[run[new]] >> _LESS, self.run_at)
        return self.grams

    def rerank_windows(self, answers) -> Ranks:
        self.left = self.left[self._alive(self.grams, self.run_at, answers)[self.of_run]]
        del self.grams, self.of_run, self.run_at
        self.third = self._ranks(self.unit.hashes(self.left, self.unit.window), self.left)
        return self.third

    def removed(self, answers) -> np.ndarray:
        """Whether each byte of the unit is covered by a string found."""
        found = self.left[self._shared(self.third, self.left, answers)]
        begin = np.concatenate([self.begin[self.settled], found])
        stop = np.concatenate([self.stop[self.settled] - 1, found]) + self.unit.window
        n = len(self.unit.buffer) + 1
        cover = np.bincount(begin, minlength=n) - np.bincount(stop, minlength=n)
        return np.cumsum(cover)[:-1] > 0


def pack(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(unit, ids, sizes, data): documents packed where they are read."""
    least = -(2**63)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, seal = TaskContext.get().partitionId() << 32, zstandard.ZstdCompressor(3)
        ids, texts, size = [], [], 0

        def unit() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([number], pa.int64()),
                    pa.array([ids], pa.list_(pa.int64())),
                    pa.array([list(map(len, texts))], pa.list_(pa.int32())),
                    pa.array([seal.compress(b"".join(texts))], pa.binary()),
                ],
                ["unit", "ids", "sizes", "data"],
            )

        for batch in batches:
            for key, text in zip(batch.column("id"), batch.column("text")):
                ids.append(least if (k := key.as_py()) is None else k)
                texts.append((text.as_py() or "").encode("utf-8", "replace"))
                size += len(texts[-1])
                if size >= UNIT_BYTES:
                    yield unit()
                    number, ids, texts, size = number + 1, [], [], 0
        if ids:
            yield unit()

    docs = df.select(named(id_col).cast("bigint").alias("id"), named(text_col).alias("text"))
    return docs.mapInArrow(of, "unit bigint, ids array<bigint>, sizes array<int>, data binary")


def _meet(asked: DataFrame, width: str, with_ids: bool) -> DataFrame:
    """(unit, answers): for each rank asked, whether it stands in another unit.

    With ids: whether it stands in another unit under an id smaller than the
    least of the asking unit.
    """

    def of(rows: pd.DataFrame) -> pd.DataFrame:
        ranks = [_opened(r, width) for r in rows["ranks"]]
        sizes = np.array([len(r) for r in ranks])
        every = np.concatenate(ranks)
        if with_ids:
            ids = np.concatenate([_opened(i, "<i8") for i in rows["ids"]])
            order = np.lexsort((ids, every))
        else:
            order = np.argsort(every, kind="stable")
        ordered = every[order]
        new = np.append(True, ordered[1:] != ordered[:-1])
        of_rank = np.cumsum(new) - 1
        yes = np.zeros(len(every), bool)
        if with_ids:
            yes[order] = ids[order][new][of_rank] < ids[order]
        else:
            yes[order] = np.bincount(of_rank)[of_rank] > 1
        parts = np.split(yes, np.cumsum(sizes)[:-1])
        return pd.DataFrame(
            {"unit": rows["unit"], "range": rows["range"], "bits": [np.packbits(p).tobytes() for p in parts]}
        )

    found = asked.groupBy("range").applyInPandas(of, "unit bigint, range int, bits binary")
    return found.groupBy("unit").agg(F.collect_list(F.struct("range", "bits")).alias("answers"))


def repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept) of every row of ``df``.

    Removed is each byte covered by a ``window``-byte string of the text's UTF-8
    that also starts in a document of a smaller id; ``kept`` holds the others.
    Strings never cross documents.  Ids are whole numbers; a NULL id is smaller
    than all others, rows of one id remove nothing from each other, and each
    keeps its row.  NULL, empty and shorter texts keep all; an empty table gives
    no rows.
    """
    spark = df.sparkSession
    size = df.agg(F.coalesce(F.sum(F.octet_length(named(text_col))), F.lit(0))).first()[0]
    ranges = max(8, -(-size // RANGE_BYTES))
    shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"units_{uuid.uuid4().hex}"
    # bucketed by unit: the texts stay where they are while answers come to them
    pack(df, id_col, text_col).write.format("parquet").bucketBy(max(shuffles, ranges // 4), "unit").option(
        "path", new_path(spark, name)
    ).saveAsTable(name)
    units = spark.table(name)

    def work(step: Callable, answers: list[DataFrame], schema: str) -> DataFrame:
        joined = units
        for k, a in enumerate(answers):
            joined = joined.join(a.withColumnRenamed("answers", f"a{k}"), "unit", "left")

        def of_unit(row: dict) -> Iterator[pd.DataFrame]:
            # a scope of its own: a unit's arrays are gone before the next one's are made
            data = zstandard.ZstdDecompressor().decompress(row["data"])
            unit = Unit(np.asarray(row["ids"], np.int64), np.asarray(row["sizes"], np.int64), data, window)
            yield from step(Search(unit, ranges), row)

        def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for row in batch.to_dict("records"):
                    yield from of_unit(row)

        return joined.mapInPandas(of, schema)

    asked = "range int, unit bigint, ranks binary, ids binary"

    def frame(rows) -> Iterator[pd.DataFrame]:
        yield pd.DataFrame(list(rows), columns=["range", "unit", "ranks", "ids"])

    def first(search: Search, row: dict):
        return frame(search.first.rows(row["unit"], "<u8", False))

    def second(search: Search, row: dict):
        return frame(search.rerank_runs(row["a0"]).rows(row["unit"], "<u8", True))

    def third(search: Search, row: dict):
        search.rerank_runs(row["a0"])
        return frame(search.rerank_grams(row["a1"]).rows(row["unit"], "<u8", False))

    def fourth(search: Search, row: dict):
        search.rerank_runs(row["a0"])
        search.rerank_grams(row["a1"])
        return frame(search.rerank_windows(row["a2"]).rows(row["unit"], "<u8", True))

    def last(search: Search, row: dict):
        search.rerank_runs(row["a0"])
        search.rerank_grams(row["a1"])
        search.rerank_windows(row["a2"])
        gone, unit = search.removed(row["a3"]), search.unit
        rows = []
        for key, low, high in zip(unit.ids.tolist(), unit.start.tolist(), unit.end.tolist()):
            own = gone[low:high]
            spans = int(own[:1].sum() + (own[1:] & ~own[:-1]).sum())
            kept = unit.buffer[low:high][~own].tobytes()
            rows.append((None if key == -(2**63) else key, high - low, int(own.sum()), spans, kept))
        yield pd.DataFrame(rows, columns=["id", "n_bytes", "n_removed", "n_spans", "kept"]).astype({"id": "Int64"})

    a0 = saved(_meet(work(first, [], asked), "<u8", False), "answers")
    a1 = saved(_meet(work(second, [a0], asked), "<u8", True), "answers")
    a2 = saved(_meet(work(third, [a0, a1], asked), "<u8", False), "answers")
    a3 = saved(_meet(work(fourth, [a0, a1, a2], asked), "<u8", True), "answers")
    return work(last, [a0, a1, a2, a3], "id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")
