"""Sums over a text's pieces of numbers that each distinct piece has once."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newscorpus.llm.common import text_runs

#: Distinct pieces that a task holds before it hands on what it has counted.
HELD_PIECES = 400_000
#: Most pieces that are answered by a broadcast table instead of a join ...
FREQUENT = 150_000
#: ... and the longest of them, in bytes: together they bound the broadcast.
FREQUENT_BYTES = 64
#: Characters of texts that a task takes up together.
RUN_CHARS = 1 << 22
#: Rows of one Arrow batch that a task returns.
BATCH = 100_000

Split = Callable[[], Callable[[str], Iterable[bytes | str]]]
#: The pieces of some texts, one after the other, and how many each text has.
Cut = Callable[[list[str]], tuple[pa.Array, np.ndarray]]


def lower_words(texts: list[str]) -> tuple[pa.Array, np.ndarray]:
    """The words of some texts, A-Z in lower case, cut at once."""
    raw = [text.encode("utf-8", "replace") for text in texts]
    data = np.frombuffer(b" ".join([b"", *raw, b""]).lower(), np.uint8)
    inside = (data != 32) & (data - np.uint8(9) > 4)
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    starts, ends = edges[0::2], edges[1::2]
    offsets = np.cumsum(ends - starts, dtype=np.int64)
    words = pa.Array.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(np.concatenate([[0], offsets])), pa.py_buffer(data[inside])]
    )
    bounds = np.cumsum([0, *(len(r) + 1 for r in raw)])
    return words, np.diff(np.searchsorted(starts, bounds + 1))


def count_cut(docs: DataFrame, cut: Cut) -> DataFrame:
    """(piece, n) as :func:`count_pieces` has them, by pieces that are cut many texts at a time."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            for _, texts in text_runs(batch.column("text"), RUN_CHARS):
                found = cut(texts)[0].value_counts()
                held.append(pa.table({"piece": found.field("values").cast(pa.binary()), "n": found.field("counts")}))
                rows += len(found)
                if rows >= 2 * HELD_PIECES:
                    held = [_added(held)]
                    rows = held[0].num_rows
                    if rows >= HELD_PIECES:
                        yield from held[0].to_batches(BATCH)
                        held, rows = [], 0
        if held:
            yield from _added(held).to_batches(BATCH)
        held.clear()
        pa.default_memory_pool().release_unused()

    parts = docs.select("text").mapInArrow(count, "piece binary, n bigint")
    return parts.groupBy("piece").agg(F.sum("n").alias("n"))


def _added(held: list[pa.Table]) -> pa.Table:
    sums = pa.concat_tables(held).group_by("piece").aggregate([("n", "sum")])
    return pa.table({"piece": sums["piece"].cast(pa.binary()), "n": sums["n_sum"]})


def count_pieces(docs: DataFrame, split: Split) -> DataFrame:
    """(piece, n) over all of ``docs`` (text): tasks count first, then Spark adds up.

    ``split`` makes, once a task, the function that cuts a text into pieces, bytes
    or text (kept as UTF-8).
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, held = split(), Counter()
        for batch in batches:
            for text in batch.column("text"):
                held.update(cut(text.as_py()))
                if len(held) >= HELD_PIECES:
                    yield from _counted(held)
                    held = Counter()
        yield from _counted(held)

    parts = docs.select("text").mapInArrow(count, "piece binary, n bigint")
    return parts.groupBy("piece").agg(F.sum("n").alias("n"))


def _counted(held: Counter) -> Iterator[pa.RecordBatch]:
    pieces, n = list(held), list(held.values())
    for at in range(0, len(n), BATCH):
        yield pa.RecordBatch.from_arrays(
            [pa.array(pieces[at : at + BATCH], pa.binary()), pa.array(n[at : at + BATCH], pa.int64())],
            ["piece", "n"],
        )


def frequent_pieces(lexicon: DataFrame, values: list[str]) -> dict[bytes, tuple]:
    """The values of the most frequent pieces, FREQUENT at most.

    The least count that keeps within the bound is read off a histogram with
    about four bars to each doubling.
    """
    bar = F.floor(F.log2("n") * 4)
    short = lexicon.where(F.octet_length("piece") <= FREQUENT_BYTES)
    bars = short.groupBy(bar.alias("bar")).agg(F.count("*").alias("pieces")).orderBy(F.desc("bar"))
    least, room = None, FREQUENT
    for row in bars.collect():  # 256 at most
        room -= row["pieces"]
        if room < 0:
            break
        least = row["bar"]
    if least is None:
        return {}
    rows = short.where(bar >= least).select("piece", *values).toArrow()
    return dict(zip(rows["piece"].to_pylist(), zip(*(rows[v].to_pylist() for v in values))))


def piece_sums(
    docs: DataFrame,
    split: Split | None,
    lexicon: DataFrame,
    values: list[str],
    more: Callable[[], Callable[[list[str]], list[tuple]]] | None = None,
    more_columns: list[str] = (),
    as_cut: Callable[[bytes], bytes | str] = bytes,
    cut_many: Cut | None = None,
) -> DataFrame:
    """(id, digest, copies, total_<v>.., more..) of every text of ``docs`` (id, text).

    ``total_<v>`` is the sum over the text's pieces of ``lexicon``'s column v
    (double); pieces that the lexicon lacks add nothing.  Frequent pieces are
    looked up where the text is, in a broadcast table of bounded size; only the
    others are joined, one row for each of a text's distinct pieces.  Equal
    rows share a result: ``copies`` says how many there are.  ``more`` makes a
    function that gives further numbers (double) of each of some texts.
    ``as_cut`` turns a piece's bytes into what ``split`` yields.  ``cut_many`` cuts
    many texts at once, instead of ``split``.
    """
    spark = docs.sparkSession
    frequent = frequent_pieces(lexicon, values)
    known = spark.sparkContext.broadcast({as_cut(piece): v for piece, v in frequent.items()})
    n_values, extra = len(values), list(more_columns)
    kind = docs.schema["id"].dataType.simpleString()
    columns = [f"v{k}" for k in range(n_values)]
    schema = f"id {kind}, digest bigint, piece binary, n bigint, copies bigint, " + ", ".join(
        f"`{c}` double" for c in columns + extra
    )

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, table = split() if split else None, known.value
        other = more() if more else None
        rows = _Rows(n_values + len(extra))
        for batch in batches:
            ids, digests = batch.column("id"), batch.column("digest").to_pylist()
            for low, texts in text_runs(batch.column("text"), RUN_CHARS):
                numbers = other(texts) if other else [()] * len(texts)
                if cut_many:
                    own = batch.column("digest")
                    yield from _rows_of(low, texts, cut_many, table, ids, own, n_values, numbers, schema_names)
                    pa.default_memory_pool().release_unused()
                    continue
                for k, text in enumerate(texts, low):
                    sums, rare, times = [0.0] * n_values, [], []
                    for piece, n in Counter(cut(text)).items():
                        found = table.get(piece)
                        if found is None:
                            rare.append(piece)
                            times.append(n)
                        else:
                            for v in range(n_values):
                                sums[v] += found[v] * n
                    # the text's own row: its digest, as a piece, spreads such rows over the join
                    own = digests[k].to_bytes(8, "little", signed=True)
                    rows.add(k, digests[k], [own, *rare], [1, *times], [*sums, *numbers[k - low]])
                    if len(rows.at) >= BATCH:
                        yield rows.batch(ids, schema_names)
            if rows.at:
                yield rows.batch(ids, schema_names)

    schema_names = ["id", "digest", "piece", "n", "copies", *columns, *extra]
    found = docs.select("id", "text", F.xxhash64("text").alias("digest")).mapInArrow(look_up, schema)
    joined = found.join(lexicon.select("piece", *values), "piece", "left")
    rare = F.col("copies") == 0
    sums = joined.groupBy("id", "digest").agg(
        F.sum("copies").alias("copies"),
        *[F.sum(F.when(rare, F.col(v) * F.col("n")).otherwise(F.col(c))).alias(c) for v, c in zip(values, columns)],
        *[F.max(c).alias(c) for c in extra],
    )
    return sums.select(
        "id", "digest", "copies",
        *[(F.col(c) / F.col("copies")).alias(f"total_{v}") for v, c in zip(values, columns)], *extra,
    )


def _rows_of(
    low: int, texts: list[str], cut: Cut, table: dict, ids: pa.Array, digests: pa.Array,
    n_values: int, numbers: list[tuple], names: list[str],
) -> Iterator[pa.RecordBatch]:
    """The rows of some texts, of which ``low`` is the first's index: each one's own, then those of rare pieces."""
    pieces, sizes = cut(texts)
    coded = pieces.dictionary_encode()
    found = [table.get(piece) for piece in coded.dictionary.to_pylist()]
    nothing = (0.0,) * n_values
    value = np.array([f or nothing for f in found], float).reshape(-1, n_values)
    rare = np.array([f is None for f in found], bool)
    # a text's distinct pieces, and how often it has each
    both = np.repeat(np.arange(len(texts), dtype=np.int64) << 32, sizes) | coded.indices.to_numpy()
    both.sort()
    first = np.flatnonzero(np.diff(both, prepend=-1))
    n = np.diff(first, append=len(both))
    text, piece = both[first] >> 32, both[first] & 0xFFFFFFFF
    sums = [np.bincount(text, value[piece, v] * n, len(texts)) for v in range(n_values)]
    all_numbers = [*sums, *np.array(numbers, float).reshape(len(texts), -1).T]
    mine = digests.slice(low, len(texts))
    # a text's own row has its digest as a piece, which spreads such rows over the join
    own = pa.array([d.to_bytes(8, "little", signed=True) for d in mine.to_pylist()], pa.binary())
    ones = pa.array(np.ones(len(texts), np.int64))
    yield pa.RecordBatch.from_arrays(
        [ids.slice(low, len(texts)), mine, own, ones, ones, *map(pa.array, all_numbers)], names
    )
    kept = np.flatnonzero(rare[piece])
    for at in range(0, len(kept), BATCH):
        some = kept[at : at + BATCH]
        place = pa.array(text[some] + low)
        yield pa.RecordBatch.from_arrays(
            [
                ids.take(place),
                digests.take(place),
                coded.dictionary.take(pa.array(piece[some])).cast(pa.binary()),
                pa.array(n[some]),
                pa.array(np.zeros(len(some), np.int64)),
                *[pa.nulls(len(some), pa.float64()) for _ in all_numbers],
            ],
            names,
        )


class _Rows:
    """Rows of one input batch, gathered by column."""

    def __init__(self, n_numbers: int):
        self.n_numbers = n_numbers
        self._clear()

    def _clear(self) -> None:
        self.at, self.digest, self.piece, self.n, self.own, self.numbers = [], [], [], [], [], []

    def add(self, at: int, digest: int, pieces: list[bytes], n: list[int], numbers: list[float]) -> None:
        """A text's rows: the first is its own and has the numbers."""
        self.own.append(len(self.at))
        self.numbers.append(numbers)
        self.at += [at] * len(pieces)
        self.digest += [digest] * len(pieces)
        self.piece += pieces
        self.n += n

    def batch(self, ids: pa.Array, names: list[str]) -> pa.RecordBatch:
        copies = np.zeros(len(self.at), np.int64)
        copies[self.own] = 1
        held = np.zeros((self.n_numbers, len(self.at)))
        held[:, self.own] = np.array(self.numbers).T
        numbers = [pa.array(column, mask=copies == 0) for column in held]
        out = pa.RecordBatch.from_arrays(
            [
                ids.take(pa.array(self.at, pa.int64())),
                pa.array(self.digest, pa.int64()),
                pa.array(self.piece, pa.binary()),
                pa.array(self.n, pa.int64()),
                pa.array(copies),
                *numbers,
            ],
            names,
        )
        self._clear()
        return out
