"""Alignment of two tokenizers' tokens over a corpus, by whitespace-token anchors.

Every text is tokenised whole by both.  A byte offset where tokens of both end
is a shared end; one that space-marked tokens of both follow is an anchor.
Anchors split a document into windows of token ids, mostly a word long, and a
window's alignment depends on its ids only: it is worked out once and kept
under the id tuples.

Documents are packed into units where they are read.  A unit stores each of its
windows once and every document as window numbers; only its distinct id pairs
and their counts are shuffled, to be summed over the corpus, and each unit gets
the sums of its own pairs back.
"""

from __future__ import annotations

import gc
import itertools
import os
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newscorpus.llm.common import bucketed, named

#: Characters of documents that are packed into one unit.
UNIT_CHARS = 4 << 20
#: Characters that are tokenised together.
RUN_CHARS = 1 << 18
#: Chunks whose tokens a task remembers, the first ones.
HELD = 80_000

#: One space between two other characters.  Neither tokenizer joins what stands
#: on its two sides, so both give the same tokens for the parts as for the whole.
_CUT = re.compile(r"(?<=\S) (?=\S)")
_SPACE = "▁"
#: Between the ids of A and of B; no id.
_BETWEEN = b"\xff" * 4


def _byte_level() -> dict[str, int]:
    """Byte of each character of a byte-level vocabulary: printable ones stand for themselves."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


def _merged(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two rising sequences as one, and what stands in both."""
    every = np.concatenate([a, b])
    every.sort(kind="stable")  # merges what is sorted already
    again = every[1:] == every[:-1]
    return every[np.append(True, ~again)], every[1:][again]


class Pair:
    """Two tokenizers: A (``tokenizers``, byte-level) and B (``sentencepiece``)."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        byte, vocabulary = _byte_level(), self.a.get_vocab()
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            known = all(c in byte for c in token)
            self.a_bytes[i] = bytes(byte[c] for c in token) if known else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(_SPACE, " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.cuts = not any(_SPACE in p.lstrip(_SPACE) for p in pieces)
        self.a_size, self.b_size = (np.array([len(t) for t in v]) for v in (self.a_bytes, self.b_bytes))
        self.a_space, self.b_space = (np.array([t[:1] == b" " for t in v]) for v in (self.a_bytes, self.b_bytes))
        self.chunks: dict[str, tuple[bytes, bytes] | None] = {}  # tokens of chunks
        # what an id adds to the text of groups, by what follows it
        a_ids, b_ids = range(len(self.a_bytes)), range(len(self.b_bytes))
        self.written = [f"{i}{c}" for ids, ends in ((a_ids, ",|"), (b_ids, ",;\n")) for i in ids for c in ends]

    def cut(self, text: str) -> list[str]:
        """The chunks of a text, which is what one space each joins."""
        return _CUT.split(text) if self.cuts else [text]

    def tokens(self, texts: list[str]) -> list[tuple[bytes, bytes] | None]:
        """The ids of both (int32 as bytes) for each text; None where bytes differ from the text's."""
        parts = [self.cut(t) for t in texts]
        of = dict.fromkeys(c for part in parts for c in part)
        of = dict(zip(of, self.of_chunks(list(of))))
        out = []
        for part in parts:
            found = [of[c] for c in part]
            out.append(None if None in found else tuple(map(b"".join, zip(*found))))
        return out

    def of_chunks(self, chunks: list[str]) -> list[tuple[bytes, bytes] | None]:
        """The same for each of some distinct chunks; those met first are remembered."""
        new = [c for c in chunks if c not in self.chunks]
        room = max(0, HELD - len(self.chunks))
        self._learn(new)
        out = list(map(self.chunks.__getitem__, chunks))
        for c in new[room:]:
            del self.chunks[c]
        return out

    def _learn(self, new: list[str]) -> None:
        """Tokens of new chunks, those that a space may join taken together."""
        joined, size = [], 0
        for c in new:
            if not self.cuts or c[0].isspace() or c[-1].isspace():
                self._encode([c])
                continue
            joined.append(c)
            size += len(c)
            if size >= RUN_CHARS:
                self._encode(joined)
                joined, size = [], 0
        if joined:
            self._encode(joined)

    def _encode(self, chunks: list[str]) -> None:
        text = " ".join(chunks)
        whole = (" " + text).encode()
        sides = (
            (self.a.encode_batch_fast([" " + text], add_special_tokens=False)[0].ids, self.a_bytes, self.a_size),
            (self.b.encode(text, num_threads=1), self.b_bytes, self.b_size),
        )
        ends, cut = np.cumsum([len(c.encode()) + 1 for c in chunks]), []
        for ids, surface, sizes in sides:
            if b"".join(map(surface.__getitem__, ids)) != whole:
                break
            of = np.array(ids, "<i4")
            at = 4 * (np.searchsorted(np.cumsum(sizes[of]), ends) + 1)
            data, at = of.tobytes(), at.tolist()
            cut.append([data[low:high] for low, high in zip([0, *at], at)])
        if len(cut) == 2:
            self.chunks.update(zip(chunks, zip(*cut)))
        elif len(chunks) == 1:
            self.chunks[text] = None
        else:
            for c in chunks:
                self._encode([c])


class _Numbers(dict):
    """Numbers from 0 in the order of being asked for."""

    def __missing__(self, key) -> int:
        self[key] = number = len(self)
        return number


class Unit:
    """Some documents as numbers of windows, each window once.

    A chunk's ends are anchors, so its windows are its own: chunks are told apart
    as they come, and each distinct one is looked into once.
    """

    def __init__(self, pair: Pair):
        self.pair, self.size = pair, 0
        self.ids: list = []
        #: Numbers of the chunks, those of each document, and how many chunks were looked into.
        self.chunk = _Numbers()
        self.documents: list[np.ndarray] = []
        self.fresh_chunks = 0
        #: Tokens of A and of B, groups and windows of each chunk (-1: of no use), and its windows.
        self.counts: list[np.ndarray] = []
        self.windows: list[np.ndarray] = []
        #: Windows by their ids, those of A and B apart; the fresh ones are aligned after each run.
        self.window: dict[bytes, int] = {}
        self.fresh: list[tuple[bytes, bytes]] = []
        self.groups, self.links, self.n_links = [], [], []

    def add(self, ids: list, texts: list[str]) -> None:
        self.size += sum(map(len, texts))
        self.ids += ids
        for text in texts:
            chunks = self.pair.cut(text) if text else []
            self.documents.append(np.fromiter(map(self.chunk.__getitem__, chunks), np.int32, len(chunks)))
        self._look_into(list(itertools.islice(reversed(self.chunk), len(self.chunk) - self.fresh_chunks))[::-1])
        self.fresh_chunks = len(self.chunk)

    def _look_into(self, chunks: list[str]) -> None:
        tokens = self.pair.of_chunks(chunks)
        counts = np.zeros((len(chunks), 4), np.int64)
        good = np.array([t is not None for t in tokens], bool)
        counts[~good] = -1
        if good.any():
            found = [t for t in tokens if t is not None]
            counts[good, 0], counts[good, 1] = ([len(t[side]) // 4 for t in found] for side in (0, 1))
            counts[good, 2], counts[good, 3], windows = self._windows(found)
            self.windows.append(windows)
        self.counts.append(counts)
        if self.fresh:
            self._align()

    def _windows(self, tokens: list[tuple[bytes, bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(shared ends, number of windows) of each chunk and all their windows, all split at once."""
        a_bytes, b_bytes = (b"".join(side) for side in zip(*tokens))
        a, b = np.frombuffer(a_bytes, "<i4"), np.frombuffer(b_bytes, "<i4")
        a_end, b_end = np.cumsum(self.pair.a_size[a]), np.cumsum(self.pair.b_size[b])
        shared = _merged(a_end, b_end)[1]
        a_at, b_at = np.searchsorted(a_end, shared) + 1, np.searchsorted(b_end, shared) + 1
        # a chunk's end is an anchor as well
        last = np.cumsum([len(t[0]) // 4 for t in tokens])
        anchor = np.zeros(len(shared), bool)
        anchor[np.searchsorted(a_at, last)] = True
        inner = np.flatnonzero(~anchor)
        anchor[inner] = self.pair.a_space[a[a_at[inner]]] & self.pair.b_space[b[b_at[inner]]]
        a_cut, b_cut = a_at[anchor], b_at[anchor]
        numbers, known, fresh = [], self.window, self.fresh
        a_low = b_low = 0
        for a_high, b_high in zip((4 * a_cut).tolist(), (4 * b_cut).tolist()):
            own = (a_bytes[a_low:a_high], b_bytes[b_low:b_high])
            window = _BETWEEN.join(own)
            number = known.get(window)
            if number is None:
                number = known[window] = len(known)
                fresh.append(own)
            numbers.append(number)
            a_low, b_low = a_high, b_high
        n_windows = np.diff(np.searchsorted(a_cut, last) + 1, prepend=0)
        n_groups = np.diff(np.searchsorted(a_at, last) + 1, prepend=0)
        return n_groups, n_windows, np.array(numbers, np.int32)

    def _align(self) -> None:
        """Links and groups of the fresh windows, end to end in one go."""
        a, b = (np.frombuffer(b"".join(side), "<i4").astype(np.int64) for side in zip(*self.fresh))
        a_end, b_end = np.cumsum(self.pair.a_size[a]), np.cumsum(self.pair.b_size[b])
        a_last, b_last = (np.cumsum([len(x) // 4 for x in side]) - 1 for side in zip(*self.fresh))
        # between two neighbouring ends lies the overlap of one token of each
        ends, shared = _merged(a_end, b_end)
        self.links.append(a[np.searchsorted(a_end, ends)] << 32 | b[np.searchsorted(b_end, ends)])
        self.n_links.append(np.diff(np.searchsorted(ends, a_end[a_last]) + 1, prepend=0))
        # a group is written as its ids of A and then those of B
        a_at, b_at = np.searchsorted(a_end, shared) + 1, np.searchsorted(b_end, shared) + 1
        a_mark, b_mark = 2 * a, 2 * len(self.pair.a_bytes) + 3 * b
        a_mark[a_at - 1] += 1
        b_mark[b_at - 1] += 1
        b_mark[b_last] += 1
        order = np.empty(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + np.repeat(np.append(0, b_at[:-1]), np.diff(a_at, prepend=0))] = a_mark
        order[np.arange(len(b)) + np.repeat(a_at, np.diff(b_at, prepend=0))] = b_mark
        self.groups.append("".join(map(self.pair.written.__getitem__, order.tolist())))
        self.fresh.clear()

    def _per_document(self) -> tuple[np.ndarray, np.ndarray]:
        """Counts of each document, and the window numbers of all, end to end."""
        of_chunk = np.concatenate([np.zeros((0, 4), np.int64), *self.counts])
        windows = np.concatenate([np.zeros(0, np.int32), *self.windows])
        low = np.cumsum(np.maximum(of_chunk[:, 3], 0)) - np.maximum(of_chunk[:, 3], 0)
        counts, sequence = np.zeros((len(self.ids), 4), np.int64), [np.zeros(0, np.int32)]
        for k, chunks in enumerate(self.documents):
            own = of_chunk[chunks]
            if (own < 0).any():
                continue  # tokens' bytes are not the text's
            counts[k] = own.sum(axis=0)
            n = own[:, 3]
            sequence.append(windows[np.arange(n.sum()) + np.repeat(low[chunks] - np.cumsum(n) + n, n)])
        return counts, np.concatenate(sequence)

    def row(self, number: int) -> pa.RecordBatch:
        none = np.zeros(0, np.int64)
        # what tells chunks and windows apart is no longer needed
        self.chunk.clear()
        self.window.clear()
        counts, sequence = self._per_document()
        n_links = np.concatenate([none, *self.n_links])
        pairs, links = np.unique(np.concatenate([none, *self.links]), return_inverse=True)
        times = np.bincount(sequence, minlength=len(n_links))  # of each window in the unit
        n = np.bincount(links, np.repeat(times, n_links), len(pairs)).astype(np.int64)
        data = [bytes(x.astype("<i4")) for x in (sequence, links, n_links)]
        blobs = [zstandard.compress(x, 3) for x in (*data, "".join(self.groups).encode())]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([number], pa.int64()),
                pa.array([self.ids], pa.list_(pa.int64())),
                *[pa.array([c.tolist()], pa.list_(pa.int64())) for c in counts.T],
                *[pa.array([x], pa.binary()) for x in blobs],
                *[pa.array([x.tolist()], pa.list_(pa.int64())) for x in (pairs >> 32, pairs & 0xFFFFFFFF, n)],
            ],
            [c.split()[0] for c in _UNIT.split(", ")],
        )


_UNIT = (
    "unit bigint, ids array<bigint>, n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>, "
    "n_windows array<bigint>, sequence binary, links binary, n_links binary, groups binary, "
    "a array<bigint>, b array<bigint>, n array<bigint>"
)


def _units(df: DataFrame, a_path: str, b_path: str, id_col: str, text_col: str) -> DataFrame:
    """Documents packed into units, in buckets by unit: sums come to them, they stay."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        gc.disable()  # nothing here forms cycles, and its scans take a sixth of the time
        number, pair = TaskContext.get().partitionId() << 32, Pair(a_path, b_path)
        unit, ids, texts, size = Unit(pair), [], [], 0
        for batch in batches:
            for key, text in zip(batch.column("id"), batch.column("text")):
                ids.append(key.as_py())
                texts.append(text.as_py() or "")
                size += len(texts[-1])
                if size >= RUN_CHARS:
                    unit.add(ids, texts)
                    ids, texts, size = [], [], 0
                    if unit.size >= UNIT_CHARS:
                        yield unit.row(number)
                        number, unit = number + 1, Unit(pair)
        unit.add(ids, texts)
        del ids, texts
        if unit.ids:
            yield unit.row(number)
        # the worker goes on to other tasks
        del unit
        pair.chunks.clear()
        pa.default_memory_pool().release_unused()
        gc.enable()

    docs = df.select(named(id_col).cast("bigint").alias("id"), named(text_col).alias("text"))
    return bucketed(docs.mapInArrow(pack, _UNIT), "unit", "units")


def align(df: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups) of every row of ``df``.

    ``a_path`` is a byte-level ``tokenizers`` file, which encodes a space and the
    text, ``b_path`` a ``sentencepiece`` model, which adds the space; both without
    special tokens, whose strings in a text are plain text.  ``groups`` lists what
    lies between shared ends, ``a1,a2|b1;a3|b2,b3``.  A link is a pair of tokens
    whose bytes overlap; the count of its ids is taken over all rows, repeated
    ones included.  ``n_best`` are links whose count is the highest of their B id
    (ties too), ``count_sum`` adds the counts up.

    NULL and empty texts, and texts whose tokens' bytes are not the text's, have
    zeros and '' for groups.  Ids are whole numbers and may be NULL or repeated.  A
    very long text is a unit of its own and takes memory in proportion to it.
    Columns of ``df`` besides the two named play no part; an empty table gives no
    rows.
    """
    units = _units(df, a_path, b_path, id_col, text_col)
    each = units.select("unit", F.posexplode(F.arrays_zip("a", "b", "n")).alias("number", "p"))
    rows = each.select("unit", "number", "p.a", "p.b", "p.n")
    totals = rows.groupBy("a", "b").agg(F.sum("n").alias("total"))
    best = totals.groupBy("b").agg(F.max("total").alias("most"))  # at most one row for each id of B
    marked = totals.join(best, "b").select(
        "a", "b", (F.col("total") * 2 + (F.col("total") == F.col("most")).cast("int")).alias("mark")
    )
    known = rows.join(marked, ["a", "b"]).groupBy("unit").agg(
        F.sort_array(F.collect_list(F.struct("number", "mark"))).getField("mark").alias("marks")
    )

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                yield _finished({c: batch.column(c)[k] for c in batch.schema.names})

    needed = units.select("unit", "ids", "n_a", "n_b", "n_groups", "n_windows", "sequence", "links", "n_links", "groups")
    return needed.join(known, "unit", "left").mapInArrow(finish, _OUT)


_OUT = (
    "id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups string"
)


def _finished(row: dict[str, pa.Scalar]) -> pa.RecordBatch:
    """One unit's result rows."""

    def numbers(name: str) -> np.ndarray:
        values = row[name].values
        return np.zeros(0, np.int64) if values is None else values.to_numpy(zero_copy_only=False)

    def blob(name: str) -> bytes:
        return zstandard.decompress(row[name].as_py())

    sequence, links, n_links = (np.frombuffer(blob(c), "<i4").astype(np.int64) for c in ("sequence", "links", "n_links"))
    marks, text = numbers("marks"), blob("groups").decode().split("\n")
    window_end, doc_end = np.cumsum(n_links), np.cumsum(numbers("n_windows"))

    def per_document(per_link: np.ndarray) -> np.ndarray:
        sums = np.append(0, np.cumsum(per_link))
        of_window = sums[window_end] - sums[window_end - n_links]
        sums = np.append(0, np.cumsum(of_window[sequence]))
        return np.diff(sums[doc_end], prepend=0)

    per_link = marks[links] if len(links) else links
    named_windows = [text[w] for w in sequence.tolist()]
    low, groups = 0, []
    for high in doc_end.tolist():
        groups.append(";".join(named_windows[low:high]))
        low = high
    columns = [
        row["ids"].values,
        *[pa.array(numbers(c)) for c in ("n_a", "n_b", "n_groups")],
        pa.array(per_document(np.ones_like(links))),
        pa.array(per_document(per_link & 1)),
        pa.array(per_document(per_link >> 1)),
        pa.array(groups, pa.string()),
    ]
    return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _OUT.split(", ")])
