"""SentencePiece BPE encoding and decoding by suffix-array matching."""

from __future__ import annotations

import codecs
import functools
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newscorpus.llm.common import text_runs, texts

SPACE = "▁"
#: Characters of distinct words that are indexed together.
INDEX_CHARS = 1 << 19
#: Characters of texts that are encoded together.
RUN_CHARS = 1 << 21
#: Words whose ids a task remembers.
CACHE_WORDS = 150_000
#: Longer words are merged one by one, with a heap.
ROUND_CHARS = 48

codecs.register_error("each_byte", lambda e: ("�" * (e.end - e.start), e.end))


class Vocabulary:
    """Pieces and ranks of a SentencePiece BPE model file."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        everything = range(model.get_piece_size())
        self.unknown = model.unk_id()
        self.byte = {int(model.id_to_piece(i)[3:5], 16): i for i in everything if model.is_byte(i)}
        self.ids = np.array(
            [i for i in everything if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
        )
        self.pieces = [model.id_to_piece(int(i)) for i in self.ids]
        scores = np.array([model.get_score(int(i)) for i in self.ids])
        # rank 0 is merged first; pieces of one score share a rank
        self.rank = np.unique(-scores, return_inverse=True)[1]
        self.longest = max(map(len, self.pieces))
        if any("\n" in p or SPACE in p.lstrip(SPACE) for p in self.pieces):
            raise ValueError("words cannot be told apart: a piece goes on behind a word's end")
        self.surface = _Surface((int(i), p.encode()) for i, p in zip(self.ids, self.pieces))
        self.surface.update((i, bytes([b])) for b, i in self.byte.items())
        self.surface[self.unknown] = " ⁇ ".encode()
        lengths = [len(p) for p in self.pieces]
        self.lengths = np.array(lengths)
        self.codes = np.zeros((len(lengths), self.longest), np.int64)
        for row, p in zip(self.codes, self.pieces):
            row[: len(p)] = [ord(c) for c in p]
        self.known: dict[str, bytes] = {}


class _Surface(dict):
    """Bytes of an id; control ids and unknown numbers have none."""

    def __missing__(self, key) -> bytes:
        return b""


@functools.lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


#: A word is a run of spaces and what follows up to the next space or line end.
_WORD = re.compile(f"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+")


def _words(text: str) -> list[str]:
    return _WORD.findall(SPACE + text.replace(" ", SPACE)) if text else []


class Heads:
    """The characters at each place as one number: as many as fit, ``width`` of them.

    Numbers of characters follow their order; 0 stands behind the last one.
    """

    def __init__(self, codes: np.ndarray):
        present = np.zeros(int(codes.max(initial=0)) + 1, bool)
        present[codes] = True
        self.symbol = np.where(present, np.cumsum(present), 0)
        self.bits = max(1, int(self.symbol.max()).bit_length())
        self.width = 62 // self.bits
        own = self.symbol[codes]
        self.numbers = own.copy()
        for k in range(1, self.width):
            self.numbers <<= self.bits
            self.numbers[:-k] |= own[k:]

    def of(self, strings: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(least, greatest, possible) number of a place where each string begins."""
        least, possible = np.zeros(len(strings), np.int64), np.ones(len(strings), bool)
        for k in range(self.width):
            inside, code = k < lengths, strings[:, min(k, strings.shape[1] - 1)]
            symbol = np.where(inside, self.symbol[np.minimum(code, len(self.symbol) - 1)], 0)
            possible &= ~inside | ((code < len(self.symbol)) & (symbol > 0))
            least = least << self.bits | symbol
        rest = np.maximum(self.width - lengths, 0) * self.bits
        return least, least + (np.int64(1) << rest) - 1, possible


def suffix_array(codes: np.ndarray, depth: int, heads: Heads | None = None) -> np.ndarray:
    """Start positions in the order of the first ``depth`` characters, by prefix doubling.

    Doubling starts from the heads, not from single characters.
    """
    heads = heads or Heads(codes)
    offset = heads.width
    if offset >= depth:
        return np.argsort(heads.numbers, kind="stable")
    rank = np.unique(heads.numbers, return_inverse=True)[1]
    while True:
        after = np.zeros_like(rank)
        after[:-offset] = rank[offset:] + 1
        pair = rank * (len(codes) + 1) + after
        if 2 * offset >= depth:
            return np.argsort(pair, kind="stable")
        rank = np.unique(pair, return_inverse=True)[1]
        offset *= 2


def occurrences(
    codes: np.ndarray, order: np.ndarray, v: Vocabulary, heads: Heads | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """(low, high) of every piece: its places are order[low:high].

    All pieces are searched at once: by their heads, then one character deeper
    each time.
    """
    heads = heads or Heads(codes)
    least, greatest, possible = heads.of(v.codes, v.lengths)
    ordered = heads.numbers[order]
    low, high = np.searchsorted(ordered, least), np.searchsorted(ordered, greatest, "right")
    high = np.where(possible, high, low)
    padded = np.concatenate([codes, np.zeros(v.longest, codes.dtype)])
    for depth in range(heads.width, v.longest):
        deeper = np.flatnonzero((v.lengths > depth) & (low < high))
        if not len(deeper):
            break
        wanted = v.codes[deeper, depth]
        bounds = []
        for past in (wanted, wanted + 1):
            lo, hi = low[deeper].copy(), high[deeper].copy()
            while (open_ := lo < hi).any():
                middle = (lo + hi) // 2
                less = np.zeros(len(lo), bool)
                less[open_] = padded[order[middle[open_]] + depth] < past[open_]
                lo = np.where(open_ & less, middle + 1, lo)
                hi = np.where(open_ & ~less, middle, hi)
            bounds.append(lo)
        low[deeper], high[deeper] = bounds
    return low, np.maximum(low, high)


def edges(codes: np.ndarray, v: Vocabulary) -> np.ndarray:
    """Row by position, column by length: 1 + the index of the piece there, 0 for none."""
    heads = Heads(codes)
    order = suffix_array(codes, v.longest, heads)
    low, high = occurrences(codes, order, v, heads)
    n = high - low
    piece = np.repeat(np.arange(len(n)), n)
    within = np.arange(len(piece)) - np.repeat(np.cumsum(n) - n, n)
    at = order[np.repeat(low, n) + within]
    by_place = np.zeros((len(codes), v.longest + 1), np.int32)
    by_place[at, v.lengths[piece]] = piece + 1
    return by_place


def encode_words(words: list[str], v: Vocabulary) -> list[bytes]:
    """Ids of every word, as little-endian int32."""
    out: list[bytes] = []
    group, size = [], 0
    for word in words:
        group.append(word)
        size += len(word) + 1
        if size >= INDEX_CHARS:
            out += _encode_group(group, v)
            group, size = [], 0
    return out + (_encode_group(group, v) if group else [])


def _encode_group(words: list[str], v: Vocabulary) -> list[bytes]:
    # a line end stands between words: no piece holds one
    codes = np.frombuffer(("\n".join(words) + "\n").encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    by_place = edges(codes, v)
    length = np.array([len(w) for w in words])
    start = np.cumsum(length + 1) - length - 1
    boundary = _relax(by_place, start, length, v)
    # tokens: from each boundary to the next one of the word
    word_of = np.repeat(np.arange(len(words)), length)
    place = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length) + np.repeat(start, length)
    first = boundary[place]
    place, word_of = place[first], word_of[first]
    end = np.append(place[1:], 0)
    last = np.append(word_of[1:] != word_of[:-1], True)
    end[last] = (start + length)[word_of[last]]
    piece = by_place[place, end - place]
    ids = np.where(piece > 0, v.ids[piece - 1], -1)
    times = np.ones(len(ids), np.int64)
    for k in np.flatnonzero(piece == 0):
        if v.byte:
            times[k] = len(chr(codes[place[k]]).encode("utf-8", "replace"))
    flat = np.repeat(ids, times)
    to = np.cumsum(times) - times
    for k in np.flatnonzero(piece == 0):
        raw = chr(codes[place[k]]).encode("utf-8", "replace")
        flat[to[k] : to[k] + times[k]] = [v.byte[b] for b in raw] if v.byte else v.unknown
    raw = flat.astype("<i4").tobytes()
    count = np.bincount(word_of, times, len(words)).astype(np.int64) * 4
    stop = np.cumsum(count)
    return [raw[b - n : b] for b, n in zip(stop.tolist(), count.tolist())]


def _relax(by_place: np.ndarray, start: np.ndarray, length: np.ndarray, v: Vocabulary) -> np.ndarray:
    """Where tokens begin once no edge joins two neighbouring tokens any more.

    Of a word's edges over two tokens the one of the best rank is taken, the
    first on ties; all words take one in each round.
    """
    boundary = np.ones(len(by_place), bool)
    none = len(v.rank)
    rank = np.append(none, v.rank)  # the first: no piece
    pieces, width = by_place.ravel(), by_place.shape[1]
    short = np.flatnonzero((length > 1) & (length <= ROUND_CHARS))
    for k in np.flatnonzero(length > ROUND_CHARS):
        _merge_long(by_place, int(start[k]), int(length[k]), v, boundary)
    n = length[short]
    token = np.repeat(start[short], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    word = np.repeat(np.arange(len(n)), n)
    stop = (start + length)[short]
    while len(token):
        # end of the neighbour on the right, of the same word
        end = np.append(token[2:], 0)
        end = np.append(end, 0)[: len(token)]
        inner = np.append(word[1:] == word[:-1], False)
        third = np.append(word[2:] == word[:-2], [False, False])[: len(token)] if len(token) > 1 else np.zeros(1, bool)
        end = np.where(third, end, stop[word])
        span = end - token
        span[~inner | (span > v.longest)] = 0  # no piece is that short
        best = rank.take(pieces.take(token * width + span))
        key = best * len(token) + np.arange(len(token))
        heads = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        least = np.minimum.reduceat(key, heads)
        merged = least[least // len(token) < none] % len(token)
        boundary[token[merged + 1]] = False
        keep = np.ones(len(token), bool)
        keep[merged + 1] = False
        # words without an edge are done
        alive = np.zeros(len(stop), bool)
        alive[word[merged]] = True
        keep &= alive[word]
        token, word = token[keep], word[keep]
    return boundary


def _merge_long(by_place: np.ndarray, start: int, length: int, v: Vocabulary, boundary: np.ndarray) -> None:
    stop = start + length
    following = list(range(1, length + 1))
    before = list(range(-1, length - 1))
    heap: list[tuple[int, int, int, int]] = []

    def offer(at: int) -> None:
        middle = following[at]
        if middle < length and (end := following[middle]) - at <= v.longest:
            if piece := by_place[start + at, end - at]:
                heapq.heappush(heap, (int(v.rank[piece - 1]), at, middle, end))

    for at in range(length):
        offer(at)
    while heap:
        _, at, middle, end = heapq.heappop(heap)
        if following[at] != middle or following[middle] != end:
            continue
        boundary[start + middle] = False
        following[at], following[middle] = end, -1
        if start + end < stop:
            before[end] = at
        offer(at)
        if before[at] >= 0:
            offer(before[at])


def _encode_texts(column, v: Vocabulary) -> list[np.ndarray]:
    known, words = v.known, [_words(text) for text in column]
    new = list(set().union(*words).difference(known))
    room = max(0, CACHE_WORDS - len(known))
    known.update(zip(new, encode_words(new, v)))
    out = [np.frombuffer(b"".join(map(known.__getitem__, own)), "<i4") for own in words]
    for w in new[room:]:
        del known[w]
    return out


def encode(
    df: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False
) -> DataFrame:
    """(id, text, ids) of every row: the ids of its whole text, no begin or end added.

    NULL and empty texts have no ids; repeated rows each keep theirs.  The
    model file lies at ``model_path`` on every executor.  Texts of one run are
    indexed together, each distinct word once.  With ``decoded`` the ids are
    turned into text again in the same pass.
    """
    docs = texts(df, id_col, text_col)
    kind = docs.schema["id"].dataType.simpleString()
    names = ["id", "text", "ids", *(["decoded"] if decoded else [])]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(model_path)
        for batch in batches:
            for low, run in text_runs(batch.column("text"), RUN_CHARS):
                ids = _encode_texts(run, v)
                ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                flat = np.concatenate(ids)
                columns = [
                    batch.column("id").slice(low, len(run)),
                    batch.column("text").slice(low, len(run)),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                ]
                if decoded:
                    columns.append(pa.array([_decoded(i, v.surface) for i in ids], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names)
            # what was sent is no longer needed; the worker goes on to other tasks
            pa.default_memory_pool().release_unused()
        v.known.clear()

    schema = f"id {kind}, text string, ids array<int>" + (", decoded string" if decoded else "")
    return docs.mapInArrow(of, schema)


def decode(ids: Column, model_path: str) -> Column:
    """Text of an array of ids; control ids have no text, NULL gives ''."""

    @F.pandas_udf("string")
    def of(column: pd.Series) -> pd.Series:
        surface = vocabulary(model_path).surface
        return pd.Series([_decoded(i, surface) for i in column], dtype=object)

    return of(ids)


def _decoded(ids, surface: _Surface) -> str:
    if ids is None or not len(ids):
        return ""
    raw = b"".join(map(surface.__getitem__, ids.tolist()))
    text = raw.decode("utf-8", "each_byte").replace(SPACE, " ")
    return text[1:] if raw.startswith(SPACE.encode()) else text
