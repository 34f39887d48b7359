"""Logistic mixing of hashed-context bit predictors, in numpy over many bytes at once."""

from __future__ import annotations

import functools
import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np

#: Bytes of context of each predictor; contexts end only where a text begins.
ORDERS = (1, 2, 3, 4, 6)
#: Hashed slots of each predictor, as a power of two.
SLOT_BITS = 19
#: What stands behind the last byte of a text; no UTF-8 text holds it.
END = b"\xff"
#: Bytes that are modelled at once.
CHUNK = 1 << 13
#: Bytes whose distinct ones, with their contexts, are looked up together.
BLOCK = 1 << 21
#: Bytes with their contexts whose costs a Python worker keeps.
HELD = 1 << 20
#: Weight sets: a gate for each number of predictors that know the context, and each bit.
GATES = (len(ORDERS) + 1) * 8
#: Steps of the final refinement, between logits of -8 and 8; each for every node of a byte.
STEPS = 33
RATE = 0.1
_PRIOR = 0.4
#: Bytes before a byte that its key holds.
_BEFORE = 6
#: Low bits of a number that hold a position in a block.
_AT = np.uint64(24)

_TURN = np.arange(8)
_BYTES = np.arange(256)[:, None]
_ONES = ((_BYTES >> (7 - _TURN)) & 1).astype(np.float32)
#: First cell of the refinement table at the node of each bit of each byte.
_CELL = (((1 << _TURN) | (_BYTES >> (8 - _TURN))) * STEPS).astype(np.float32)
#: The same where zeros and ones alternate, at the byte's own bits.
_SEEN = 2 * _CELL + _ONES
#: The four bits of half a byte, and the slots of a context that they are in.
_HALF_BIT = (np.arange(16)[:, None] >> (3 - np.arange(4))) & 1
_HALF_SLOT = (1 << np.arange(4)) | (np.arange(16)[:, None] >> (4 - np.arange(4)))


def closed(text: str) -> bytes:
    """A text's bytes and its end."""
    return text.encode("utf-8", "replace") + END


def blocks(texts: list[bytes], size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text, key) of every byte, ``size`` bytes at a time.

    A key is the byte, and below it those before it in its text, the nearest
    first; 0 stands before a text.  So keys that share their upper bytes share the
    shorter contexts.
    """
    data = bytes(_BEFORE + 1) + bytes(_BEFORE).join(texts)
    windows = np.ndarray((max(len(data) - 7, 0),), "<u8", data, 0, (1,))
    ends = np.cumsum([0, *map(len, texts)])
    for low in range(0, int(ends[-1]), size):
        text = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(np.clip(ends, low, low + size)))
        first, last = int(text[0]), int(text[-1])
        begin = low + _BEFORE * first
        keys = windows[begin : low + len(text) + _BEFORE * last] >> np.uint64(8)
        keep = np.ones(len(keys), bool)
        gaps = ends[first + 1 : last + 1] + _BEFORE * np.arange(first, last) - begin
        keep[gaps[:, None] + np.arange(_BEFORE)] = False
        yield text, keys[keep]


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(keys, index of each one's own among them); in no order.

    Positions are sorted by a hash of their keys.  Keys that share a hash may come
    more than once, never take another's place.
    """
    order = keys * np.uint64(0x9E3779B97F4A7C15)
    order >>= _AT
    order <<= _AT
    order |= np.arange(len(keys), dtype=np.uint64)
    order.sort()
    order &= np.uint64((1 << int(_AT)) - 1)
    order = order.view(np.int64)
    keys = np.take(keys, order)
    new = np.ones(len(keys), bool)
    np.not_equal(keys[1:], keys[:-1], out=new[1:])
    own = np.empty(len(keys), np.int32)
    own[order] = np.cumsum(new, dtype=np.int32)
    own -= 1
    return keys[new], own


def byte_of(keys: np.ndarray) -> np.ndarray:
    return (keys >> np.uint64(8 * _BEFORE)).astype(np.intp)


_PREDICTOR = np.arange(len(ORDERS), dtype=np.uint64)[:, None]
_CONTEXT = np.array([(1 << 8 * order) - 1 for order in ORDERS], np.uint64)[:, None]


def halves(keys: np.ndarray, predictors: slice = slice(None)) -> np.ndarray:
    """(predictor, keys, 2): where the predictors have the two halves of each key's byte, all counted through.

    A context is hashed once for each half, to 16 neighbouring places: as many as
    there are halves of a byte, and one more than there are slots for their bits.
    """
    which = _PREDICTOR[predictors]
    byte = keys >> np.uint64(8 * _BEFORE)
    upper = byte >> np.uint64(4)
    h = (keys.byteswap() >> np.uint64(16)) & _CONTEXT[predictors]
    h += which << np.uint64(56)
    h *= np.uint64(0xC2B2AE3D27D4EB4F)
    h ^= h >> np.uint64(31)
    out = np.empty((*h.shape, 2), np.uint64)
    for half, own in enumerate((upper, byte & np.uint64(15))):
        if half:
            h += (upper + np.uint64(16)) * np.uint64(0x9E3779B97F4A7C15)
        place = h * np.uint64(0xD6E8FEB86659FD93)
        place >>= np.uint64(68 - SLOT_BITS)
        place <<= np.uint64(4)
        np.bitwise_or(place, own + (which << np.uint64(SLOT_BITS)), out=out[..., half])
    return out.view(np.int64)


def paths(table: np.ndarray) -> np.ndarray:
    """(place of a half, 4): what ``table`` has for the bits of every half.

    ``table`` is by predictor and slot, or by predictor, slot and bit.
    """
    table = table.reshape(len(ORDERS) << SLOT_BITS - 4, -1)
    at = _HALF_SLOT if table.shape[1] == 16 else 2 * _HALF_SLOT + _HALF_BIT
    return np.take(table, at.ravel(), axis=1).reshape(-1, 4)


def no_halves() -> np.ndarray:
    """Counts by predictor and place of a half."""
    return np.zeros((len(ORDERS), 1 << SLOT_BITS))


def count_halves(texts: list[bytes], found: np.ndarray) -> None:
    """Adds the halves of the texts' bytes to ``found``.

    Each distinct byte and context of a block is looked up once, by its sorted keys.
    """
    for _, keys in blocks(texts, BLOCK):
        keys.sort()
        for k, order in enumerate(ORDERS):
            short = keys >> np.uint64(8 * (_BEFORE - order))
            at = np.flatnonzero(np.concatenate([[True], short[1:] != short[:-1]]))
            times = np.diff(at, append=len(keys)).astype(float)
            some = keys[at]
            where = np.concatenate(
                [halves(some[low : low + CHUNK], slice(k, k + 1))[0] for low in range(0, len(at), CHUNK)]
            )
            where -= k << SLOT_BITS
            found[k] += np.bincount(where.ravel(), np.repeat(times, 2), 1 << SLOT_BITS)


def add_bits(found: np.ndarray, table: np.ndarray) -> None:
    """Adds the bits of counted halves to ``table``: (predictor, slot and bit) in two dimensions."""
    bits = table.reshape(len(ORDERS), -1, 16, 2)
    for turn in (3, 2, 1, 0):
        known = 1 << turn
        bits[:, :, known : 2 * known] += found.reshape(len(ORDERS), -1, known, 2)
        found = found[:, 0::2] + found[:, 1::2]


def count(texts: list[bytes], table: np.ndarray) -> None:
    """Adds the texts' bits to ``table``."""
    found = no_halves()
    count_halves(texts, found)
    add_bits(found, table)


def stretch(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Logit of a predictor; 0 where it has seen nothing."""
    return np.log((ones + _PRIOR) / (zeros + _PRIOR)).astype(np.float32)


def unseen(table: np.ndarray) -> np.ndarray:
    """Logits by slot and bit for an occurrence of the bit that the counts leave out."""
    zeros, ones = table[:, 0::2], table[:, 1::2]
    out = np.empty(table.shape, np.float32)
    out[:, 0::2] = stretch(np.maximum(zeros - 1, 0), ones)
    out[:, 1::2] = stretch(zeros, np.maximum(ones - 1, 0))
    return out


def _rows(bits: np.ndarray) -> np.ndarray:
    """The bits of some bytes in longer rows, each of whole bytes."""
    return bits.reshape(-1, 8 * math.gcd(len(bits) // 8, 64))


def _logit(keys: np.ndarray, paths: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, ...]:
    """(predictors' logits, mixed logits, the bits that not all predictors know, their logits, their gates), bits flat.

    Weights are those of the gate.  Bits that all predictors know take the
    weights of the last gates in whole rows, only the others look theirs up.
    """
    inputs = np.take(paths, halves(keys), axis=0).reshape(len(ORDERS), -1)
    others = np.flatnonzero((inputs == 0).any(axis=0))
    some_inputs = inputs[:, others]
    gate = np.count_nonzero(some_inputs, axis=0) * 8 + others % 8
    out = np.empty(inputs.shape[1], np.float32)
    rows = _rows(out)
    of_all = np.tile(weights[-8:], (rows.shape[1] // 8, 1)).T
    rows[:] = of_all[-1]
    for x, weight in zip(inputs, of_all):
        rows += _rows(x) * weight
    own = np.take(weights, gate, axis=0).T
    some = own[-1].copy()
    for x, weight in zip(some_inputs, own):
        some += weight * x
    out[others] = some
    return inputs, np.clip(out, -16, 16, out=out), others, some_inputs, gate


def first_weights() -> np.ndarray:
    return np.tile(np.array([*[0.3] * len(ORDERS), 0.0], np.float32), (GATES, 1))


def step(logit: np.ndarray) -> np.ndarray:
    """Step of the refinement, as a whole float."""
    out = logit + 8
    out *= (STEPS - 1) / 16
    np.rint(out, out=out)
    return np.clip(out, 0, STEPS - 1, out=out)


@dataclass
class Predictors:
    """Logits that a Python worker lays out once, not for every task."""

    logits: np.ndarray

    @functools.cached_property
    def paths(self) -> np.ndarray:
        return paths(self.logits)


class Trainer:
    """Online training of the weights, and counts for the refinement.

    A predictor's counts leave out the occurrence that is predicted, as if it
    were still to come.
    """

    def __init__(self, logits: np.ndarray | Predictors):
        """``logits``: of :func:`unseen`."""
        self.paths = paths(logits) if isinstance(logits, np.ndarray) else logits.paths
        self.weights = first_weights()
        self.mass = 0.0
        self.refined = np.zeros((2, 256 * STEPS))

    def learn(self, texts: list[bytes]) -> None:
        for _, keys in blocks(texts, CHUNK << 5):
            for low in range(0, len(keys), CHUNK):
                self._learn(keys[low : low + CHUNK])

    def _learn(self, keys: np.ndarray) -> None:
        byte = byte_of(keys)
        inputs, logit, others, some_inputs, gate = _logit(keys, self.paths, self.weights)
        miss = np.negative(logit)
        np.exp(miss, out=miss)
        miss += 1
        np.divide(1, miss, out=miss)
        np.subtract(np.take(_ONES, byte, axis=0).ravel(), miss, out=miss)
        seen = np.bincount(gate, minlength=GATES)
        seen[-8:] += len(keys) - np.bincount(others % 8, minlength=8)
        missed = miss[others]
        miss[others] = 0
        n = len(ORDERS) + 1
        at = gate + GATES * np.arange(n)[:, None]
        steps = np.bincount(at.ravel(), np.concatenate([missed * some_inputs, [missed]]).ravel(), n * GATES)
        steps = steps.astype(float).reshape(n, GATES)
        sums = [np.add.reduce(_rows(x), axis=0, dtype=float) for x in (*(miss * x for x in inputs), miss)]
        steps[:, -8:] += np.stack(sums).reshape(n, -1, 8).sum(axis=1)
        self.weights += (RATE / np.maximum(seen, 1) * steps).T
        where = step(logit)
        where *= 2
        where += np.take(_SEEN, byte, axis=0).ravel()
        self.refined += np.bincount(where.astype(np.intp), minlength=2 * 256 * STEPS).reshape(-1, 2).T
        self.mass += len(where)


@dataclass
class Mixing(Predictors):
    """What scoring needs; its size does not depend on the corpus."""

    weights: np.ndarray
    refinement: np.ndarray

    @functools.cached_property
    def _held(self) -> list[np.ndarray]:
        """Keys in order, and their costs, as far as a worker knows them."""
        return [np.zeros(0, np.uint64), np.zeros(0)]

    def costs(self, texts: list[bytes]) -> np.ndarray:
        """Bits of every text: those of each distinct byte and context are worked out once a block, or kept."""
        out = np.zeros(len(texts))
        for text, keys in blocks(texts, BLOCK):
            keys, own = distinct(keys)
            out += np.bincount(text, self._known_costs(keys)[own], len(texts))
        return out

    def _known_costs(self, keys: np.ndarray) -> np.ndarray:
        held, known = self._held
        order = np.argsort(keys)
        keys = keys[order]
        at = np.searchsorted(held, keys)
        new = np.ones(len(keys), bool)
        some = np.flatnonzero(at < len(held))
        new[some] = held[at[some]] != keys[some]
        cost, fresh = np.empty(len(keys)), keys[new]
        cost[~new] = known[at[~new]]
        cost[new] = np.concatenate(
            [self._costs(fresh[low : low + CHUNK]) for low in range(0, len(fresh), CHUNK)] or [np.zeros(0)]
        )
        room = HELD - len(held)
        if room > 0 and len(fresh):
            held = np.concatenate([held, fresh[:room]])
            known = np.concatenate([known, cost[new][:room]])
            merged = np.argsort(held, kind="stable")
            self._held[:] = held[merged], known[merged]
        out = np.empty(len(keys))
        out[order] = cost
        return out

    def _costs(self, keys: np.ndarray) -> np.ndarray:
        byte = byte_of(keys)
        _, logit, _, _, _ = _logit(keys, self.paths, self.weights)
        where = np.take(_CELL, byte, axis=0).ravel() + step(logit)
        logit = (logit + np.take(self.refinement, where.astype(np.intp))) / 2
        against = np.where(np.take(_ONES, byte, axis=0).ravel() == 1, -logit, logit).astype(float)
        # 1 + exp(24) at most, so a byte's product keeps far within the range
        return np.log2((1 + np.exp(against)).reshape(-1, 8).prod(axis=1))


def refinement(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Logit of each cell; a step that saw little keeps near its own logit."""
    own = np.tile(np.linspace(-8, 8, STEPS), 256)
    p = 1 / (1 + np.exp(-own))
    p = (ones + 4 * p) / (zeros + ones + 4)
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p)).astype(np.float32)
