"""Language-model scoring: unigram base and online logistic context mixing."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newscorpus.llm import mixing
from newscorpus.llm.common import saved, text_runs, texts
from newscorpus.llm.lexicon import count_cut, lower_words, piece_sums

#: Bytes of the texts that share one online pass over the weights, at least.
PASS_BYTES = 8 << 20
#: Passes at most: on a larger corpus each takes more texts.
PASSES = 10_000
#: Characters that a task trains the weights on together.
RUN_CHARS = 1 << 18
#: Characters that a task counts together: the more, the fewer distinct contexts.
COUNT_CHARS = 1 << 22
#: Counts that travel in one row.
PART = 1 << 12


@dataclass(frozen=True)
class Model:
    """Word counts as a table, the mixing model as arrays of fixed size."""

    lexicon: DataFrame
    n_docs: int
    n_tokens: int
    n_distinct: int
    mixing: mixing.Mixing


def train(df: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> Model:
    """Learns from every row of ``df``; a NULL text is empty.

    One pass adds up the predictors' bit counts.  A second one trains the weights
    online, over groups of texts that follow from id and text alone, in an order
    that does too; the groups' weights are averaged.  So the model does not
    depend on how the rows are spread.  Rows that repeat both id and text share a
    group.
    """
    docs = texts(df, id_col, text_col)
    words = count_cut(docs, lower_words)
    lexicon = saved(
        words.select("piece", "n", F.log10(F.col("n") + F.lit(0.1)).alias("log_count"), F.lit(1).alias("known")),
        "words",
    )
    n_docs, n_bytes = docs.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text") + 1), F.lit(0))).first()
    n_words, distinct = lexicon.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    passes = max(1, min(PASSES, math.ceil(n_bytes / PASS_BYTES)))
    return Model(lexicon, n_docs, n_words + n_docs, distinct + (n_docs > 0), _train_mixing(docs, passes))


def _train_mixing(docs: DataFrame, passes: int) -> mixing.Mixing:
    spark = docs.sparkSession

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = mixing.no_halves()
        for batch in batches:
            for _, run in text_runs(batch.column("text"), COUNT_CHARS):
                mixing.count_halves([mixing.closed(t) for t in run], found)
        rows = found.reshape(-1, PART)
        yield from _parts({int(at): rows[at] for at in np.flatnonzero(rows.any(axis=1))})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, counts in zip(batch.column("part").to_pylist(), batch.column("counts")):
                held[at] = held.get(at, 0) + np.frombuffer(counts.as_buffer(), np.int64)
        yield from _parts(held)

    kind = "part int, counts binary"
    parts = docs.select("text").mapInArrow(count, kind).repartition("part").mapInArrow(add, kind).toArrow()
    found, table = mixing.no_halves(), np.zeros((len(mixing.ORDERS), 2 << mixing.SLOT_BITS))
    for at, counts in zip(parts["part"].to_pylist(), parts["counts"]):
        found.reshape(-1, PART)[at] = np.frombuffer(counts.as_buffer(), np.int64)
    mixing.add_bits(found, table)
    shared = spark.sparkContext.broadcast(mixing.Predictors(mixing.unseen(table)))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer = mixing.Trainer(shared.value)
        for batch in batches:
            for _, run in text_runs(batch.column("text"), RUN_CHARS):
                trainer.learn([mixing.closed(t) for t in run])
        # weights come first, as weighted sums, then the refinement's counts
        weighted = trainer.weights.astype(float).ravel() * trainer.mass
        mass = np.full(len(weighted), trainer.mass)
        yield from _sums(np.concatenate([[weighted, mass], trainer.refined], axis=1))

    grouped = docs.repartition(passes, F.xxhash64("id", "text")).sortWithinPartitions(F.xxhash64("id", "text"), "id", "text")
    n_weights = mixing.first_weights().size
    first, second = _added_up(
        grouped.select("text").mapInArrow(learn, "slot int, zeros double, ones double"),
        n_weights + 256 * mixing.STEPS,
    )
    if second[0] > 0:
        weights = (first[:n_weights] / second[:n_weights]).reshape(mixing.GATES, -1)
    else:
        weights = mixing.first_weights()
    return mixing.Mixing(
        mixing.stretch(table[:, 0::2], table[:, 1::2]),
        weights.astype(np.float32),
        mixing.refinement(first[n_weights:], second[n_weights:]),
    )


def _parts(counts: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    held = list(counts.items())
    for at in range(0, len(held), 64):
        part, rows = zip(*held[at : at + 64])
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.int32()), pa.array([r.astype(np.int64).tobytes() for r in rows], pa.binary())],
            ["part", "counts"],
        )


def _sums(table: np.ndarray) -> Iterator[pa.RecordBatch]:
    slot = np.flatnonzero(table.any(axis=0))
    for at in range(0, len(slot), 100_000):
        part = slot[at : at + 100_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part.astype(np.int32)), pa.array(table[0, part]), pa.array(table[1, part])],
            ["slot", "zeros", "ones"],
        )


def _added_up(parts: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums by slot, of which there are ``size``."""
    sums = parts.groupBy("slot").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones")).toArrow()
    out = np.zeros((2, size), np.float64)
    out[:, sums["slot"].to_numpy()] = sums["zeros"].to_numpy(), sums["ones"].to_numpy()
    return out[0], out[1]


def score(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, n_known, base_score, bits, bits_per_byte) of every row.

    Tokens are the words, lower-case, and one end.  ``base_score`` is the log10
    probability of the smoothed unigram model.  ``bits`` is what the mixing
    model takes for the whole text and its end, contexts reaching over words; a
    very long text is modelled a chunk at a time.  A NULL text is empty, so it has
    one token and the bits of an end.  Without training rows every token is as
    likely as any.  Repeated rows each keep their row; an empty table gives none.
    """
    docs = texts(df, id_col, text_col)
    shared = df.sparkSession.sparkContext.broadcast(model.mixing)

    def measure():
        mixed = shared.value

        def of(run: list[str]) -> list[tuple]:
            closed = [mixing.closed(t) for t in run]
            bits = mixed.costs(closed).tolist()
            return [(float(len(c) - 1), float(len(c[:-1].split())), cost) for c, cost in zip(closed, bits)]

        return of

    sums = piece_sums(
        docs, None, model.lexicon, ["log_count", "known"], measure, ["n_bytes", "n_words", "bits"],
        cut_many=lower_words,
    )
    end = math.log10(model.n_docs + 0.1)
    each = math.log10(model.n_tokens + 0.1 * (model.n_distinct + 1))
    known = F.coalesce("total_known", F.lit(0.0))
    unknown = F.col("n_words") - known
    base = F.coalesce("total_log_count", F.lit(0.0)) - unknown + end - (F.col("n_words") + 1) * each
    return sums.select(
        "id", F.col("n_bytes").cast("bigint").alias("n_bytes"),
        (F.col("n_words") + 1).cast("bigint").alias("n_tokens"),
        (F.round(known) + int(model.n_docs > 0)).cast("bigint").alias("n_known"),
        base.alias("base_score"), "bits",
        (F.col("bits") / F.greatest("n_bytes", F.lit(1.0))).alias("bits_per_byte"),
        F.explode(F.sequence(F.lit(1).cast("bigint"), "copies")).alias("_copy"),
    ).drop("_copy")

