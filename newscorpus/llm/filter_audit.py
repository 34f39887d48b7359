"""What each filter of a chain removes, in every order the chain could take.

Applied filters form a subset lattice: a state is the set of filters applied so
far, an edge applies one more.  What an edge removes depends on its state only,
so all orders share ``n * 2**(n-1)`` edges.  Counting the orders that reach a
state (forward) and that go on from it to the end (backward) says how many
orders use an edge: those weights give Shapley sums, and an order's steps are
read from the edges on its path.

Spark counts rows by part and failure mask, with partial sums; what is left is
at most ``2**n`` rows a part, and one small group per part goes over the lattice.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newscorpus.llm.common import named, saved

#: A part's result has n * n! rows.
MOST_FILTERS = 7
SPACE = r"[\x20\x09-\x0D]+"


class Lattice:
    """The states of ``n`` filters as bit sets, and how many orders pass each."""

    def __init__(self, n: int):
        self.n, self.states = n, 1 << n
        self.forward = np.zeros(self.states, np.int64)
        self.backward = np.zeros(self.states, np.int64)
        self.forward[0] = self.backward[-1] = 1
        for state, x in self.edges():
            self.forward[state | 1 << x] += self.forward[state]
        for state, x in reversed(list(self.edges())):
            self.backward[state] += self.backward[state | 1 << x]

    def edges(self) -> Iterator[tuple[int, int]]:
        """(state, filter applied next), states in an order that respects inclusion."""
        return ((state, x) for state in range(self.states) for x in range(self.n) if not state >> x & 1)

    def kept(self, by_mask: np.ndarray) -> np.ndarray:
        """Rows kept in each state, from the rows of each failure mask."""
        within = by_mask.copy()  # becomes: rows whose mask is a subset
        for x in range(self.n):
            above = np.flatnonzero(np.arange(self.states) >> x & 1)
            within[above] += within[above ^ 1 << x]
        return within[::-1]  # a state keeps the rows whose mask lies in its complement

    def removed(self, by_mask: np.ndarray) -> np.ndarray:
        """[state, filter]: rows that the edge removes."""
        kept, out = self.kept(by_mask), np.zeros((self.states, self.n), np.int64)
        for state, x in self.edges():
            out[state, x] = kept[state] - kept[state | 1 << x]
        return out

    def shapley(self, removed: np.ndarray) -> np.ndarray:
        """What each filter removes, summed over all orders."""
        out = np.zeros(self.n, np.int64)
        for state, x in self.edges():
            out[x] += self.forward[state] * self.backward[state | 1 << x] * removed[state, x]
        return out


def repeats_smaller(df: DataFrame, id_col: str, digest_col: str, out: str) -> DataFrame:
    """``df`` with ``out``: whether a row of a smaller id has the same digest.

    The least ids combine before they are shuffled, and come back by a join on
    digest and id, so a large group of copies is no hot key.  A NULL id is
    smaller than all.
    """
    key, order = named(digest_col), F.struct(named(id_col).isNotNull().alias("known"), named(id_col).alias("id"))
    least = df.groupBy(key.alias("_of")).agg(F.min(order).alias("_least")).withColumn("_first", F.lit(True))
    rows = df.select(F.struct("*").alias("_row"), key.alias("_of"), order.alias("_order"))
    same = (rows["_of"] == least["_of"]) & rows["_order"].eqNullSafe(least["_least"])
    return rows.join(least, same, "left").select("_row.*", F.col("_first").isNull().alias(out))


def audit(
    df: DataFrame, failures: dict[str, Column], part: Column, marks: dict[str, Column] | None = None
) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, lost_<mark>.., shapley).

    ``failures`` says by filter name when a row of ``df`` fails (NULL: it does
    not); names are joined to ``filter_order``.  One row for every part, order
    and step, zeros included: ``kept`` after the step, ``removed`` by it,
    ``redundant`` that fail it but went before, ``unique_fails`` that fail this
    filter only, ``lost_<mark>`` removed here with the mark true, ``shapley`` the
    filter's removals summed over all orders.  Repeated rows count each; a NULL
    part is ''; an empty table has no parts.  Columns of ``df`` cannot clash:
    only the given expressions are taken.
    """
    names, marks = list(failures), marks or {}
    if not 0 < len(names) <= MOST_FILTERS:
        raise ValueError(f"between 1 and {MOST_FILTERS} filters can be audited")
    mask = sum(
        (F.coalesce(c, F.lit(False)).cast("int") * (1 << k) for k, c in enumerate(failures.values())), F.lit(0)
    )
    rows = df.select(
        F.coalesce(part.cast("string"), F.lit("")).alias("part"),
        mask.alias("mask"),
        *[F.coalesce(c, F.lit(False)).alias(f"m{k}") for k, c in enumerate(marks.values())],
    )
    sums = [F.count_if(f"m{k}").alias(f"m{k}") for k in range(len(marks))]
    counted = rows.groupBy("part", "mask").agg(F.count("*").alias("n"), *sums)
    schema = (
        "part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, "
        + "".join(f"`lost_{m}` bigint, " for m in marks)
        + "unique_fails bigint, shapley bigint"
    )

    n_marks = len(marks)

    def steps(rows: pd.DataFrame) -> pd.DataFrame:
        lattice = Lattice(len(names))

        def by_mask(column: str) -> np.ndarray:
            out = np.zeros(lattice.states, np.int64)
            out[rows["mask"]] = rows[column]
            return out

        n = by_mask("n")
        kept, removed = lattice.kept(n), lattice.removed(n)
        lost = [lattice.removed(by_mask(f"m{k}")) for k in range(n_marks)]
        shapley, out = lattice.shapley(removed), []
        for order in permutations(range(len(names))):
            state = 0
            for step, x in enumerate(order, 1):
                out.append(
                    (
                        rows["part"].iloc[0],
                        "".join(names[y] for y in order),
                        step,
                        kept[state | 1 << x],
                        removed[state, x],
                        removed[0, x] - removed[state, x],
                        *[of[state, x] for of in lost],
                        n[1 << x],
                        shapley[x],
                    )
                )
                state |= 1 << x
        return pd.DataFrame(out, columns=[f.split()[0].strip("`") for f in schema.split(", ")])

    return counted.groupBy("part").applyInPandas(steps, schema)


def described(df: DataFrame, id_col: str, text_col: str, part_col: str) -> DataFrame:
    """(id, part, digest, n_words, n_distinct, n_capitals, n_chars, symbols), saved.

    Whole texts are read once; NULL is empty.  Words are runs without ASCII white
    space, so a very long text costs memory in proportion to its words.
    """
    text = F.coalesce(named(text_col), F.lit(""))
    words = F.array_remove(F.split("text", SPACE), "")
    return saved(
        df.select(named(id_col).alias("id"), named(part_col).alias("part"), text.alias("text")).select(
            "id",
            "part",
            F.unhex(F.sha2("text", 256)).alias("digest"),
            F.size(words).cast("bigint").alias("n_words"),
            F.size(F.array_distinct(words)).cast("bigint").alias("n_distinct"),
            F.regexp_count("text", F.lit("[A-Z]")).cast("bigint").alias("n_capitals"),
            F.char_length("text").cast("bigint").alias("n_chars"),
            F.col("text").rlike("[#$%&*|]").alias("symbols"),
        ),
        "described",
    )


def with_marks(rows: DataFrame, labels: DataFrame, id_col: str, mark_cols: list[str]) -> DataFrame:
    """``rows`` (id, ..) with each mark: whether a label row of that id has 1 there."""
    is_one = [F.max(F.coalesce(named(m) == 1, F.lit(False))).alias(m) for m in mark_cols]
    known = labels.groupBy(named(id_col).alias("id")).agg(*is_one)
    return rows.join(known, "id", "left")
