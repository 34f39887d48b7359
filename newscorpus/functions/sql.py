"""The text functions as SQL functions.

They are SQL-bodied, so Catalyst inlines them into the calling plan; no Python
worker is involved.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

FUNCTIONS = [
    r"""CREATE OR REPLACE TEMPORARY FUNCTION word_count(t STRING)
        RETURNS BIGINT
        RETURN array_size(array_remove(split(t, '\\s+'), ''))""",
    r"""CREATE OR REPLACE TEMPORARY FUNCTION rouge_tokens(t STRING)
        RETURNS ARRAY<STRING>
        RETURN array_remove(split(lower(t), '[^a-z0-9]+'), '')""",
    """CREATE OR REPLACE TEMPORARY FUNCTION ema(v ARRAY<DOUBLE>, alpha DOUBLE)
        RETURNS ARRAY<DOUBLE>
        RETURN aggregate(v, CAST(array() AS ARRAY<DOUBLE>), (acc, x) -> concat(acc, array(
          CASE WHEN size(acc) = 0 THEN x
               ELSE alpha * x + (1 - alpha) * element_at(acc, -1) END)))""",
    r"""CREATE OR REPLACE TEMPORARY FUNCTION chunk_text(t STRING, n INT)
        RETURNS TABLE(chunk_no INT, chunk STRING)
        RETURN SELECT c.pos, c.col FROM (
          SELECT posexplode(transform(
            filter(sequence(0, CAST((size(w) - 1) DIV n AS INT)), i -> size(w) > 0),
            i -> array_join(slice(w, i * n + 1, n), ' ')))
          FROM (SELECT array_remove(split(t, '\\s+'), '') AS w)) AS c""",
]


def register(spark: SparkSession) -> None:
    """Create word_count, rouge_tokens, ema and the table function chunk_text.

    ``ema`` is for series held in one array; long series are a DataFrame job, see
    ``operators.series.ema``.
    """
    for statement in FUNCTIONS:
        spark.sql(statement)
