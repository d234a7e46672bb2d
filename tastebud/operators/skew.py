"""Joins of rows to a table with one row per key, where one key may hold a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Parts that the rows of every key are spread over.
SALTS = 8


def salted_join(rows: DataFrame, keyed: DataFrame, on: Sequence[str], by: Sequence[str], how: str = "inner", salts: int = SALTS) -> DataFrame:
    """Join ``rows`` to ``keyed`` on ``on``, a key's rows spread by a hash of the ``by`` columns.

    ``keyed`` is small against the rows (one row per key) and is repeated per
    part.  The part number in the key puts an exchange of its own under both
    sides of the join, so adaptive execution can also split the parts of a hot
    key further: without it the aggregate that makes ``keyed`` would share its
    exchange with the join, a shape that is not split.
    """
    part = F.pmod(F.xxhash64(*by), F.lit(salts)).cast("int")
    spread = keyed.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return rows.withColumn("_part", part).join(spread, [*on, "_part"], how).drop("_part")
