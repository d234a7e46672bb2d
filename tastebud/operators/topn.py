"""One ranked top-N used by every model (rules, segments, cosine, ALS)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import columns as C


def ranked_top_n(
    df: DataFrame,
    *,
    by: str | Sequence[str],
    score: str,
    tie: str,
    n: int,
    rank_col: str = C.RANK,
) -> DataFrame:
    """Keep the ``n`` best rows per group: ``score`` descending, ``tie`` ascending.

    ``rank() <= n`` lets Catalyst insert a partial WindowGroupLimit below the
    shuffle, so each map task forwards at most ``n`` rows per group and a hot
    group never reaches the final window whole.  (group, tie) is unique in
    every caller, so rank equals row_number.
    """
    keys = [by] if isinstance(by, str) else list(by)
    order: list[Column] = [F.col(score).desc(), F.col(tie).asc()]
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank_col, F.rank().over(w)).filter(F.col(rank_col) <= n)
