"""Running totals over groups of any size, without one task per group.

A group is cut into cells by a hash of the row's key.  Cell totals are summed
by a combining aggregate, their offsets come from a window over cells alone
(``cells`` rows a group), and each row's place is its cell's offset plus its
place inside the cell.  So no task holds more than one cell of a group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_totals(df: DataFrame, group: list[str], cell: list[Column], order: list[Column], size: str) -> DataFrame:
    """Add ``before`` (sum of ``size`` over all earlier rows of the group) and ``rank`` (their count).

    Rows are ordered by ``cell`` (columns computed from the row), then ``order``.
    Group and cell values must not be null.  The join to the offsets and the
    window share one shuffle on (group, cell).
    """
    names = [f"_cell{i}" for i in range(len(cell))]
    df = df.withColumns(dict(zip(names, cell)))
    totals = df.groupBy(*group, *names).agg(F.sum(size).alias("_size"), F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy(*group).orderBy(*names).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *group,
        *names,
        F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_size0"),
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_rows0"),
    )
    inside = Window.partitionBy(*group, *names).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        df.join(offsets, [*group, *names])
        .withColumns(
            {
                "before": F.coalesce(F.sum(size).over(inside), F.lit(0)) + F.col("_size0"),
                "rank": F.coalesce(F.count(F.lit(1)).over(inside), F.lit(0)) + F.col("_rows0"),
            }
        )
        .drop(*names, "_size0", "_rows0")
    )
