"""Evaluation: RMSE, precision / recall, coverage, and the metrics table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import columns as C
from ..functions import fixed_text, safe_ratio


def one_row(
    counts: Mapping[str, DataFrame] | None = None,
    means: Mapping[str, tuple[DataFrame, Column]] | None = None,
) -> DataFrame:
    """Several global statistics of different frames in one aggregate, one row.

    ``counts``: name -> frame whose rows are counted (pass a distinct
    projection to count distinct keys).  ``means``: name -> (frame, column)
    averaged.  The sources are tagged and unioned, then reduced by a single
    aggregate with map-side combine: one job, no joins between the results.
    """
    counts, means = dict(counts or {}), dict(means or {})
    parts = []
    for k, df in enumerate(counts.values()):
        parts.append(df.select(F.lit(k).alias("_src"), F.lit(None).cast("double").alias("_x")))
    base = len(counts)
    for k, (df, col) in enumerate(means.values()):
        parts.append(df.select(F.lit(base + k).alias("_src"), col.cast("double").alias("_x")))
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    aggs = [F.count(F.when(F.col("_src") == k, F.lit(1))).alias(name) for k, name in enumerate(counts)]
    aggs += [F.avg(F.when(F.col("_src") == base + k, F.col("_x"))).alias(name) for k, name in enumerate(means)]
    return rows.agg(*aggs)


def rating_rmse(df: DataFrame, *, rating: str = C.SCORE, prediction: str = C.PREDICTION) -> DataFrame:
    """One row, RMSE = sqrt(mean((prediction - rating)^2)); null on empty input."""
    err = F.col(prediction).cast("double") - F.col(rating).cast("double")
    return df.agg(F.sqrt(F.avg(err * err)).alias("RMSE"))


def squared_error(rating: str = C.SCORE, prediction: str = C.PREDICTION) -> Column:
    err = F.col(prediction).cast("double") - F.col(rating).cast("double")
    return err * err


def precision_recall(recs: DataFrame, holdout: DataFrame, *, keys: Sequence[str] = (C.USER_ID, C.PRODUCT_CODE)) -> DataFrame:
    """tp = recommended pairs present in the hold-out; precision = tp / recommended rows,
    recall = tp / distinct hold-out pairs.  One row: TP, NUM_RECOMMENDED, NUM_HOLDOUT, PRECISION, RECALL.
    """
    keys = list(keys)
    actual = holdout.select(*keys).distinct()
    hits = recs.select(*keys).join(actual, keys, "left_semi")
    row = one_row(counts={"TP": hits, "NUM_RECOMMENDED": recs, "NUM_HOLDOUT": actual})
    return row.select(
        "TP",
        "NUM_RECOMMENDED",
        "NUM_HOLDOUT",
        safe_ratio("TP", "NUM_RECOMMENDED").alias("PRECISION"),
        safe_ratio("TP", "NUM_HOLDOUT").alias("RECALL"),
    )


def catalog_coverage(recs: DataFrame, catalog: DataFrame, *, item: str = C.PRODUCT_CODE) -> DataFrame:
    """Distinct recommended items / distinct catalogue items (one row)."""
    row = one_row(
        counts={
            "NUM_RECOMMEND_ITEMS": recs.select(item).distinct(),
            "NUM_ITEMS": catalog.select(item).distinct(),
        }
    )
    return row.select("NUM_RECOMMEND_ITEMS", "NUM_ITEMS", safe_ratio("NUM_RECOMMEND_ITEMS", "NUM_ITEMS").alias("COVERAGE"))


def metrics_table(stats: DataFrame, entries: Sequence[tuple[str, Column | str | int | float]]) -> DataFrame:
    """(metric, value) rows, in the given order, from a one-row ``stats`` frame.

    Values are columns over ``stats`` or literals; everything is rendered as
    text (the reference's metrics file is text).
    """
    cells = []
    for pos, (name, value) in enumerate(entries):
        v = value if isinstance(value, Column) else F.lit(str(value))
        cells.append(F.struct(F.lit(pos).alias("_pos"), F.lit(name).alias(C.METRIC), v.cast("string").alias(C.VALUE)))
    return stats.select(F.inline(F.array(*cells))).orderBy("_pos").drop("_pos")


def ratio_text(num: str | Column, den: str | Column, digits: int = 9) -> Column:
    """Fixed-point text of num / den; 'NaN' for 0 / 0 as the reference prints it."""
    return F.coalesce(fixed_text(safe_ratio(num, den), digits), F.lit("NaN"))


def number_text(c: str | Column, digits: int = 9) -> Column:
    return F.coalesce(fixed_text(c, digits), F.lit("NaN"))


def metrics_lines(metrics: DataFrame) -> DataFrame:
    """The metrics table as ``"label : value"`` text lines (for ``sinks.write_text``)."""
    return metrics.select(F.concat_ws(" : ", F.col(C.METRIC), F.col(C.VALUE)).alias("value"))
