"""Cleansing: bulk casts, item fill from the resource map, column profile."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import columns as C
from ..functions import present, safe_ratio


def cast_columns(df: DataFrame, columns: Sequence[str], dtype: str) -> DataFrame:
    """Cast several columns to one type; values that do not parse become null.

    ``try_cast`` keeps ANSI mode on for everything else ("" -> null instead of
    a failed job).
    """
    return df.withColumns({c: F.col(c).try_cast(dtype) for c in columns})


def fill_item_from_resource(
    log: DataFrame,
    resource_map: DataFrame,
    *,
    item: str = C.PRODUCT_CODE,
    link: str = C.RES_ID,
    dedupe_map: bool = False,
) -> DataFrame:
    """Fill a missing item from the resource -> item map, then drop rows still missing.

    Left join on the resource id.  A resource with n products multiplies every
    matching log row by n, rows that already had an item included (the
    reference's fan-out); ``dedupe_map`` keeps one product per resource
    (the smallest) instead.  "" counts as present.  The map is joined by
    key: Adaptive Query Execution broadcasts it when its measured size is
    small and splits hot resource ids otherwise.
    """
    fill = resource_map.select(F.col(link), F.col(item).alias("_fill"))
    if dedupe_map:
        fill = fill.groupBy(link).agg(F.min("_fill").alias("_fill"))
    joined = log.join(fill, on=link, how="left")
    return (
        joined.withColumn(item, F.coalesce(F.col(item), F.col("_fill")))
        .drop(link, "_fill")
        .filter(F.col(item).isNotNull())
    )


def column_profile(df: DataFrame) -> DataFrame:
    """Per column: share of missing values, distinct present values, share of the top value.

    One unpivot + two grouped aggregations (both with map-side combine), in
    place of two jobs per column.  Output sorted by ``nonePercent``.
    """
    names = df.columns
    as_text = df.select(*[F.col(f"`{n}`").cast("string").alias(n) for n in names])
    long = as_text.unpivot([], names, "cname", "v")
    per_value = long.groupBy("cname", "v").agg(F.count(F.lit(1)).alias("n"))
    ok = present("v")
    per_col = per_value.groupBy("cname").agg(
        F.sum("n").alias("total"),
        F.sum(F.when(ok, F.col("n")).otherwise(0)).alias("filled"),
        F.count(F.when(ok, F.lit(1))).alias("dispersion"),
        F.max(F.when(ok, F.col("n"))).alias("top"),
    )
    return per_col.select(
        "cname",
        safe_ratio(F.col("total") - F.col("filled"), "total").alias("nonePercent"),
        F.col("dispersion").cast("long").alias("dispersion"),
        F.coalesce(safe_ratio("top", "filled"), F.lit(0.0)).alias("modePercent"),
    ).orderBy("nonePercent", "cname")
