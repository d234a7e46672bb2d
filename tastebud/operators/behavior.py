"""Behaviour sets and baskets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import columns as C
from ..functions import epoch_ms_to_time, time_to_epoch_ms
from .cleansing import fill_item_from_resource
from .skew import salted_join


def _usable(log: DataFrame, keys: Sequence[str], resource_map: DataFrame | None) -> DataFrame:
    """Pick the key columns, fill the item from the resource map, drop rows without user or item."""
    cols = list(keys) + ([C.RES_ID] if resource_map is not None else [])
    base = log.select(*cols)
    if resource_map is not None:
        base = fill_item_from_resource(base, resource_map)
    return base.filter(F.col(C.USER_ID).isNotNull() & F.col(C.PRODUCT_CODE).isNotNull())


def positive_preferences(scores: DataFrame, resource_map: DataFrame | None = None) -> DataFrame:
    """Score rows above the user's mean score (mean over rows, strict).

    -> USER_ID, PRODUCT_CODE, SCORE (+ event_time when present).  The mean is
    a grouped aggregate (map-side combined), joined back with the user's rows
    spread over parts, so no task holds a hot user as a whole.
    """
    extra = [C.EVENT_TIME] if C.EVENT_TIME in scores.columns else []
    rows = _usable(scores, [C.USER_ID, C.PRODUCT_CODE, C.SCORE] + extra, resource_map)
    rows = rows.withColumn(C.SCORE, F.col(C.SCORE).try_cast("double"))
    means = rows.groupBy(C.USER_ID).agg(F.avg(C.SCORE).alias("_mean"))
    return salted_join(rows, means, [C.USER_ID], [C.PRODUCT_CODE, C.SCORE]).filter(F.col(C.SCORE) > F.col("_mean")).drop("_mean")


def behavior_union(
    logs: Sequence[DataFrame],
    resource_map: DataFrame | None = None,
    *,
    scores: DataFrame | None = None,
    include_scores: bool = False,
    with_time: bool = False,
) -> DataFrame:
    """Distinct (user, item[, time]) over all behaviour logs.

    Score rows enter only with ``include_scores`` (as positive preferences);
    by default, as in the reference, the score log contributes nothing.
    With ``with_time`` the key includes the event time at second precision
    (the reference keys on its DATE text).
    """
    keys = [C.USER_ID, C.PRODUCT_CODE] + ([C.EVENT_TIME] if with_time else [])
    parts = [_usable(log, keys, resource_map) for log in logs]
    if include_scores and scores is not None:
        parts.append(positive_preferences(scores, resource_map).select(*keys))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    if with_time:
        seconds = F.floor(time_to_epoch_ms(C.EVENT_TIME) / 1000) * 1000
        out = out.withColumn(C.EVENT_TIME, epoch_ms_to_time(seconds))
    return out.distinct()


def _without_oversized(rows: DataFrame, keys: Sequence[str], max_items: int) -> DataFrame:
    """Rows of the groups with fewer than ``max_items`` rows.

    Groups are counted by a map-side combined aggregate.  The oversized ones
    are few (a table of n rows has at most n / max_items), and their rows leave
    through an anti join that spreads them over parts, so a hot group's rows
    never reach the shuffle that collects baskets.
    """
    oversized = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= max_items).select(*keys)
    return salted_join(rows, oversized, keys, [C.PRODUCT_CODE], "left_anti")


def user_baskets(behavior: DataFrame, *, max_items: int = 100) -> DataFrame:
    """One basket per user over the distinct (user, item) set; 1 < size < max_items.

    -> USER_ID, ITEMS (sorted array), N_ITEMS.
    """
    pairs = behavior.select(C.USER_ID, C.PRODUCT_CODE).distinct()
    items = _without_oversized(pairs, [C.USER_ID], max_items).groupBy(C.USER_ID).agg(
        F.count(F.lit(1)).alias("N_ITEMS"), F.array_sort(F.collect_set(C.PRODUCT_CODE)).alias("ITEMS")
    )
    return items.filter(F.col("N_ITEMS") > 1).select(C.USER_ID, "ITEMS", "N_ITEMS")


def bucket_baskets(behavior: DataFrame, *, max_items: int = 100, bucket_col: str = "BUCKET") -> DataFrame:
    """One basket per (user, time bucket).

    The size test counts distinct (user, item, time) rows, 1 < rows <
    max_items; items are de-duplicated afterwards, so a basket may hold a
    single item (as in the reference).  -> USER_ID, BUCKET, ITEMS, N_ROWS.
    """
    keys = [C.USER_ID, bucket_col]
    items = _without_oversized(behavior, keys, max_items).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("N_ROWS"), F.array_sort(F.collect_set(C.PRODUCT_CODE)).alias("ITEMS")
    )
    return items.filter(F.col("N_ROWS") > 1).select(C.USER_ID, bucket_col, "ITEMS", "N_ROWS")
