"""Ratings: averaged explicit ratings, dense id index, multi-source preference, user vectors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import columns as C
from ..functions import fixed, present
from ..session import cut_lineage
from .cleansing import fill_item_from_resource
from .skew import salted_join


def avg_ratings(
    scores: DataFrame,
    resource_map: DataFrame | None = None,
    *,
    dedupe_map: bool = False,
) -> DataFrame:
    """Mean explicit score per (user, item) -> USER_ID, PRODUCT_CODE, SCORE (double).

    Missing items are filled from the resource map first; rows without a
    user, an item or a parsable score are dropped.  ``groupBy().agg(avg)``
    combines map-side, so a hot (user, item) never travels as raw rows.
    """
    cols = [C.USER_ID, C.PRODUCT_CODE, C.SCORE]
    base = scores.select(*(cols + ([C.RES_ID] if resource_map is not None else [])))
    if resource_map is not None:
        base = fill_item_from_resource(base, resource_map, dedupe_map=dedupe_map)
    clean = (
        base.filter(F.col(C.USER_ID).isNotNull() & F.col(C.PRODUCT_CODE).isNotNull() & present(C.SCORE))
        .withColumn(C.SCORE, F.col(C.SCORE).try_cast("double"))
        .filter(F.col(C.SCORE).isNotNull())
    )
    return clean.groupBy(C.USER_ID, C.PRODUCT_CODE).agg(F.avg(C.SCORE).alias(C.SCORE))


def dense_index(df: DataFrame, id_col: str, index_col: str) -> DataFrame:
    """Distinct ids -> 0..n-1 in id order, without funnelling ids through one task.

    The distinct ids are range-partitioned and sorted; every row gets its
    position inside its partition (``monotonically_increasing_id``), the
    per-partition row counts (one row per partition) give each partition's
    offset.  The tagged ids are checkpointed to the shared checkpoint folder so
    that both uses see the same partitioning even after an executor loss.
    """
    ids = df.select(id_col).filter(F.col(id_col).isNotNull()).distinct().orderBy(id_col)
    tagged = cut_lineage(
        ids.withColumn("_part", F.spark_partition_id()).withColumn("_pos", F.monotonically_increasing_id())
    )
    sizes = tagged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_first"))
    # One row per partition: a whole-frame window over it is bounded by the partition count.
    offsets = sizes.withColumn(
        "_offset", F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    ).select("_part", "_first", F.coalesce(F.col("_offset"), F.lit(0)).alias("_offset"))
    return tagged.join(F.broadcast(offsets), "_part").select(
        F.col(id_col), (F.col("_offset") + F.col("_pos") - F.col("_first")).cast("long").alias(index_col)
    )


def id_index(df: DataFrame, id_col: str, index_col: str) -> DataFrame:
    """(id, int index) for models that need int ids (ALS users / items, k-means labels).

    The dense index, narrowed to int; more than 2^31 - 1 distinct ids are an
    error, as those models cannot take them.
    """
    index = dense_index(df, id_col, index_col)
    too_many = F.raise_error(F.lit(f"{id_col}: more distinct ids than an int index holds"))
    return index.select(id_col, F.when(F.col(index_col) < 2**31 - 1, F.col(index_col)).otherwise(too_many).cast("int").alias(index_col))


def preference_scores(
    scores: DataFrame,
    implicit_logs: Sequence[tuple[DataFrame, float]],
    resource_map: DataFrame | None = None,
) -> DataFrame:
    """Multi-source preference score per (user, item).

    explicit = mean score per (user, item); user mean = mean of that user's
    per-item means; implicit = sum over the other logs' rows of the log's
    weight (duplicates add up).  Score = explicit - user mean where an explicit
    score exists, else implicit.  The implicit part is summed as
    ``weight * row count`` per log, which is exact and order-independent.
    """
    explicit = avg_ratings(scores, resource_map)
    user_mean = explicit.groupBy(C.USER_ID).agg(F.avg(C.SCORE).alias("_mean"))
    centered = salted_join(explicit, user_mean, [C.USER_ID], [C.PRODUCT_CODE]).select(
        C.USER_ID, C.PRODUCT_CODE, (F.col(C.SCORE) - F.col("_mean")).alias("_explicit")
    )
    parts = []
    for k, (log, _) in enumerate(implicit_logs):
        base = log.select(C.USER_ID, C.PRODUCT_CODE, *([C.RES_ID] if resource_map is not None else []))
        if resource_map is not None:
            base = fill_item_from_resource(base, resource_map)
        parts.append(base.filter(F.col(C.USER_ID).isNotNull()).withColumn("_log", F.lit(k)))
    if parts:
        rows = parts[0]
        for p in parts[1:]:
            rows = rows.unionByName(p)
        weighted = [
            F.lit(float(w)) * F.count(F.when(F.col("_log") == k, F.lit(1)))
            for k, (_, w) in enumerate(implicit_logs)
        ]
        total = weighted[0]
        for term in weighted[1:]:
            total = total + term
        implicit = rows.groupBy(C.USER_ID, C.PRODUCT_CODE).agg(total.alias("_implicit"))
        merged = centered.join(implicit, [C.USER_ID, C.PRODUCT_CODE], "full_outer")
        score = F.coalesce(F.col("_explicit"), F.col("_implicit"))
    else:
        merged, score = centered, F.col("_explicit")
    return merged.select(C.USER_ID, C.PRODUCT_CODE, fixed(score, 9).alias(C.SCORE))


def _sparse(size: int, entries: str) -> Column:
    """Sparse vector of the sorted (item, score) structs in column ``entries``.

    Spark SQL has no constructor of sparse vectors, but its JSON reader fills
    the fields of their type; doubles come back as they were and no row goes
    through Python.  Repeated, missing or too large items and null scores are
    an error, as they are for the vector's own class.
    """
    items = F.transform(entries, lambda e: e["item"].cast("int"))
    scores = F.transform(entries, lambda e: e["score"].cast("double"))
    fields = F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(size).cast("int").alias("size"), items.alias("indices"), scores.alias("values"))
    bad = F.exists(entries, lambda e: e["item"].isNull() | e["score"].isNull() | (e["item"] < 0) | (e["item"] >= size))
    sound = (F.size(F.array_distinct(items)) == F.size(entries)) & ~bad
    checked = F.when(sound, F.to_json(F.struct(fields.alias("v")))).otherwise(F.raise_error(F.lit("items of a user must be unique and within the catalogue, scores present")))
    return F.from_json(checked, T.StructType([T.StructField("v", VectorUDT())]), {"mode": "FAILFAST"})["v"]


def user_vectors(indexed: DataFrame, *, n_items: int, user_col: str = "u", item_col: str = "i", score_col: str = C.SCORE) -> DataFrame:
    """One sparse rating vector per user: (label, features).

    Entries are gathered per user with ``collect_list`` (a user has at most one
    entry per item, so a row is bounded by the catalogue size); the conversion
    array -> vector stays in Spark's engine.  Explicit zeros stay.
    """
    entries = F.sort_array(F.collect_list(F.struct(F.col(item_col).alias("item"), F.col(score_col).alias("score"))))
    grouped = indexed.groupBy(user_col).agg(entries.alias("_e"))
    return grouped.select(F.col(user_col).alias("label"), _sparse(n_items, "_e").alias("features"))
