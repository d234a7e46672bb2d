"""Incremental implicit preference: weighted behaviour counts per (user, item).

The implicit part of the multi-source preference score (sum over the rows
of each behaviour log of that log's weight) is an additive aggregate, so it
can be kept up to date as hourly log files arrive: ``readStream`` over the
log folders, a stream-static join with the resource map, and a stateful
``groupBy(user, item)`` whose per-log counts live in the state store.  Each
trigger emits the (user, item) rows whose sums changed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from .. import columns as C
from ..operators.cleansing import fill_item_from_resource


def read_log_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    *,
    fmt: str = "parquet",
    file_glob: str | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """A behaviour log folder as a stream of newly arriving files."""
    reader = spark.readStream.format(fmt).schema(schema)
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def implicit_score_updates(
    logs: Sequence[tuple[DataFrame, float]],
    resource_map: DataFrame | None = None,
) -> DataFrame:
    """Streaming (USER_ID, PRODUCT_CODE, implicit score) with per-log counts in state.

    ``logs`` are streaming frames with USER_ID, PRODUCT_CODE (and RES_ID when
    a static ``resource_map`` is given) and their weights.  The score is
    ``sum(weight_k * count_k)``, the same expression as the batch operator.
    """
    parts = []
    for k, (log, _) in enumerate(logs):
        base = log.select(C.USER_ID, C.PRODUCT_CODE, *([C.RES_ID] if resource_map is not None else []))
        if resource_map is not None:
            base = fill_item_from_resource(base, resource_map)
        parts.append(base.filter(F.col(C.USER_ID).isNotNull()).withColumn("_log", F.lit(k)))
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    terms = [F.lit(float(w)) * F.count(F.when(F.col("_log") == k, F.lit(1))) for k, (_, w) in enumerate(logs)]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return rows.groupBy(C.USER_ID, C.PRODUCT_CODE).agg(total.alias("IMPLICIT_SCORE"))


def start_implicit_scores(
    updates: DataFrame,
    target: str,
    checkpoint_location: str,
    *,
    processing_time: str | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Write each trigger's changed rows to ``target``/batch=<id> (exactly once per batch id).

    The latest value of a (user, item) is the row from the highest batch id.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    writer = updates.writeStream.outputMode("update").option("checkpointLocation", checkpoint_location).foreachBatch(write_batch)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def latest_implicit_scores(spark: SparkSession, target: str) -> DataFrame:
    """Current implicit score per (user, item): the row of the newest batch."""
    from pyspark.sql import Window

    df = spark.read.parquet(target)
    w = Window.partitionBy(C.USER_ID, C.PRODUCT_CODE).orderBy(F.col("batch").desc())
    return df.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r", "batch")
