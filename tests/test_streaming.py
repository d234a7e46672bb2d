import os
import tempfile

from conftest import rows
from pyspark.sql import functions as F

from tastebud import columns as C
from tastebud.operators.ratings import preference_scores
from tastebud.streaming import implicit_score_updates, latest_implicit_scores, read_log_stream, start_implicit_scores

SF = "/root/testdata/sf0.001"


def _events_stream(spark, event_type):
    schema = spark.read.parquet(f"{SF}/events.parquet").schema
    ev = read_log_stream(spark, SF, schema, file_glob="events.parquet")
    return ev.filter(F.col("event_type") == event_type).select(
        F.col("user_id").cast("string").alias(C.USER_ID), F.get_json_object("props", "$.k").alias(C.PRODUCT_CODE)
    )


def test_streaming_implicit_scores_match_batch(spark):
    root = tempfile.mkdtemp(prefix="tastebud-stream-")
    updates = implicit_score_updates([(_events_stream(spark, "click"), 0.3), (_events_stream(spark, "view"), 0.6)])
    q = start_implicit_scores(updates, os.path.join(root, "out"), os.path.join(root, "ckpt"), available_now=True)
    q.awaitTermination(300)
    got = {(r[C.USER_ID], r[C.PRODUCT_CODE]): round(r["IMPLICIT_SCORE"], 9) for r in latest_implicit_scores(spark, os.path.join(root, "out")).collect()}

    # Batch twin: with an empty explicit log the preference score is the implicit sum.
    ev = spark.read.parquet(f"{SF}/events.parquet")

    def log(t):
        return ev.filter(F.col("event_type") == t).select(
            F.col("user_id").cast("string").alias(C.USER_ID), F.get_json_object("props", "$.k").alias(C.PRODUCT_CODE)
        )

    no_scores = spark.createDataFrame([], "USER_ID string, PRODUCT_CODE string, SCORE double")
    want = {(r[0], r[1]): round(r[2], 9) for r in rows(preference_scores(no_scores, [(log("click"), 0.3), (log("view"), 0.6)]))}
    assert got == want and len(got) > 0


def test_streaming_fills_items_from_static_resource_map(spark):
    root = tempfile.mkdtemp(prefix="tastebud-stream-")
    ev = spark.read.parquet(f"{SF}/events.parquet").filter(F.col("event_type").isin("click", "view"))
    k = F.get_json_object("props", "$.k")
    log = ev.select(
        F.col("user_id").alias(C.USER_ID),
        F.concat(F.lit("R"), k).alias(C.RES_ID),
        F.when(F.col("event_id") % 2 == 0, k).alias(C.PRODUCT_CODE),  # half the rows lose their item
        F.col("event_type"),
    )
    for t in ("click", "view"):
        log.filter(F.col("event_type") == t).drop("event_type").write.parquet(os.path.join(root, "logs", t))
    rmap = ev.select(F.concat(F.lit("R"), k).alias(C.RES_ID), k.alias(C.PRODUCT_CODE)).distinct()
    schema = "USER_ID long, RES_ID string, PRODUCT_CODE string"
    streams = [(read_log_stream(spark, os.path.join(root, "logs", t), schema, max_files_per_trigger=1), w)
               for t, w in (("click", 0.3), ("view", 0.6))]
    q = start_implicit_scores(
        implicit_score_updates(streams, rmap), os.path.join(root, "out"), os.path.join(root, "ckpt"), available_now=True
    )
    q.awaitTermination(300)
    got = {(r[C.USER_ID], r[C.PRODUCT_CODE]): round(r["IMPLICIT_SCORE"], 9) for r in latest_implicit_scores(spark, os.path.join(root, "out")).collect()}
    batch_logs = [(spark.read.parquet(os.path.join(root, "logs", t)), w) for t, w in (("click", 0.3), ("view", 0.6))]
    no_scores = spark.createDataFrame([], "USER_ID long, RES_ID string, PRODUCT_CODE string, SCORE double")
    want = {(r[0], r[1]): round(r[2], 9) for r in rows(preference_scores(no_scores, batch_logs, rmap))}
    assert got == want and len(got) > 0
