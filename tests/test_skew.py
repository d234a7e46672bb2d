"""Hot keys: one resource / user holds a third of all rows."""

import pytest
from pyspark.sql import functions as F

from tastebud import columns as C
from tastebud.operators.cleansing import fill_item_from_resource
from tastebud.operators.behavior import bucket_baskets, positive_preferences, user_baskets
from tastebud.operators.cosine import corated_pairs
from tastebud.operators.ratings import preference_scores
from tastebud.operators.segments import segment_recommendations
from tastebud.operators.skew import SALTS, salted_join

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def _with_conf(spark, conf):
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    return old


def _restore(spark, old):
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_hot_resource_is_split_by_adaptive_skew_join(spark):
    n = 30_000
    log = spark.range(n).select(
        F.col("id").cast("string").alias(C.USER_ID),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("r"), (F.col("id") % 997).cast("string"))).alias(C.RES_ID),
        F.lit(None).cast("string").alias(C.PRODUCT_CODE),
    )
    rmap = spark.range(997).select(F.concat(F.lit("r"), F.col("id").cast("string")).alias(C.RES_ID), F.col("id").cast("string").alias(C.PRODUCT_CODE))
    rmap = rmap.unionByName(spark.createDataFrame([("hot", "H")], "RES_ID string, PRODUCT_CODE string"))
    old = _with_conf(spark, SKEW_CONF)
    try:
        out = fill_item_from_resource(log, rmap)
        plan = out._jdf.queryExecution().executedPlan().toString()
        rows_out = out.collect()  # runs this plan; AQE then holds its final form
        final = out._jdf.queryExecution().executedPlan().toString()
        got = {True: sum(r[C.PRODUCT_CODE] == "H" for r in rows_out), False: sum(r[C.PRODUCT_CODE] != "H" for r in rows_out)}
    finally:
        _restore(spark, old)
    assert got == {True: -(-n // 3), False: n - -(-n // 3)}
    assert "SortMergeJoin" in plan
    assert "skew=true" in final


def test_hot_user_pairs_spread_over_blocks(spark):
    # one user rates 60 items (a third of all rows), 40 users rate 3 each
    data = [("hot", f"i{k}", float(1 + k % 5)) for k in range(60)]
    data += [(f"u{u}", f"i{(u * 7 + k) % 60}", float(1 + (u + k) % 5)) for u in range(40) for k in range(3)]
    r = spark.createDataFrame(data, "USER_ID string, PRODUCT_CODE string, SCORE double")
    plain = corated_pairs(r, min_commons=1, block_rows=10_000)
    blocked = corated_pairs(r, min_commons=1, block_rows=8)  # the hot user -> 8 x 8 blocks
    key = [C.PRODUCT_CODE, C.J_PRODUCT_CODE]
    a = {tuple(x[k] for k in key): (round(x["cross"], 9), x["n_commons"]) for x in plain.collect()}
    b = {tuple(x[k] for k in key): (round(x["cross"], 9), x["n_commons"]) for x in blocked.collect()}
    assert a == b and len(a) >= 60 * 59 // 2


N = 12_000


def _hot_scores(spark):
    """A third of all rows on one user, every row another item."""
    user = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("u"), (F.col("id") % 997).cast("string")))
    return spark.range(N).select(user.alias(C.USER_ID), F.concat(F.lit("p"), "id").alias(C.PRODUCT_CODE), (F.col("id") % 5 + 1.0).alias(C.SCORE))


def _segments(spark):
    return _hot_scores(spark).select(F.col(C.PRODUCT_CODE).alias(C.USER_ID), F.col(C.USER_ID).alias(C.PREDICTION))


OPERATORS = {
    "positive_preferences": lambda s: positive_preferences(_hot_scores(s)),
    "preference_scores": lambda s: preference_scores(_hot_scores(s), []),
    "user_baskets": lambda s: user_baskets(_hot_scores(s), max_items=100),
    "bucket_baskets": lambda s: bucket_baskets(_hot_scores(s).withColumn("BUCKET", F.lit(1)), max_items=100),
    "corated_pairs": lambda s: corated_pairs(
        _hot_scores(s).withColumn(C.PRODUCT_CODE, F.expr("cast(substr(PRODUCT_CODE, 2) as long)")).filter("PRODUCT_CODE < 1500"), block_rows=64
    ),
    "segment_recommendations": lambda s: segment_recommendations(
        _segments(s), _segments(s).select(C.PREDICTION).distinct().select(C.PREDICTION, F.lit("x").alias(C.PRODUCT_CODE), F.lit(1).alias(C.RANK))
    ),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_hot_key_rows_are_dealt_by_parts(spark, name):
    """No shuffle join of the rows on the key alone and no window over a key; adaptive execution may split further."""
    old = _with_conf(spark, SKEW_CONF)
    try:
        out = OPERATORS[name](spark)
        out.collect()
        final = out._jdf.queryExecution().executedPlan().toString()
    finally:
        _restore(spark, old)
    joins = [line for line in final.splitlines() if "SortMergeJoin" in line or "ShuffledHashJoin" in line]
    assert joins and "Window" not in final
    for line in joins:
        assert "_part" in line or "_a" in line or C.PRODUCT_CODE in line, line
    assert any("_part" in line for line in joins)


def test_largest_task_of_a_salted_join(spark):
    """The hot user's rows spread over SALTS partitions even without adaptive execution."""
    old = _with_conf(spark, SKEW_CONF | {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "64"})
    try:
        rows_ = _hot_scores(spark)
        means = rows_.groupBy(C.USER_ID).agg(F.avg(C.SCORE).alias("m"))
        out = salted_join(rows_, means, [C.USER_ID], [C.PRODUCT_CODE])
        per_task = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("t")).count().collect()]
    finally:
        _restore(spark, old)
    assert sum(per_task) == N and max(per_task) < 3 * (N // 3) / SALTS
