"""Bind the provided parquet tables to the engine's log contract.

The engine consumes behaviour logs (user, resource, item, time), score logs
(+ score) and small dimensions.  The test tables are a shop schema and an
event stream; these functions shape them into those logs with plain
projections and joins, so every query reads the whole given tables.

Binding A  shopping log   orders x lineitem x part, item = brand
Binding B  event ratings  events (purchase / view / click), item = props.k
Binding C  purchase log   orders x lineitem, item = part key, score from quantity
Binding D  dimensions     customer / part
Binding E  resource map   part -> resource ids, with fan-out

Ids keep their source types (bigint keys here; the operators only compare,
hash and order ids), which keeps shuffle keys fixed-width.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import columns as C
from ..functions import time_to_epoch_ms


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


def shopping_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binding A: one behaviour row per order line, the item is the part's brand."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    rows = _order_lines(spark, sf_dir).join(part, F.col("l_partkey") == F.col("p_partkey"))
    return rows.select(
        F.col("o_custkey").alias(C.USER_ID),
        F.lit(None).cast("string").alias(C.RES_ID),
        F.col("p_brand").alias(C.PRODUCT_CODE),
        time_to_epoch_ms("o_orderdate").alias(C.CREATE_TIME),
        F.col("o_orderdate").alias(C.EVENT_TIME),
    )


def _quantity_score() -> F.Column:
    return (F.floor((F.col("l_quantity") - 1) / 10) + 1).cast("double")


def purchase_log(spark: SparkSession, sf_dir: str, *, with_resources: bool = False) -> DataFrame:
    """Binding C (and E): a score log of order lines, the item is the part key.

    With ``with_resources`` every third line number loses its item, which the
    resource map (``resource_map``) has to fill back in.
    """
    part_code = F.col("l_partkey")
    item = F.when(F.col("l_linenumber") % 3 == 0, F.lit(None).cast("long")).otherwise(part_code) if with_resources else part_code
    return _order_lines(spark, sf_dir).select(
        F.col("o_custkey").alias(C.USER_ID),
        F.concat(F.lit("R"), part_code.cast("string")).alias(C.RES_ID),
        item.alias(C.PRODUCT_CODE),
        _quantity_score().alias(C.SCORE),
        time_to_epoch_ms("o_orderdate").alias(C.SCORE_TIME),
        F.col("o_orderdate").alias(C.EVENT_TIME),
    )


def resource_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binding E: resource id -> product; every 50th part maps to a second product too."""
    part = table(spark, sf_dir, "part").select("p_partkey")
    res = F.concat(F.lit("R"), F.col("p_partkey").cast("string"))
    own = part.select(res.alias(C.RES_ID), F.col("p_partkey").alias(C.PRODUCT_CODE))
    extra = part.filter(F.col("p_partkey") % 50 == 0).select(res.alias(C.RES_ID), (F.col("p_partkey") + 1).alias(C.PRODUCT_CODE))
    return own.unionByName(extra).distinct()


def _events(spark: SparkSession, sf_dir: str, types: tuple[str, ...]) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("user_id", "event_type", "value", "props", "ts")
    return ev.filter(F.col("event_type").isin(*types))


def event_score_log(spark: SparkSession, sf_dir: str, types: tuple[str, ...] = ("purchase", "view")) -> DataFrame:
    """Binding B: explicit 1-5 score per event, ``least(5, 1 + floor(value / 25))``."""
    score = F.least(F.lit(5), F.floor(F.col("value") / 25) + 1).cast("double")
    return _events(spark, sf_dir, types).select(
        F.col("user_id").alias(C.USER_ID),
        F.lit(None).cast("string").alias(C.RES_ID),
        F.get_json_object("props", "$.k").alias(C.PRODUCT_CODE),
        score.alias(C.SCORE),
        time_to_epoch_ms("ts").alias(C.SCORE_TIME),
        F.col("ts").alias(C.EVENT_TIME),
    )


def event_log(spark: SparkSession, sf_dir: str, event_type: str | None = None) -> DataFrame:
    """Binding B implicit logs: ``click`` plays the download log, ``view`` the collect log; all events without a type."""
    rows = table(spark, sf_dir, "events") if event_type is None else _events(spark, sf_dir, (event_type,))
    return rows.select(
        F.col("user_id").alias(C.USER_ID),
        F.lit(None).cast("string").alias(C.RES_ID),
        F.get_json_object("props", "$.k").alias(C.PRODUCT_CODE),
        time_to_epoch_ms("ts").alias(C.CREATE_TIME),
        F.col("ts").alias(C.EVENT_TIME),
    )


def user_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binding D: PERSON_ID, NAME."""
    cust = table(spark, sf_dir, "customer")
    return cust.select(F.col("c_custkey").alias(C.PERSON_ID), F.col("c_name").alias(C.NAME))


def account_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binding D: PERSON_ID, ACCOUNT."""
    cust = table(spark, sf_dir, "customer")
    return cust.select(
        F.col("c_custkey").alias(C.PERSON_ID),
        F.concat(F.lit("acct-"), F.col("c_custkey").cast("string")).alias(C.ACCOUNT),
    )


def product_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binding D: PRODUCT_CODE, PRODUCT_NAME."""
    part = table(spark, sf_dir, "part")
    return part.select(F.col("p_partkey").alias(C.PRODUCT_CODE), F.col("p_name").alias(C.PRODUCT_NAME))


def segment_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binding D: a given user segment (market segment) in the ``prediction`` column."""
    cust = table(spark, sf_dir, "customer")
    return cust.select(F.col("c_custkey").alias(C.USER_ID), F.col("c_mktsegment").alias(C.PREDICTION))
