"""Column-name vocabulary and log schemas shared by every operator.

Fixed values: these names are the engine's data contract for behaviour logs
and products, and must stay as written so that products written by one run
can be read back by another (sinks -> ``read_results``).
"""

from __future__ import annotations

from pyspark.sql import types as T

# Log and product column names.
USER_ID = "USER_ID"
PERSON_ID = "PERSON_ID"
PRODUCT_CODE = "PRODUCT_CODE"
RES_ID = "RES_ID"
NAME = "NAME"
ACCOUNT = "ACCOUNT"
PRODUCT_NAME = "PRODUCT_NAME"
CREATE_TIME = "CREATE_TIME"
SCORE = "SCORE"
SCORE_TIME = "SCORE_TIME"
DATE = "DATE"
ANTECEDENT = "ANTECEDENT"
CONSEQUENT = "CONSEQUENT"
CONFIDENCE = "CONFIDENCE"
RANK = "RANK"
PREDICTION = "prediction"
SIMILARITY = "simularity"
J_PRODUCT_CODE = "j_PRODUCT_CODE"
SCORE_SUM = "score_sum"
OP_TIME = "op_time"
METRIC = "metric"
VALUE = "value"

# Typed event time derived from CREATE_TIME / SCORE_TIME (wall clock, UTC).
EVENT_TIME = "event_time"

# Raw behaviour log (download / collect logs): epoch milliseconds.
BEHAVIOR_LOG_SCHEMA = T.StructType(
    [
        T.StructField(USER_ID, T.StringType()),
        T.StructField(RES_ID, T.StringType()),
        T.StructField(PRODUCT_CODE, T.StringType()),
        T.StructField(CREATE_TIME, T.LongType()),
    ]
)

# Raw score log: adds an explicit score and the time it was given.
SCORE_LOG_SCHEMA = T.StructType(
    [
        T.StructField(USER_ID, T.StringType()),
        T.StructField(RES_ID, T.StringType()),
        T.StructField(PRODUCT_CODE, T.StringType()),
        T.StructField(SCORE, T.StringType()),
        T.StructField(SCORE_TIME, T.LongType()),
    ]
)

RESOURCE_MAP_SCHEMA = T.StructType(
    [
        T.StructField(RES_ID, T.StringType()),
        T.StructField(PRODUCT_CODE, T.StringType()),
    ]
)
