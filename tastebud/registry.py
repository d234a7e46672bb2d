"""Registered queries over the provided tables, and their DuckDB oracle SQL.

Each query takes (spark, sf_dir) and returns a DataFrame computed from the
whole input tables (through ``sources.bindings``).  ``ORACLE`` holds, per
query, ANSI SQL that DuckDB runs on the same parquet files; column names and
types agree with the Spark result.  Queries built on iterative ML (k-means,
ALS) have no SQL twin.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import columns as C
from .operators.cosine import adjusted_cosine, corated_pairs, cosine_recommendations, predict_ratings, top_similar_items
from .operators.behavior import behavior_union, positive_preferences, user_baskets
from .operators.evaluate import catalog_coverage, precision_recall
from .operators.ratings import avg_ratings
from .operators.rules import association_rules, contained_sets, fit_itemsets, frequent_itemsets, rule_matches, rule_recommendations
from .operators.timewin import Season, bucket_events, parse_event_time, seasonal_future, seasonal_history, seasonal_window
from .plans.cosine_run import run_cosine, similar_items
from . import oracle as SQL
from .functions import fixed, time_to_epoch_ms
from .operators.cleansing import cast_columns, column_profile, fill_item_from_resource
from .operators.compare import attach_names, find_user, model_history
from .operators.evaluate import rating_rmse
from .operators.factors import als_candidates, als_cross_validation, als_fit, fold_errors
from .operators.ratings import dense_index, preference_scores, user_vectors
from .operators.segments import assign_to_centres, mean_centres, segment_item_scores, within_cluster_sums
from .operators.retrieval import pairs_above, top_pairs
from .plans.als_run import index_ratings, run_als
from .plans.compare_run import run_compare
from .plans.params import AlsParams, CosineParams, RulesParams, SegmentParams
from .plans.rules_run import run_rules, time_window_parts
from .plans.segments_run import run_clusters, run_given_segments
from .session import cut_lineage, shared_path
from .sinks import run_folder, write_delimited, write_product
from .sinks.publish import publish_run, read_published
from .sources import latest_snapshot, read_newest, read_results, scan_log, write_snapshot
from .sources import bindings as B

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

COSINE = CosineParams(**vars(SQL.COSINE_PARAMS))


def register(name: str, sql: str | None = None):
    def wrap(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn

    return wrap


def purchase_ratings(spark: SparkSession, d: str) -> DataFrame:
    return avg_ratings(B.purchase_log(spark, d))


# ------------------------------------------------------------ cosine family


@register("avg_ratings_plain", SQL.with_(SQL.PURCHASE_RATINGS) + " SELECT * FROM purchase_ratings")
def q_avg_ratings_plain(spark: SparkSession, d: str) -> DataFrame:
    return purchase_ratings(spark, d)


@register(
    "corated_pairs",
    SQL.COSINE + " SELECT PRODUCT_CODE, j_PRODUCT_CODE, n_commons FROM cs_pairs",
)
def q_corated_pairs(spark: SparkSession, d: str) -> DataFrame:
    pairs = corated_pairs(purchase_ratings(spark, d), min_commons=COSINE.min_commons)
    return pairs.select(C.PRODUCT_CODE, C.J_PRODUCT_CODE, "n_commons")


@register("adjusted_cosine", SQL.COSINE + " SELECT * FROM cs_sims")
def q_adjusted_cosine(spark: SparkSession, d: str) -> DataFrame:
    return adjusted_cosine(purchase_ratings(spark, d), min_commons=COSINE.min_commons)


@register("top_similar_items", SQL.COSINE + " SELECT * FROM cs_top")
def q_top_similar_items(spark: SparkSession, d: str) -> DataFrame:
    sims = adjusted_cosine(purchase_ratings(spark, d), min_commons=COSINE.min_commons)
    return top_similar_items(sims, min_sim=COSINE.min_sim, top_sim=COSINE.top_sim)


def _cosine_top(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return similar_items(purchase_ratings(spark, d), COSINE)


@register("predict_unrated", SQL.COSINE + " SELECT * FROM cs_pred_unrated")
def q_predict_unrated(spark: SparkSession, d: str) -> DataFrame:
    ratings, top = _cosine_top(spark, d)
    return predict_ratings(ratings, top, min_rating=COSINE.min_rating, unrated=True)


@register("predict_rated", SQL.COSINE + " SELECT * FROM cs_pred_rated")
def q_predict_rated(spark: SparkSession, d: str) -> DataFrame:
    ratings, top = _cosine_top(spark, d)
    return predict_ratings(ratings, top, min_rating=COSINE.min_rating, unrated=False)


@register("cosine_recommendations", SQL.COSINE + " SELECT * FROM cs_recs")
def q_cosine_recommendations(spark: SparkSession, d: str) -> DataFrame:
    ratings, top = _cosine_top(spark, d)
    preds = predict_ratings(ratings, top, min_rating=COSINE.min_rating, unrated=True)
    return cosine_recommendations(preds, min_rating=COSINE.min_rating, top_n=COSINE.top_n)


@register("cosine_run", SQL.COSINE_METRICS)
def q_cosine_run(spark: SparkSession, d: str) -> DataFrame:
    return run_cosine(purchase_ratings(spark, d), COSINE)["Recommendation-metrics"]


# ------------------------------------------------- seasonal split and rules

SEASON = RulesParams(**vars(SQL.SEASON_PARAMS))
FULL = RulesParams(**vars(SQL.FULL_PARAMS))
_SEASON = Season.of(SEASON.end_time, SEASON.months)


def _shop_behaviour(spark: SparkSession, d: str) -> DataFrame:
    return time_window_parts([B.shopping_log(spark, d)], SEASON)["processed"]


def _season_model(spark: SparkSession, d: str):
    parts = time_window_parts([B.shopping_log(spark, d)], SEASON)
    model = fit_itemsets(
        parts["baskets"], min_support=SEASON.min_support, min_confidence=SEASON.min_confidence,
        num_partitions=SEASON.num_partitions,
    )
    return parts, model


_EVENTS_PARSED_SQL = """
SELECT user_id AS USER_ID, json_extract_string(props, '$.k') AS PRODUCT_CODE,
       epoch_us(ts) // 1000 AS CREATE_TIME, epoch_ms(epoch_us(ts) // 1000) AS event_time,
       strftime(epoch_ms(epoch_us(ts) // 1000), '%Y-%m-%d %H:%M:%S') AS DATE
FROM events"""


@register("parse_event_time", _EVENTS_PARSED_SQL)
def q_parse_event_time(spark: SparkSession, d: str) -> DataFrame:
    raw = B.event_log(spark, d).select(C.USER_ID, C.PRODUCT_CODE, C.CREATE_TIME)
    return parse_event_time(raw)


@register("seasonal_window", SQL.SEASON_BASE + " SELECT USER_ID, PRODUCT_CODE, event_time FROM win")
def q_seasonal_window(spark: SparkSession, d: str) -> DataFrame:
    log = B.shopping_log(spark, d)
    return seasonal_window(log, _SEASON).select(C.USER_ID, C.PRODUCT_CODE, C.EVENT_TIME)


@register("seasonal_history", SQL.SEASON_BASE + " SELECT USER_ID, PRODUCT_CODE, event_time FROM hist")
def q_seasonal_history(spark: SparkSession, d: str) -> DataFrame:
    return seasonal_history(_shop_behaviour(spark, d), _SEASON)


@register("seasonal_future", SQL.SEASON_BASE + " SELECT USER_ID, PRODUCT_CODE, event_time FROM fut")
def q_seasonal_future(spark: SparkSession, d: str) -> DataFrame:
    return seasonal_future(_shop_behaviour(spark, d), _SEASON)


@register("bucket_events", SQL.SEASON_BASE + " SELECT USER_ID, PRODUCT_CODE, event_time, BUCKET FROM bk")
def q_bucket_events(spark: SparkSession, d: str) -> DataFrame:
    return bucket_events(_shop_behaviour(spark, d), days=SEASON.tran_days)


@register(
    "bucket_baskets",
    SQL.SEASON_BASE
    + """ SELECT k.USER_ID, k.BUCKET, array_to_string(list_sort(list(b.PRODUCT_CODE)), ',') AS ITEMS, k.N_ROWS
    FROM bk_kept k JOIN basket_items b USING (USER_ID, BUCKET) GROUP BY k.USER_ID, k.BUCKET, k.N_ROWS""",
)
def q_bucket_baskets(spark: SparkSession, d: str) -> DataFrame:
    baskets = time_window_parts([B.shopping_log(spark, d)], SEASON)["baskets"]
    return baskets.select(C.USER_ID, "BUCKET", F.array_join("ITEMS", ",").alias("ITEMS"), "N_ROWS")


@register("frequent_itemsets", SQL.SEASON_BASE + " SELECT ITEMS, LENGTH, FREQ FROM freq")
def q_frequent_itemsets(spark: SparkSession, d: str) -> DataFrame:
    _, model = _season_model(spark, d)
    sets = frequent_itemsets(model, max_len=10)
    return sets.select(F.array_join("ITEMS", ",").alias("ITEMS"), "LENGTH", "FREQ")


@register("association_rules", SQL.SEASON_BASE + " SELECT ANTECEDENT, CONSEQUENT, CONFIDENCE FROM rules_txt")
def q_association_rules(spark: SparkSession, d: str) -> DataFrame:
    _, model = _season_model(spark, d)
    rules = association_rules(model)
    return rules.select(F.array_join(C.ANTECEDENT, ",").alias(C.ANTECEDENT), C.CONSEQUENT, C.CONFIDENCE)


@register("user_frequent_priors", SQL.SEASON_BASE + " SELECT USER_ID, ITEMS FROM priors")
def q_user_frequent_priors(spark: SparkSession, d: str) -> DataFrame:
    parts, model = _season_model(spark, d)
    priors = contained_sets(frequent_itemsets(model).select("ITEMS"), parts["history"], set_col="ITEMS", max_size=3)
    return priors.select(C.USER_ID, F.array_join("ITEMS", ",").alias("ITEMS"))


@register("rule_matches", SQL.SEASON_BASE + " SELECT USER_ID, ANTECEDENT, CONSEQUENT, CONFIDENCE FROM matches")
def q_rule_matches(spark: SparkSession, d: str) -> DataFrame:
    parts, model = _season_model(spark, d)
    m = rule_matches(association_rules(model), parts["history"], max_antecedent=3)
    return m.select(C.USER_ID, F.array_join(C.ANTECEDENT, ",").alias(C.ANTECEDENT), C.CONSEQUENT, C.CONFIDENCE)


@register("rule_recommendations", SQL.SEASON_BASE + " SELECT USER_ID, PRODUCT_CODE, CONFIDENCE, RANK FROM recs")
def q_rule_recommendations(spark: SparkSession, d: str) -> DataFrame:
    parts, model = _season_model(spark, d)
    return rule_recommendations(association_rules(model), parts["history"], top_n=SEASON.top_n)


@register(
    "precision_recall",
    SQL.SEASON_BASE
    + """, actual AS (SELECT DISTINCT USER_ID, PRODUCT_CODE FROM fut),
    c AS (SELECT (SELECT COUNT(*) FROM recs r WHERE EXISTS (SELECT 1 FROM actual a
                  WHERE a.USER_ID = r.USER_ID AND a.PRODUCT_CODE = r.PRODUCT_CODE)) AS TP,
                 (SELECT COUNT(*) FROM recs) AS NUM_RECOMMENDED, (SELECT COUNT(*) FROM actual) AS NUM_HOLDOUT)
    SELECT TP, NUM_RECOMMENDED, NUM_HOLDOUT,
           CASE WHEN NUM_RECOMMENDED = 0 THEN NULL ELSE CAST(TP AS DOUBLE) / NUM_RECOMMENDED END AS PRECISION,
           CASE WHEN NUM_HOLDOUT = 0 THEN NULL ELSE CAST(TP AS DOUBLE) / NUM_HOLDOUT END AS RECALL FROM c""",
)
def q_precision_recall(spark: SparkSession, d: str) -> DataFrame:
    parts, model = _season_model(spark, d)
    recs = rule_recommendations(association_rules(model), parts["history"], top_n=SEASON.top_n)
    return precision_recall(recs, parts["future"])


@register(
    "catalog_coverage",
    SQL.SEASON_BASE
    + """, c AS (SELECT (SELECT COUNT(DISTINCT PRODUCT_CODE) FROM recs) AS NUM_RECOMMEND_ITEMS,
                       (SELECT COUNT(DISTINCT PRODUCT_CODE) FROM beh) AS NUM_ITEMS)
    SELECT NUM_RECOMMEND_ITEMS, NUM_ITEMS,
           CASE WHEN NUM_ITEMS = 0 THEN NULL ELSE CAST(NUM_RECOMMEND_ITEMS AS DOUBLE) / NUM_ITEMS END AS COVERAGE FROM c""",
)
def q_catalog_coverage(spark: SparkSession, d: str) -> DataFrame:
    parts, model = _season_model(spark, d)
    recs = rule_recommendations(association_rules(model), parts["history"], top_n=SEASON.top_n)
    return catalog_coverage(recs, parts["processed"])


@register("rules_time_window", SQL.SEASON_METRICS)
def q_rules_time_window(spark: SparkSession, d: str) -> DataFrame:
    return run_rules([B.shopping_log(spark, d)], SEASON, time_window=True)["Recommendation-metrics"]


def _event_behaviour_logs(spark: SparkSession, d: str) -> list[DataFrame]:
    return [B.event_log(spark, d, "click"), B.event_log(spark, d, "view")]


@register("rules_full_history", SQL.FULL_METRICS)
def q_rules_full_history(spark: SparkSession, d: str) -> DataFrame:
    return run_rules(_event_behaviour_logs(spark, d), FULL, time_window=False)["Recommendation-metrics"]


@register("behavior_union", SQL.FULL_BASE + " SELECT USER_ID, PRODUCT_CODE FROM beh_full")
def q_behavior_union(spark: SparkSession, d: str) -> DataFrame:
    return behavior_union(_event_behaviour_logs(spark, d))


@register(
    "user_baskets",
    SQL.FULL_BASE
    + """ SELECT k.USER_ID, array_to_string(list_sort(list(u.PRODUCT_CODE)), ',') AS ITEMS, k.N_ITEMS
    FROM ub_kept k JOIN user_items u USING (USER_ID) GROUP BY k.USER_ID, k.N_ITEMS""",
)
def q_user_baskets(spark: SparkSession, d: str) -> DataFrame:
    baskets = user_baskets(behavior_union(_event_behaviour_logs(spark, d)), max_items=FULL.max_items)
    return baskets.select(C.USER_ID, F.array_join("ITEMS", ",").alias("ITEMS"), "N_ITEMS")


_POSITIVE_SQL = SQL.with_(
    SQL.PURCHASES,
    """
pos AS (
  SELECT p.USER_ID, p.PRODUCT_CODE, p.SCORE FROM purchases p
  JOIN (SELECT USER_ID, AVG(SCORE) AS m FROM purchases GROUP BY 1) a ON a.USER_ID = p.USER_ID
  WHERE p.SCORE > a.m AND p.USER_ID IS NOT NULL AND p.PRODUCT_CODE IS NOT NULL
)""",
)


@register("positive_preferences", _POSITIVE_SQL + " SELECT USER_ID, PRODUCT_CODE, SCORE FROM pos")
def q_positive_preferences(spark: SparkSession, d: str) -> DataFrame:
    scores = B.event_score_log(spark, d, ("purchase",))
    return positive_preferences(scores).select(C.USER_ID, C.PRODUCT_CODE, C.SCORE)


@register(
    "behavior_union_scored",
    SQL.with_(SQL.CLICKS, SQL.VIEWS, _POSITIVE_SQL[len("WITH "):])
    + """ SELECT DISTINCT USER_ID, PRODUCT_CODE FROM (
        SELECT USER_ID, PRODUCT_CODE FROM clicks UNION ALL SELECT USER_ID, PRODUCT_CODE FROM views
        UNION ALL SELECT USER_ID, PRODUCT_CODE FROM pos) WHERE USER_ID IS NOT NULL AND PRODUCT_CODE IS NOT NULL""",
)
def q_behavior_union_scored(spark: SparkSession, d: str) -> DataFrame:
    scores = B.event_score_log(spark, d, ("purchase",))
    return behavior_union(_event_behaviour_logs(spark, d), scores=scores, include_scores=True)


# ------------------------------------------------ sources, sinks, cleansing

SEGMENT = SegmentParams(k=5, max_iter=10, top_n=10, seed=42)
ALS_PARAMS = AlsParams(rank=10, reg=0.1, max_iter=10, top_n=10, blocks=10, min_score=3.0, seed=42)


@register(
    "scan_log",
    """SELECT user_id AS USER_ID, event_type, ts FROM events
    WHERE ts >= TIMESTAMP '2024-01-08 00:00:00' AND ts < TIMESTAMP '2024-01-15 00:00:00'""",
)
def q_scan_log(spark: SparkSession, d: str) -> DataFrame:
    df = scan_log(spark, f"{d}/events.parquet", time_col="ts", since="2024-01-08 00:00:00", until="2024-01-15 00:00:00")
    return df.select(F.col("user_id").alias(C.USER_ID), "event_type", "ts")


@register(
    "latest_snapshot",
    """SELECT o_orderkey, o_custkey, o_orderdate FROM orders
    WHERE o_orderdate = (SELECT MAX(o_orderdate) FROM orders WHERE o_orderdate <= TIMESTAMP '1998-08-02 00:00:00')""",
)
def q_latest_snapshot(spark: SparkSession, d: str) -> DataFrame:
    orders = B.table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return latest_snapshot(orders, snapshot_col="o_orderdate", as_of="1998-08-02 00:00:00")


@register("latest_snapshot_folder", "SELECT c_custkey, c_name, c_mktsegment, DATE '2000-06-15' AS DAY, 5 AS HOUR FROM customer")
def q_latest_snapshot_folder(spark: SparkSession, d: str) -> DataFrame:
    """Three dumps of the customers; the newest one by a given hour is read, and only that."""
    customers = B.table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment")
    root = shared_path(spark, "tastebud-snapshots", uuid.uuid4().hex)
    write_snapshot(customers.filter("c_custkey % 2 = 0"), root, {"DAY": "2000-06-14", "HOUR": "23"})
    write_snapshot(customers, root, {"DAY": "2000-06-15", "HOUR": "05"})
    write_snapshot(customers.filter("c_custkey % 3 = 0"), root, {"DAY": "2000-06-15", "HOUR": "11"})
    return read_newest(spark, root, ["DAY", "HOUR"], as_of=["2000-06-15", "10"])


@register("published_recommendations", SQL.COSINE + " SELECT USER_ID, PRODUCT_CODE, RANK FROM cs_recs")
def q_published_recommendations(spark: SparkSession, d: str) -> DataFrame:
    """The recommendations of the last committed run."""
    products = run_cosine(purchase_ratings(spark, d), COSINE)
    root = shared_path(spark, "tastebud-published", uuid.uuid4().hex)
    names = ("User-recommendations", "Recommendation-metrics")
    publish_run({n: products[n] for n in names}, root, model="CosSim", sub_type=None, op_time=COSINE.op_time)
    return read_published(spark, root, "User-recommendations", model="CosSim", sub_type=None)


@register(
    "text_round_trip",
    "SELECT doc_id, text, CAST(coalesce(len(string_split(text, ' ')), 0) AS BIGINT) AS n FROM documents",
)
def q_text_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Whole texts and the arrays of their parts through the '#' format and back; n counts the parts read."""
    docs = B.table(spark, d, "documents").select("doc_id", "text", F.split("text", " ").alias("parts"))
    path = shared_path(spark, "tastebud-text", uuid.uuid4().hex)
    write_delimited(docs, path)
    back = read_results(spark, path, ["doc_id", "text", "parts"], types={"doc_id": "bigint", "parts": "array<string>"})
    whole = F.concat_ws(" ", "parts").eqNullSafe(F.coalesce("text", F.lit("")))
    return back.select("doc_id", "text", F.when(whole, F.coalesce(F.size("parts"), F.lit(0))).otherwise(-1).cast("long").alias("n"))


def _written_cosine_recs(spark: SparkSession, d: str) -> str:
    products = run_cosine(purchase_ratings(spark, d), COSINE)
    root = shared_path(spark, "tastebud-results", uuid.uuid4().hex)
    write_product(
        products["User-recommendations"], root, model="CosSim", sub_type=None,
        product="User-recommendations", op_time=COSINE.op_time, stamp=False,
    )
    return run_folder(root, "CosSim", None, COSINE.op_time)


@register("read_results", SQL.COSINE + " SELECT USER_ID, PRODUCT_CODE, RANK FROM cs_recs")
def q_read_results(spark: SparkSession, d: str) -> DataFrame:
    folder = _written_cosine_recs(spark, d)
    return read_results(
        spark, f"{folder}/User-recommendations", [C.USER_ID, C.PRODUCT_CODE, C.RANK],
        types={C.USER_ID: "bigint", C.PRODUCT_CODE: "bigint", C.RANK: "int"},
    )


@register(
    "cast_columns",
    """SELECT CAST(user_id AS VARCHAR) AS USER_ID,
              TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS PRODUCT_CODE,
              epoch_us(ts) // 1000 AS CREATE_TIME
    FROM events""",
)
def q_cast_columns(spark: SparkSession, d: str) -> DataFrame:
    log = B.event_log(spark, d).select(C.USER_ID, C.PRODUCT_CODE, C.CREATE_TIME)
    # JSON item text -> number, numeric user key -> text.
    return cast_columns(cast_columns(log, [C.PRODUCT_CODE], "bigint"), [C.USER_ID], "string")


def _res_log(spark: SparkSession, d: str) -> DataFrame:
    return B.purchase_log(spark, d, with_resources=True)


@register("fill_item_from_resource", SQL.with_(SQL.PURCHASE_RES) + " SELECT USER_ID, PRODUCT_CODE, SCORE FROM filled")
def q_fill_item_from_resource(spark: SparkSession, d: str) -> DataFrame:
    log = _res_log(spark, d).select(C.USER_ID, C.RES_ID, C.PRODUCT_CODE, C.SCORE)
    return fill_item_from_resource(log, B.resource_map(spark, d))


_PROFILE_COLS = [C.USER_ID, C.RES_ID, C.PRODUCT_CODE, C.SCORE, C.SCORE_TIME, C.EVENT_TIME]
_PROFILE_SQL = SQL.with_(SQL.PURCHASE_RES) + ",\nlg AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS cname, CAST({c} AS VARCHAR) AS v FROM plog" for c in _PROFILE_COLS
) + """),
pv AS (SELECT cname, v, COUNT(*) AS n FROM lg GROUP BY 1, 2),
pc AS (
  SELECT cname, SUM(n) AS total,
         SUM(CASE WHEN v IS NOT NULL AND v <> '' THEN n ELSE 0 END) AS filled,
         COUNT(CASE WHEN v IS NOT NULL AND v <> '' THEN 1 END) AS dispersion,
         MAX(CASE WHEN v IS NOT NULL AND v <> '' THEN n END) AS top
  FROM pv GROUP BY 1
)
SELECT cname, CAST(total - filled AS DOUBLE) / total AS nonePercent, dispersion,
       COALESCE(CAST(top AS DOUBLE) / filled, 0.0) AS modePercent
FROM pc"""


@register("column_profile", _PROFILE_SQL)
def q_column_profile(spark: SparkSession, d: str) -> DataFrame:
    return column_profile(_res_log(spark, d).select(*_PROFILE_COLS))


# ------------------------------------------------------------------ ratings


@register(
    "avg_ratings",
    SQL.with_(SQL.PURCHASE_RES)
    + " SELECT USER_ID, PRODUCT_CODE, AVG(SCORE) AS SCORE FROM filled WHERE USER_ID IS NOT NULL AND SCORE IS NOT NULL GROUP BY 1, 2",
)
def q_avg_ratings(spark: SparkSession, d: str) -> DataFrame:
    return avg_ratings(_res_log(spark, d), B.resource_map(spark, d))


@register(
    "dense_index",
    SQL.with_(SQL.PURCHASE_RATINGS)
    + """ SELECT USER_ID, CAST(ROW_NUMBER() OVER (ORDER BY USER_ID) - 1 AS INTEGER) AS u
    FROM (SELECT DISTINCT USER_ID FROM purchase_ratings)""",
)
def q_dense_index(spark: SparkSession, d: str) -> DataFrame:
    return dense_index(purchase_ratings(spark, d), C.USER_ID, "u")


def _event_preferences(spark: SparkSession, d: str) -> DataFrame:
    return preference_scores(
        B.event_score_log(spark, d, ("purchase",)),
        [(B.event_log(spark, d, "click"), 0.3), (B.event_log(spark, d, "view"), 0.6)],
    )


@register("preference_scores", SQL.PREFERENCE + " SELECT * FROM pref")
def q_preference_scores(spark: SparkSession, d: str) -> DataFrame:
    return _event_preferences(spark, d)


@register("user_vectors")
def q_user_vectors(spark: SparkSession, d: str) -> DataFrame:
    scores = _event_preferences(spark, d)
    users = dense_index(scores, C.USER_ID, "u")
    items = dense_index(scores, C.PRODUCT_CODE, "i")
    indexed = scores.join(users, C.USER_ID).join(items, C.PRODUCT_CODE)
    return user_vectors(indexed, n_items=items.count())


# ----------------------------------------------------------------- segments


def _segments_given(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return run_given_segments(purchase_ratings(spark, d), B.segment_dim(spark, d), SEGMENT)


@register("segment_item_scores", SQL.with_(SQL.PURCHASE_RATINGS, SQL.SEGMENTS) + " SELECT * FROM seg_scores")
def q_segment_item_scores(spark: SparkSession, d: str) -> DataFrame:
    return segment_item_scores(purchase_ratings(spark, d), B.segment_dim(spark, d))


@register("segment_topn", SQL.with_(SQL.PURCHASE_RATINGS, SQL.SEGMENTS) + " SELECT * FROM seg_top")
def q_segment_topn(spark: SparkSession, d: str) -> DataFrame:
    return _segments_given(spark, d)["Cluster-recommendations"]


@register("segment_recommendations", SQL.with_(SQL.PURCHASE_RATINGS, SQL.SEGMENTS) + " SELECT * FROM seg_recs")
def q_segment_recommendations(spark: SparkSession, d: str) -> DataFrame:
    return _segments_given(spark, d)["User-recommendations"]


@register("run_metrics", SQL.SEGMENT_METRICS)
def q_run_metrics(spark: SparkSession, d: str) -> DataFrame:
    return _segments_given(spark, d)["Recommendation-metrics"]


@register("cluster_users")
def q_cluster_users(spark: SparkSession, d: str) -> DataFrame:
    return run_clusters(_event_preferences(spark, d), SEGMENT)["User-clusters"]


@register("cluster_recommendations")
def q_cluster_recommendations(spark: SparkSession, d: str) -> DataFrame:
    return run_clusters(_event_preferences(spark, d), SEGMENT)["User-recommendations"]


@register("cluster_run_single_source")
def q_cluster_run_single_source(spark: SparkSession, d: str) -> DataFrame:
    """k-means segments on averaged explicit ratings (one score log) instead of the multi-source preference."""
    return run_clusters(_event_ratings(spark, d), SEGMENT)["Recommendation-metrics"]


@register("cluster_run")
def q_cluster_run(spark: SparkSession, d: str) -> DataFrame:
    return run_clusters(_event_preferences(spark, d), SEGMENT)["Recommendation-metrics"]


def _assigned_to_given(spark: SparkSession, d: str) -> DataFrame:
    """Event users at the nearest of five given centres: the mean preferences of users of one remainder of the id."""
    scores = cut_lineage(_event_preferences(spark, d))
    groups = scores.select(C.USER_ID).distinct().withColumn(C.PREDICTION, F.pmod(C.USER_ID, F.lit(5)).cast("int"))
    return assign_to_centres(scores, cut_lineage(mean_centres(scores, groups)), k=5)


@register("centre_assignments", SQL.GIVEN_CENTRES + " SELECT USER_ID, prediction, distance FROM nearest")
def q_centre_assignments(spark: SparkSession, d: str) -> DataFrame:
    return _assigned_to_given(spark, d)


@register(
    "centre_wssse",
    SQL.GIVEN_CENTRES + " SELECT prediction, COUNT(*) AS n_members, ROUND(SUM(distance), 6) AS within FROM nearest GROUP BY 1",
)
def q_centre_wssse(spark: SparkSession, d: str) -> DataFrame:
    """Members and summed squared distances of every given centre."""
    return within_cluster_sums(_assigned_to_given(spark, d))


# ---------------------------------------------------------------------- ALS


def _event_ratings(spark: SparkSession, d: str) -> DataFrame:
    return avg_ratings(B.event_score_log(spark, d, ("purchase", "view")))


@register("als_factors")
def q_als_factors(spark: SparkSession, d: str) -> DataFrame:
    return run_als(_event_ratings(spark, d), ALS_PARAMS)["User-factors"]


@register("als_predictions")
def q_als_predictions(spark: SparkSession, d: str) -> DataFrame:
    """The run's Rating-predictions: every unrated (user, item) above the least score, not a user's best alone."""
    return run_als(_event_ratings(spark, d), ALS_PARAMS)["Rating-predictions"]


@register("als_recommendations")
def q_als_recommendations(spark: SparkSession, d: str) -> DataFrame:
    return run_als(_event_ratings(spark, d), ALS_PARAMS)["User-recommendations"]


@register("als_candidates")
def q_als_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Exact top-N candidate retrieval (unrated items only), by id."""
    users, items, indexed = index_ratings(_event_ratings(spark, d))
    model = als_fit(indexed, rank=ALS_PARAMS.rank, reg=ALS_PARAMS.reg, max_iter=ALS_PARAMS.max_iter,
                    blocks=ALS_PARAMS.blocks, seed=ALS_PARAMS.seed)
    cand = als_candidates(model, indexed, top_n=ALS_PARAMS.top_n)
    return cand.join(users, "u").join(items, "i").select(C.USER_ID, C.PRODUCT_CODE, C.PREDICTION)


@register("als_all_predictions")
def q_als_all_predictions(spark: SparkSession, d: str) -> DataFrame:
    """Every unrated (user, item) that the ALS run predicts above the least score."""
    return run_als(_event_ratings(spark, d), ALS_PARAMS, all_predictions=True)["Rating-predictions"]


def _profile_factors(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Given factors on the purchase ratings: a customer's mean rating of the parts of each size class (0: none) and a part's mean rating, whole for its class and a quarter for the others."""
    ratings = cut_lineage(purchase_ratings(spark, d))
    classes = spark.read.parquet(f"{d}/part.parquet").select(F.col("p_partkey").alias(C.PRODUCT_CODE), (F.col("p_size") % 5 + 1).cast("int").alias("m"))
    rated = ratings.join(classes, C.PRODUCT_CODE)
    mean = lambda k: F.coalesce(F.round(F.avg(F.when(F.col("m") == k, F.col(C.SCORE))), 6), F.lit(0.0))
    users = rated.groupBy(F.col(C.USER_ID).alias("u")).agg(F.array(*[mean(k) for k in range(1, 6)]).alias("features"))
    means = rated.groupBy(F.col(C.PRODUCT_CODE).alias("i"), "m").agg(F.round(F.avg(C.SCORE) / 5, 6).alias("r"))
    items = means.select("i", F.array(*[F.when(F.col("m") == k, F.col("r")).otherwise(F.round(F.col("r") / 4, 6)) for k in range(1, 6)]).alias("features"))
    return users, items, ratings.select(F.col(C.USER_ID).alias("u"), F.col(C.PRODUCT_CODE).alias("i"))


@register("factor_pairs_above", SQL.PROFILE_FACTORS + " SELECT u, i, prediction FROM scored WHERE prediction > 5.5")
def q_factor_pairs_above(spark: SparkSession, d: str) -> DataFrame:
    """All unrated (customer, part) pairs whose factors' product is above 5.5."""
    return pairs_above(*_profile_factors(spark, d), 5.5)


@register(
    "factor_top_n",
    SQL.PROFILE_FACTORS + " SELECT u, i, prediction, CAST(rn AS INTEGER) AS RANK FROM (SELECT *, row_number() OVER (PARTITION BY u ORDER BY prediction DESC, i) AS rn FROM scored) WHERE rn <= 10",
)
def q_factor_top_n(spark: SparkSession, d: str) -> DataFrame:
    """Every customer's ten unrated parts of greatest product of factors."""
    return top_pairs(*_profile_factors(spark, d), 10)


@register("fold_rating_errors", SQL.FOLD_ERRORS)
def q_fold_rating_errors(spark: SparkSession, d: str) -> DataFrame:
    """Sizes and errors of five folds of the purchase ratings, predicted by the given factors.

    To six decimals: the engines round ties of the factors' sixth decimal apart.
    """
    users, items, _ = _profile_factors(spark, d)
    ratings = purchase_ratings(spark, d).withColumnsRenamed({C.USER_ID: "u", C.PRODUCT_CODE: "i"})
    known = ratings.join(users.withColumnRenamed("features", "fu"), "u").join(items.withColumnRenamed("features", "fi"), "i")
    product = F.aggregate(F.zip_with("fu", "fi", lambda x, y: x * y), F.lit(0.0), lambda a, x: a + x)
    scored = known.select((F.pmod(F.col("u") * 31 + F.col("i"), F.lit(5))).cast("int").alias("fold"), C.SCORE, fixed(product, 9).alias(C.PREDICTION))
    errors = fold_errors([cut_lineage(scored)] * 5)
    return errors.withColumns({c: fixed(c, 6) for c in ("train_rmse", "test_rmse")})


@register("als_run")
def q_als_run(spark: SparkSession, d: str) -> DataFrame:
    return run_als(_event_ratings(spark, d), ALS_PARAMS)["Recommendation-metrics"]


@register("als_cross_validation")
def q_als_cross_validation(spark: SparkSession, d: str) -> DataFrame:
    _, _, indexed = index_ratings(_event_ratings(spark, d))
    return als_cross_validation(indexed, folds=5, rank=5, reg=1.0, max_iter=5, blocks=4, seed=42)


@register(
    "rating_rmse",
    SQL.COSINE
    + """ SELECT ROUND(SQRT(AVG((p.prediction - x.SCORE) * (p.prediction - x.SCORE))), 9) + 0.0 AS RMSE
    FROM cs_pred_rated p JOIN purchase_ratings x USING (USER_ID, PRODUCT_CODE)""",
)
def q_rating_rmse(spark: SparkSession, d: str) -> DataFrame:
    ratings, top = _cosine_top(spark, d)
    rated = predict_ratings(ratings, top, min_rating=COSINE.min_rating, unrated=False)
    rmse = rating_rmse(rated.join(ratings, [C.USER_ID, C.PRODUCT_CODE]))
    return rmse.select(fixed("RMSE", 9).alias("RMSE"))


# --------------------------------------------------------------- comparison


@register("find_user", SQL.with_(SQL.PEOPLE) + " SELECT USER_ID, ACCOUNT, NAME FROM found")
def q_find_user(spark: SparkSession, d: str) -> DataFrame:
    return find_user(B.user_dim(spark, d), B.account_dim(spark, d), SQL.LOOKUP_USER).select(C.USER_ID, C.ACCOUNT, C.NAME)


@register(
    "user_history_named",
    SQL.with_(SQL.PEOPLE)
    + """ SELECT o.o_custkey AS USER_ID, 1 + FLOOR((l.l_quantity - 1) / 10) AS SCORE,
                 f.ACCOUNT, f.NAME, p.PRODUCT_NAME
    FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
    JOIN found f ON f.USER_ID = o.o_custkey
    JOIN products p ON p.PRODUCT_CODE = l.l_partkey""",
)
def q_user_history_named(spark: SparkSession, d: str) -> DataFrame:
    people = find_user(B.user_dim(spark, d), B.account_dim(spark, d), SQL.LOOKUP_USER)
    history = model_history("CosSim", scores=B.purchase_log(spark, d))
    return attach_names(history, people, B.product_dim(spark, d)).select(C.USER_ID, C.SCORE, C.ACCOUNT, C.NAME, C.PRODUCT_NAME)


_NAMED_RECS_SQL = (
    SQL.COSINE
    + ","
    + SQL.PEOPLE
    + """ SELECT r.USER_ID, f.ACCOUNT, f.NAME, p.PRODUCT_NAME
    FROM cs_recs r JOIN found f ON f.USER_ID = r.USER_ID JOIN products p ON p.PRODUCT_CODE = r.PRODUCT_CODE"""
)


@register("user_recommendations_named", _NAMED_RECS_SQL)
def q_user_recommendations_named(spark: SparkSession, d: str) -> DataFrame:
    people = find_user(B.user_dim(spark, d), B.account_dim(spark, d), SQL.LOOKUP_USER)
    recs = run_cosine(purchase_ratings(spark, d), COSINE)["User-recommendations"].select(C.USER_ID, C.PRODUCT_CODE)
    return attach_names(recs, people, B.product_dim(spark, d)).select(C.USER_ID, C.ACCOUNT, C.NAME, C.PRODUCT_NAME)


@register("compare_run", _NAMED_RECS_SQL)
def q_compare_run(spark: SparkSession, d: str) -> DataFrame:
    folder = _written_cosine_recs(spark, d)
    out = run_compare(
        folder, model="CosSim", user=SQL.LOOKUP_USER, users=B.user_dim(spark, d), accounts=B.account_dim(spark, d),
        items=B.product_dim(spark, d), scores=B.purchase_log(spark, d),
        save_to=shared_path(spark, "tastebud-results", uuid.uuid4().hex, "Comparison", SQL.LOOKUP_USER, "CosSim"),
    )
    return out["User-recommendations"].select(C.USER_ID, C.ACCOUNT, C.NAME, C.PRODUCT_NAME)


# ------------------------------------------------------ reference options


@register(
    "fill_item_dedupe_map",
    SQL.with_(SQL.PURCHASE_RES)
    + """, rmap_one AS (SELECT RES_ID, MIN(PRODUCT_CODE) AS PRODUCT_CODE FROM rmap GROUP BY RES_ID)
    SELECT l.USER_ID, COALESCE(l.PRODUCT_CODE, m.PRODUCT_CODE) AS PRODUCT_CODE, l.SCORE
    FROM plog l LEFT JOIN rmap_one m ON l.RES_ID = m.RES_ID
    WHERE COALESCE(l.PRODUCT_CODE, m.PRODUCT_CODE) IS NOT NULL""",
)
def q_fill_item_dedupe_map(spark: SparkSession, d: str) -> DataFrame:
    log = _res_log(spark, d).select(C.USER_ID, C.RES_ID, C.PRODUCT_CODE, C.SCORE)
    return fill_item_from_resource(log, B.resource_map(spark, d), dedupe_map=True)


@register(
    "segment_recommendations_unseen",
    SQL.with_(SQL.PURCHASE_RATINGS, SQL.SEGMENTS)
    + """ SELECT s.USER_ID, s.PRODUCT_CODE, s.RANK FROM seg_recs s
    WHERE NOT EXISTS (SELECT 1 FROM purchase_ratings r WHERE r.USER_ID = s.USER_ID AND r.PRODUCT_CODE = s.PRODUCT_CODE)""",
)
def q_segment_recommendations_unseen(spark: SparkSession, d: str) -> DataFrame:
    params = SegmentParams(k=SEGMENT.k, max_iter=SEGMENT.max_iter, top_n=SEGMENT.top_n, seed=SEGMENT.seed, exclude_seen=True)
    return run_given_segments(purchase_ratings(spark, d), B.segment_dim(spark, d), params)["User-recommendations"]


@register("rules_time_window_holdout", SQL.HOLDOUT_METRICS)
def q_rules_time_window_holdout(spark: SparkSession, d: str) -> DataFrame:
    """Time-window run with a strict hold-out: rules learn only from rows before end_time."""
    return run_rules([B.shopping_log(spark, d)], RulesParams(**vars(SQL.HOLDOUT_PARAMS)), time_window=True)["Recommendation-metrics"]


@register("rules_time_window_raw", SQL.SEASON_METRICS)
def q_rules_time_window_raw(spark: SparkSession, d: str) -> DataFrame:
    """The time-window run on a log that holds epoch milliseconds only, as the log contract says."""
    log = B.shopping_log(spark, d).withColumn(C.CREATE_TIME, time_to_epoch_ms(C.EVENT_TIME)).drop(C.EVENT_TIME)
    return run_rules([log], SEASON, time_window=True)["Recommendation-metrics"]


@register("cosine_run_resource", SQL.COSINE_RESOURCE_METRICS)
def q_cosine_run_resource(spark: SparkSession, d: str) -> DataFrame:
    """The cosine run on a score log whose missing items come from the resource map."""
    ratings = avg_ratings(_res_log(spark, d), B.resource_map(spark, d))
    return run_cosine(ratings, COSINE)["Recommendation-metrics"]


@register("rules_full_history_resource", SQL.FULL_RESOURCE_METRICS)
def q_rules_full_history_resource(spark: SparkSession, d: str) -> DataFrame:
    """The full-history run on the purchase log, items filled from the resource map inside the run."""
    run = run_rules([_res_log(spark, d)], RulesParams(**vars(SQL.RESOURCE_RULES)), time_window=False, resource_map=B.resource_map(spark, d))
    return run["Recommendation-metrics"]


@register("cosine_run_events", SQL.COSINE_EVENTS_METRICS)
def q_cosine_run_events(spark: SparkSession, d: str) -> DataFrame:
    """The cosine run on the event ratings: text item ids, a small dense catalogue."""
    return run_cosine(avg_ratings(B.event_score_log(spark, d)), CosineParams(**vars(SQL.EVENT_COSINE)))["Recommendation-metrics"]


@register(
    "als_recommendation_checks",
    "SELECT * FROM (VALUES ('rated', 0), ('beyond_n', 0), ('rank_gaps', 0), ('off_product', 0)) t(rule, broken)",
)
def q_als_recommendation_checks(spark: SparkSession, d: str) -> DataFrame:
    """What every ALS top-N must be: unrated items, at most N a user, ranks 1..n, scores equal to the factors' product."""
    _, _, indexed = index_ratings(_event_ratings(spark, d))
    model = als_fit(indexed, rank=ALS_PARAMS.rank, reg=ALS_PARAMS.reg, max_iter=ALS_PARAMS.max_iter, blocks=ALS_PARAMS.blocks, seed=ALS_PARAMS.seed)
    recs = cut_lineage(als_candidates(model, indexed, top_n=ALS_PARAMS.top_n))
    per_user = recs.groupBy("u").agg(F.count(F.lit(1)).alias("n"), F.max(C.RANK).alias("top"), F.count_distinct(C.RANK).alias("ranks"))
    dot = F.aggregate(F.zip_with("uf", "vf", lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0).cast("double"), lambda acc, x: acc + x)
    scored = recs.join(model.userFactors.select(F.col("id").alias("u"), F.col("features").alias("uf")), "u").join(
        model.itemFactors.select(F.col("id").alias("i"), F.col("features").alias("vf")), "i"
    )
    broken = {
        "rated": recs.join(indexed, ["u", "i"], "left_semi"),
        "beyond_n": per_user.filter(F.col("n") > ALS_PARAMS.top_n),
        "rank_gaps": per_user.filter((F.col("top") != F.col("n")) | (F.col("ranks") != F.col("n"))),
        "off_product": scored.filter(F.abs(dot - F.col(C.PREDICTION)) > 1e-4),
    }
    out = None
    for rule, rows in broken.items():
        one = rows.agg(F.count(F.lit(1)).cast("int").alias("broken")).select(F.lit(rule).alias("rule"), "broken")
        out = one if out is None else out.unionByName(one)
    return out


@register(
    "user_vector_entries",
    SQL.PREFERENCE
    + """, iu AS (SELECT USER_ID, ROW_NUMBER() OVER (ORDER BY USER_ID) - 1 AS u FROM (SELECT DISTINCT USER_ID FROM pref)),
    ii AS (SELECT PRODUCT_CODE, ROW_NUMBER() OVER (ORDER BY PRODUCT_CODE) - 1 AS i FROM (SELECT DISTINCT PRODUCT_CODE FROM pref))
    SELECT u, i, SCORE AS x FROM pref JOIN iu USING (USER_ID) JOIN ii USING (PRODUCT_CODE) WHERE SCORE <> 0""",
)
def q_user_vector_entries(spark: SparkSession, d: str) -> DataFrame:
    """The non-zero entries of the user vectors, read back from the vectors."""
    entries = F.udf(lambda v: list(zip(v.indices.tolist(), v.values.tolist())), "array<struct<i:bigint,x:double>>")
    return q_user_vectors(spark, d).select(F.col("label").alias("u"), F.explode(entries("features")).alias("e")).select("u", "e.i", "e.x").filter("x <> 0")


_KNOWN_METRICS = ["OP_TIME", "ARGUMENTS", "NUM_PROCESSED_LOG", "NUM_ALL_USERS"]


def _known_metrics_sql(base: str, rows: str, arguments: str) -> str:
    return base + f""" SELECT * FROM (
      SELECT 'OP_TIME' AS metric, '2000061500' AS value UNION ALL SELECT 'ARGUMENTS', '{arguments}'
      UNION ALL SELECT 'NUM_PROCESSED_LOG', (SELECT CAST(COUNT(*) AS VARCHAR) FROM {rows})
      UNION ALL SELECT 'NUM_ALL_USERS', (SELECT CAST(COUNT(DISTINCT USER_ID) AS VARCHAR) FROM {rows}))"""


@register("cluster_run_counts", _known_metrics_sql(SQL.PREFERENCE, "pref", "5_10_10"))
def q_cluster_run_counts(spark: SparkSession, d: str) -> DataFrame:
    """The metrics of the k-means run that do not hang on the clusters found."""
    return q_cluster_run(spark, d).filter(F.col("metric").isin(_KNOWN_METRICS))


@register("als_run_counts", _known_metrics_sql(SQL.with_(SQL.EVENT_SCORES, SQL.EVENT_RATINGS), "event_ratings", "10_0.1_10_10_10"))
def q_als_run_counts(spark: SparkSession, d: str) -> DataFrame:
    """The metrics of the ALS run that do not hang on the factors found."""
    return q_als_run(spark, d).filter(F.col("metric").isin(_KNOWN_METRICS))


@register(
    "als_factor_counts",
    SQL.with_(SQL.EVENT_SCORES, SQL.EVENT_RATINGS)
    + """ SELECT 'User-factors' AS product, COUNT(DISTINCT USER_ID) AS n, 10 AS width FROM event_ratings
    UNION ALL SELECT 'Product-factors', COUNT(DISTINCT PRODUCT_CODE), 10 FROM event_ratings""",
)
def q_als_factor_counts(spark: SparkSession, d: str) -> DataFrame:
    """Rows and width of both factor products."""
    run = run_als(_event_ratings(spark, d), ALS_PARAMS)
    out = [
        run[name].agg(F.count(F.lit(1)).alias("n"), F.max(F.size(F.split("factors", ","))).alias("width")).select(F.lit(name).alias("product"), "n", "width")
        for name in ("User-factors", "Product-factors")
    ]
    return out[0].unionByName(out[1])


@register(
    "segment_sums_of_clusters",
    "SELECT 0 AS unlike",
)
def q_segment_sums_of_clusters(spark: SparkSession, d: str) -> DataFrame:
    """Rows on which the k-means run's segment sums and the sums over its own assignment differ."""
    scores = cut_lineage(_event_preferences(spark, d))
    run = run_clusters(scores, SEGMENT)
    again = scores.join(run["User-clusters"], C.USER_ID).groupBy(C.PREDICTION, C.PRODUCT_CODE).agg(F.sum(C.SCORE).alias("again"))
    both = run["Cluster-ratings"].join(again, [C.PREDICTION, C.PRODUCT_CODE], "full_outer")
    unlike = F.coalesce(F.abs(F.col("again") - F.col(C.SCORE_SUM)) > 1e-9, F.lit(True))
    return both.agg(F.coalesce(F.sum(unlike.cast("int")), F.lit(0)).cast("int").alias("unlike"))


@register(
    "cluster_history_named",
    SQL.with_(SQL.PEOPLE)
    + """ SELECT o.o_custkey AS USER_ID, f.ACCOUNT, f.NAME, p.PRODUCT_NAME
    FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
    JOIN found f ON f.USER_ID = o.o_custkey JOIN products p ON p.PRODUCT_CODE = l.l_partkey, (VALUES (1), (2)) twice(k)""",
)
def q_cluster_history_named(spark: SparkSession, d: str) -> DataFrame:
    """The segment model's history: the rows of all logs, repeats kept (here the purchase log as two logs)."""
    people = find_user(B.user_dim(spark, d), B.account_dim(spark, d), SQL.LOOKUP_USER)
    log = B.purchase_log(spark, d)
    history = model_history("Cluster", scores=log, other_logs=[log])
    return attach_names(history, people, B.product_dim(spark, d)).select(C.USER_ID, C.ACCOUNT, C.NAME, C.PRODUCT_NAME)


@register(
    "association_history_read_back",
    SQL.SEASON_BASE + " SELECT USER_ID, PRODUCT_CODE, strftime(event_time, '%Y-%m-%d %H:%M:%S') AS DATE FROM hist",
)
def q_association_history_read_back(spark: SparkSession, d: str) -> DataFrame:
    """The rules run's saved history product (user, item, date text, no run stamp), read back from its files."""
    run = run_rules([B.shopping_log(spark, d)], SEASON, time_window=True)
    root = shared_path(spark, "tastebud-results", uuid.uuid4().hex)
    path = write_product(run["User-history-logs"], root, model="AR", sub_type="TimeWindow", product="User-history-logs", op_time=SEASON.op_time)
    saved = read_results(spark, path, [C.USER_ID, C.PRODUCT_CODE, C.DATE], types={C.USER_ID: "bigint"})
    model_history("Association", saved_history=saved)  # what the comparison takes of it
    return saved


@register(
    "compare_run_history",
    SQL.with_(SQL.PEOPLE)
    + """ SELECT o.o_custkey AS USER_ID, 1 + FLOOR((l.l_quantity - 1) / 10) AS SCORE, f.ACCOUNT, f.NAME, p.PRODUCT_NAME
    FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
    JOIN found f ON f.USER_ID = o.o_custkey JOIN products p ON p.PRODUCT_CODE = l.l_partkey""",
)
def q_compare_run_history(spark: SparkSession, d: str) -> DataFrame:
    """The history side of the comparison run."""
    out = run_compare(
        _written_cosine_recs(spark, d), model="CosSim", user=SQL.LOOKUP_USER, users=B.user_dim(spark, d), accounts=B.account_dim(spark, d),
        items=B.product_dim(spark, d), scores=B.purchase_log(spark, d),
    )
    return out["User-historys"].select(C.USER_ID, C.SCORE, C.ACCOUNT, C.NAME, C.PRODUCT_NAME)
