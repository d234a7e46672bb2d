"""Segment recommender runs: given segments, or k-means clusters of preference vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import columns as C
from ..operators.evaluate import metrics_table, one_row, ratio_text
from ..operators.ratings import dense_index, id_index, user_vectors
from ..operators.segments import cluster_users, segment_item_scores, segment_recommendations, segment_topn
from ..session import cut_lineage
from .params import SegmentParams


def _segment_products(
    scores: DataFrame,
    assignments: DataFrame,
    params: SegmentParams,
    *,
    bounded: bool,
) -> dict[str, DataFrame]:
    seg_scores = segment_item_scores(scores, assignments)
    top = segment_topn(seg_scores, top_n=params.top_n)
    seen = scores.select(C.USER_ID, C.PRODUCT_CODE) if params.exclude_seen else None
    recs = segment_recommendations(assignments, top, exclude_seen=seen, bounded_topn=bounded)
    return {"Cluster-ratings": seg_scores, "Cluster-recommendations": top, "User-recommendations": recs}


def _stats(scores: DataFrame, assignments: DataFrame, recs: DataFrame) -> DataFrame:
    return one_row(
        counts={
            "n_scores": scores,
            "n_users": assignments.select(C.USER_ID).distinct(),
            "n_items": scores.select(C.PRODUCT_CODE).distinct(),
            "n_reco_users": recs.select(C.USER_ID).distinct(),
            "n_reco_items": recs.select(C.PRODUCT_CODE).distinct(),
        }
    )


def run_given_segments(scores: DataFrame, segments: DataFrame, params: SegmentParams = SegmentParams()) -> dict[str, DataFrame]:
    """Segment products for a given USER_ID -> prediction assignment (no clustering).

    ``scores`` is (USER_ID, PRODUCT_CODE, SCORE); only users that have scores
    are assigned.
    """
    scores = cut_lineage(scores)  # read by the assignment, the sums and the metrics
    assignments = segments.join(scores.select(C.USER_ID).distinct(), C.USER_ID, "left_semi")
    out = _segment_products(scores, assignments, params, bounded=False)
    stats = _stats(scores, assignments, out["User-recommendations"])
    out["Recommendation-metrics"] = metrics_table(
        stats,
        [
            ("OP_TIME", params.op_time),
            ("ARGUMENTS", params.arguments()),
            ("NUM_PROCESSED_LOG", F.col("n_scores")),
            ("NUM_ALL_USERS", F.col("n_users")),
            ("NUM_POSSIBLE_USERS", F.col("n_reco_users")),
            ("NUM_RECOMMEND_ITEMS", F.col("n_reco_items")),
            ("COVERAGE", ratio_text("n_reco_items", "n_items")),
        ],
    )
    return out


def run_clusters(scores: DataFrame, params: SegmentParams = SegmentParams()) -> dict[str, DataFrame]:
    """K-means over sparse user preference vectors, then the segment products.

    Users and items get dense indexes (sorted ids), vectors are built per
    user, k-means assigns clusters; the k x N top-N table is broadcast
    (bounded by k and N).  Metrics add the WSSSE.
    """
    scores = cut_lineage(scores)
    users = id_index(scores, C.USER_ID, "u")  # labels only: any int id will do
    items = dense_index(scores, C.PRODUCT_CODE, "i")  # vector positions: must be 0..n-1
    n_items = items.count()
    indexed = scores.join(users, C.USER_ID).join(items, C.PRODUCT_CODE)
    # One row per user, read by the fit and by the assignment: built once.
    vectors = cut_lineage(user_vectors(indexed, n_items=int(n_items)))
    model, labelled = cluster_users(vectors, k=params.k, max_iter=params.max_iter, seed=params.seed)
    # One row per user, read by every product: computed once.
    assignments = cut_lineage(labelled.join(users, F.col("label") == F.col("u")).select(C.USER_ID, C.PREDICTION))
    out = _segment_products(scores, assignments, params, bounded=True)
    out["User-clusters"] = assignments
    wssse = float(model.summary.trainingCost)
    stats = _stats(scores, assignments, out["User-recommendations"])
    out["Recommendation-metrics"] = metrics_table(
        stats,
        [
            ("OP_TIME", params.op_time),
            ("ARGUMENTS", params.arguments()),
            ("NUM_PROCESSED_LOG", F.col("n_scores")),
            ("NUM_ALL_USERS", F.col("n_users")),
            ("NUM_POSSIBLE_USERS", F.col("n_reco_users")),
            ("NUM_RECOMMEND_ITEMS", F.col("n_reco_items")),
            ("COVERAGE", ratio_text("n_reco_items", "n_items")),
            ("WSSSE", F.format_string("%10.8f", F.lit(wssse))),
        ],
    )
    return out
