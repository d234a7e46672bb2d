"""Adjusted-cosine recommender run: ratings -> products + metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import columns as C
from ..operators.cosine import adjusted_cosine, cosine_recommendations, top_similar_items, weighted_predictions
from ..session import cut_lineage
from ..operators.evaluate import metrics_table, number_text, one_row, ratio_text, squared_error
from .params import CosineParams


def similar_items(ratings: DataFrame, params: CosineParams, *, materialize: bool = True) -> tuple[DataFrame, DataFrame]:
    """(ratings, top similar items), both checkpointed when ``materialize``.

    Both feed several consumers (pairs, two predictions, metrics); a reliable
    checkpoint in the shared checkpoint folder computes each once and cuts
    the lineage before the long pair stage, so a lost executor costs a
    partition of the checkpoint, not the whole chain.
    """
    if materialize:
        ratings = cut_lineage(ratings)
    sims = top_similar_items(
        adjusted_cosine(ratings, min_commons=params.min_commons, min_sim=params.min_sim), min_sim=params.min_sim, top_sim=params.top_sim
    )
    if materialize:
        sims = cut_lineage(sims)
    return ratings, sims


def run_cosine(ratings: DataFrame, params: CosineParams = CosineParams(), *, materialize: bool = True) -> dict[str, DataFrame]:
    """All products of one run.

    ``ratings`` is (USER_ID, PRODUCT_CODE, SCORE), one row per pair (see
    ``avg_ratings``).  Products: Item-cossimularities, Rating-predictions,
    User-recommendations, Recommendation-metrics.
    """
    ratings, sims = similar_items(ratings, params, materialize=materialize)
    predictions = weighted_predictions(ratings, sims, min_rating=params.min_rating)
    if materialize:  # read by the products and the metrics: one pass over the sums
        predictions = cut_lineage(predictions)
    unrated = predictions.filter(F.col(C.SCORE).isNull()).drop(C.SCORE)
    checked = predictions.filter(F.col(C.SCORE).isNotNull())
    recs = cosine_recommendations(unrated, min_rating=params.min_rating, top_n=params.top_n)
    stats = one_row(
        counts={
            "n_ratings": ratings,
            "n_users": ratings.select(C.USER_ID).distinct(),
            "n_items": ratings.select(C.PRODUCT_CODE).distinct(),
            "n_reco_users": recs.select(C.USER_ID).distinct(),
            "n_reco_items": recs.select(C.PRODUCT_CODE).distinct(),
        },
        means={"mse": (checked, squared_error())},
    )
    metrics = metrics_table(
        stats,
        [
            ("OP_TIME", params.op_time),
            ("ARGUMENTS", params.arguments()),
            ("NUM_PROCESSED_LOG", F.col("n_ratings")),
            ("NUM_ALL_USERS", F.col("n_users")),
            ("NUM_POSSIBLE_USERS", F.col("n_reco_users")),
            ("NUM_RECOMMEND_ITEMS", F.col("n_reco_items")),
            ("COVERAGE", ratio_text("n_reco_items", "n_items")),
            ("RMSE", number_text(F.sqrt("mse"))),
        ],
    )
    return {
        "Item-cossimularities": sims,
        "Rating-predictions": unrated,
        "User-recommendations": recs.select(C.USER_ID, C.PRODUCT_CODE, C.RANK),
        "Recommendation-metrics": metrics,
    }
