"""ALS recommender run: ratings -> factors, predictions, top-N, metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import columns as C
from ..operators.evaluate import metrics_table, number_text, one_row, ratio_text
from ..operators.factors import ITEM_IDX, USER_IDX, als_cross_validation, als_factors, als_fit, als_predictions, als_predictions_above, als_recommendations
from ..operators.ratings import id_index
from ..session import cut_lineage
from .params import AlsParams


def index_ratings(ratings: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Int user / item indexes and the integer-keyed ratings (checkpointed: ALS iterates on them)."""
    users = id_index(ratings, C.USER_ID, USER_IDX)
    items = id_index(ratings, C.PRODUCT_CODE, ITEM_IDX)
    indexed = ratings.join(users, C.USER_ID).join(items, C.PRODUCT_CODE).select(USER_IDX, ITEM_IDX, C.SCORE)
    return users, items, cut_lineage(indexed)


def run_als(ratings: DataFrame, params: AlsParams = AlsParams(), *, folds: int | None = None, all_predictions: bool = True) -> dict[str, DataFrame]:
    """Products: User-factors, Product-factors, Rating-predictions, User-recommendations, metrics.

    With ``folds`` also cvResult (fold, train_rmse, test_rmse) of that many fits.

    Rating-predictions holds every unrated pair that scores above ``min_score``,
    or without ``all_predictions`` the ``top_n`` best of them of each user.
    """
    users, items, indexed = index_ratings(ratings)
    model = als_fit(
        indexed, rank=params.rank, reg=params.reg, max_iter=params.max_iter, blocks=params.blocks, seed=params.seed
    )
    user_factors, item_factors = als_factors(model, users, items)
    predictions, top = als_recommendations(model, indexed, users, items, top_n=params.top_n, min_score=params.min_score)
    if all_predictions:
        every = als_predictions_above(model, indexed, min_score=params.min_score)
        predictions = every.join(users, USER_IDX).join(items, ITEM_IDX).select(C.USER_ID, C.PRODUCT_CODE, C.PREDICTION)
    fitted = als_predictions(model, indexed)
    stats = one_row(
        counts={
            "n_ratings": indexed,
            "n_users": users,
            "n_items": items,
            "n_reco_users": top.select(C.USER_ID).distinct(),
            "n_reco_items": top.select(C.PRODUCT_CODE).distinct(),
        },
        means={"mse": (fitted, (F.col(C.PREDICTION) - F.col(C.SCORE)) ** 2)},
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
    products = {
        "User-factors": user_factors,
        "Product-factors": item_factors,
        "Rating-predictions": predictions,
        "User-recommendations": top.select(C.USER_ID, C.PRODUCT_CODE, C.RANK),
        "Recommendation-metrics": metrics,
    }
    if folds:
        products["cvResult"] = als_cross_validation(
            indexed, folds=folds, rank=params.rank, reg=params.reg, max_iter=params.max_iter, blocks=params.blocks, seed=params.seed
        )
    return products
