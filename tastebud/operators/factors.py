"""Matrix factorisation (ALS): fit, factors, exact top-N retrieval, k-fold validation."""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import columns as C
from ..functions import fixed
from ..session import cut_lineage
from .evaluate import squared_error
from .retrieval import pairs_above, top_pairs
from .topn import ranked_top_n

USER_IDX = "u"
ITEM_IDX = "i"


def als_fit(
    ratings: DataFrame,
    *,
    rank: int = 10,
    reg: float = 1.0,
    max_iter: int = 10,
    blocks: int = 10,
    seed: int = 42,
    user_col: str = USER_IDX,
    item_col: str = ITEM_IDX,
    rating_col: str = C.SCORE,
) -> ALSModel:
    """Explicit-feedback ALS on integer-indexed ratings.

    ``blocks`` sets both user and item block counts (the parallelism of each
    half-step); lineage is cut every ``checkpointInterval`` iterations into
    the session's checkpoint folder.  Fitted once (the reference fits twice).
    """
    als = ALS(
        rank=rank,
        regParam=reg,
        maxIter=max_iter,
        numUserBlocks=blocks,
        numItemBlocks=blocks,
        userCol=user_col,
        itemCol=item_col,
        ratingCol=rating_col,
        seed=seed,
        coldStartStrategy="drop",
        checkpointInterval=5,
    )
    return als.fit(ratings.select(user_col, item_col, rating_col))


def _factor_text() -> Column:
    return F.array_join(F.transform("features", lambda x: x.cast("string")), ",")


def als_factors(model: ALSModel, user_index: DataFrame, item_index: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(USER_ID, factors text), (PRODUCT_CODE, factors text)."""
    users = model.userFactors.join(user_index, F.col("id") == F.col(USER_IDX)).select(C.USER_ID, _factor_text().alias("factors"))
    items = model.itemFactors.join(item_index, F.col("id") == F.col(ITEM_IDX)).select(C.PRODUCT_CODE, _factor_text().alias("factors"))
    return users, items


def als_predictions(model: ALSModel, pairs: DataFrame, *, min_score: float | None = None) -> DataFrame:
    """Predicted rating for given (u, i) pairs; NaN (unknown user / item) dropped."""
    scored = model.transform(pairs).filter(~F.isnan(C.PREDICTION))
    if min_score is not None:
        scored = scored.filter(F.col(C.PREDICTION) > min_score)
    return scored


def _as_float(x: Column) -> Column:
    """Predictions as the model gives them: single precision."""
    return x.cast("float").cast("double")


def _factor_tables(model: ALSModel) -> tuple[DataFrame, DataFrame]:
    return model.userFactors.withColumnRenamed("id", USER_IDX), model.itemFactors.withColumnRenamed("id", ITEM_IDX)


def als_candidates(model: ALSModel, ratings: DataFrame, *, top_n: int) -> DataFrame:
    """Exact top-N retrieval of unrated items, without a users x items product.

    ``retrieval.top_pairs`` on the model's factors: a user meets the blocks of
    items whose norm and box allow a score as high as the N-th best known.
    -> u, i, prediction, RANK (unrated only; prediction desc, item index asc).
    """
    users, items = _factor_tables(model)
    found = top_pairs(users, items, ratings.select(USER_IDX, ITEM_IDX), top_n, rounding=_as_float)
    return found.withColumns({USER_IDX: F.col(USER_IDX).cast("int"), ITEM_IDX: F.col(ITEM_IDX).cast("int")})


def als_predictions_above(model: ALSModel, ratings: DataFrame, *, min_score: float) -> DataFrame:
    """Every unrated (u, i) that the model predicts above ``min_score``: u, i, prediction.

    The rows are the answer; pairs below the score are passed over by block
    bounds where these allow it, and never become rows.
    """
    users, items = _factor_tables(model)
    found = pairs_above(users, items, ratings.select(USER_IDX, ITEM_IDX), min_score, rounding=_as_float)
    return found.withColumns({USER_IDX: F.col(USER_IDX).cast("int"), ITEM_IDX: F.col(ITEM_IDX).cast("int")})


def als_recommendations(
    model: ALSModel,
    ratings: DataFrame,
    user_index: DataFrame,
    item_index: DataFrame,
    *,
    top_n: int = 10,
    min_score: float = 3.0,
) -> tuple[DataFrame, DataFrame]:
    """-> (the N best unrated predictions above min_score of each user, the same ranked by id order on ties), by id."""
    cand = als_candidates(model, ratings, top_n=top_n).filter(~F.isnan(C.PREDICTION) & (F.col(C.PREDICTION) > min_score))
    named = cand.join(user_index, USER_IDX).join(item_index, ITEM_IDX).select(C.USER_ID, C.PRODUCT_CODE, C.PREDICTION)
    top = ranked_top_n(named, by=C.USER_ID, score=C.PREDICTION, tie=C.PRODUCT_CODE, n=top_n)
    return named, top


def fold_errors(scored: Sequence[DataFrame]) -> DataFrame:
    """Errors of k-fold validation: fold, n_train, n_test, train_rmse, test_rmse.

    ``scored[f]`` holds SCORE, the row's own ``fold`` and the prediction by the
    model that did not see fold f.  One aggregate over all of them; an RMSE of
    no rows is null.
    """
    rows = None
    for f, df in enumerate(scored):
        part = df.select(F.lit(f).alias("_f"), (F.col("fold") == f).alias("_test"), squared_error().alias("_e"))
        rows = part if rows is None else rows.unionByName(part)
    test = F.col("_test")
    return rows.groupBy(F.col("_f").alias("fold")).agg(
        F.count(F.when(~test, F.lit(1))).alias("n_train"),
        F.count(F.when(test, F.lit(1))).alias("n_test"),
        fixed(F.sqrt(F.avg(F.when(~test, F.col("_e")))), 9).alias("train_rmse"),
        fixed(F.sqrt(F.avg(F.when(test, F.col("_e")))), 9).alias("test_rmse"),
    )


def als_cross_validation(ratings: DataFrame, *, folds: int = 5, fold: Column | None = None, parallel: int = 3, **als_params) -> DataFrame:
    """k-fold validation: fit on the other folds, test on the fold.

    ``fold`` numbers the rows from 0 (default: hash of u and i, mod k).  The
    tagged ratings are written once, a folder per fold, so a fit reads the
    other folds' files alone.  ``parallel`` fits run side by side, which fills
    the tasks that the small half-steps of one fit leave idle; all errors are
    one aggregate.  -> fold, n_train, n_test, train_rmse, test_rmse, by fold
    (rows that a model cannot score, of users or items it has not seen, are
    left out of its counts).
    """
    spark: SparkSession = ratings.sparkSession
    number = F.pmod(F.xxhash64(USER_IDX, ITEM_IDX), F.lit(folds)) if fold is None else fold
    tagged = cut_lineage(ratings.select(USER_IDX, ITEM_IDX, C.SCORE, number.cast("int").alias("fold")), "folds", by=("fold",))

    def fit(f: int) -> ALSModel:
        return als_fit(tagged.filter(F.col("fold") != f), **als_params)

    tasks = [inheritable_thread_target(spark)(partial(fit, f)) for f in range(folds)]
    with ThreadPool(min(parallel, folds)) as pool:
        models = pool.map(lambda task: task(), tasks)
    return fold_errors([als_predictions(m, tagged) for m in models]).orderBy("fold")
