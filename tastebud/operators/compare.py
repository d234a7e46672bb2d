"""Comparison of one user's history with the recommendations of a run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import columns as C

MODELS = ("Association", "Cluster", "ALS", "CosSim")


def find_user(users: DataFrame, accounts: DataFrame, query: str) -> DataFrame:
    """Users whose id, name or account equals ``query`` -> USER_ID, ACCOUNT, NAME (distinct)."""
    joined = accounts.select(C.PERSON_ID, C.ACCOUNT).join(users.select(C.PERSON_ID, C.NAME), C.PERSON_ID)
    people = joined.withColumnRenamed(C.PERSON_ID, C.USER_ID).distinct()
    q = F.lit(query)
    return people.filter((F.col(C.USER_ID).cast("string") == q) | (F.col(C.NAME) == q) | (F.col(C.ACCOUNT) == q))


def attach_names(df: DataFrame, people: DataFrame, items: DataFrame) -> DataFrame:
    """Join user names/accounts and product names; the product code is dropped."""
    products = items.select(C.PRODUCT_CODE, C.PRODUCT_NAME).distinct()
    return df.join(people, C.USER_ID).join(products, C.PRODUCT_CODE).drop(C.PRODUCT_CODE)


def model_history(
    model: str,
    *,
    saved_history: DataFrame | None = None,
    scores: DataFrame | None = None,
    other_logs: Sequence[DataFrame] = (),
) -> DataFrame:
    """The history a model saw: Association -> its saved history product;
    Cluster -> score + other logs (user, item; no distinct); ALS / CosSim ->
    the score log with its score."""
    if model == "Association":
        if saved_history is None:
            raise ValueError("Association needs the saved User-history-logs product")
        return saved_history.select(C.USER_ID, C.PRODUCT_CODE)
    if model == "Cluster":
        frames = ([scores] if scores is not None else []) + list(other_logs)
        out = frames[0].select(C.USER_ID, C.PRODUCT_CODE)
        for f in frames[1:]:
            out = out.unionByName(f.select(C.USER_ID, C.PRODUCT_CODE))
        return out
    if model in ("ALS", "CosSim"):
        if scores is None:
            raise ValueError(f"{model} needs the score log")
        return scores.select(C.USER_ID, C.PRODUCT_CODE, C.SCORE)
    raise ValueError(f"Illegal value for model: {model!r}; expected one of {MODELS}")


def compare_user(
    history: DataFrame,
    recommendations: DataFrame,
    users: DataFrame,
    accounts: DataFrame,
    items: DataFrame,
    *,
    user: str,
) -> dict[str, DataFrame]:
    """Named history and named recommendations of the users matching ``user``."""
    people = find_user(users, accounts, user)
    return {
        "User-historys": attach_names(history, people, items),
        "User-recommendations": attach_names(recommendations.select(C.USER_ID, C.PRODUCT_CODE), people, items),
    }
