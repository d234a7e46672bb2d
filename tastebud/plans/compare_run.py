"""Compare one user's history with the recommendations saved by an earlier run."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame

from .. import columns as C
from ..operators.compare import compare_user, model_history
from ..sinks import write_delimited
from ..sources import read_results


def run_compare(
    run_folder: str,
    *,
    model: str,
    user: str,
    users: DataFrame,
    accounts: DataFrame,
    items: DataFrame,
    scores: DataFrame | None = None,
    other_logs: Sequence[DataFrame] = (),
    save_to: str | None = None,
) -> dict[str, DataFrame]:
    """Read the run's products back (positional '#' text), attach names, optionally save.

    ``run_folder`` is ``<root>/<model>/<sub_type>/<yyyy-MM-dd-00>``.  Saved
    products: ``<save_to>/User-historys`` and ``<save_to>/User-recommendations``.
    """
    spark = users.sparkSession
    # Text products hold ids as text: read them back as the dimensions' id types.
    types = {C.USER_ID: users.schema[C.PERSON_ID].dataType.simpleString(), C.PRODUCT_CODE: items.schema[C.PRODUCT_CODE].dataType.simpleString()}
    recs = read_results(spark, os.path.join(run_folder, "User-recommendations"), [C.USER_ID, C.PRODUCT_CODE], types=types)
    saved = None
    if model == "Association":
        saved = read_results(spark, os.path.join(run_folder, "User-history-logs"), [C.USER_ID, C.PRODUCT_CODE], types=types)
    history = model_history(model, saved_history=saved, scores=scores, other_logs=other_logs)
    out = compare_user(history, recs, users, accounts, items, user=user)
    if save_to is not None:
        for name, df in out.items():
            write_delimited(df, os.path.join(save_to, name))
    return out
