"""Association-rule recommender runs: full history and seasonal time window."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import columns as C
from ..operators.behavior import behavior_union, bucket_baskets, user_baskets
from ..operators.evaluate import metrics_table, one_row, ratio_text
from ..operators.rules import association_rules, contained_sets, fit_itemsets, frequent_itemsets, release, rule_recommendations
from ..operators.timewin import Season, bucket_events, epoch_ms, holdout_year_cap, parse_event_time, seasonal_future, seasonal_history, seasonal_window
from ..functions import format_datetime
from ..session import cut_lineage
from .params import RulesParams, link_args


def _require(df: DataFrame, what: str) -> None:
    if df.isEmpty():
        raise ValueError(f"not enough data: {what} is empty")


def _raw_rows(logs: Sequence[DataFrame], scores: DataFrame | None) -> list[DataFrame]:
    return list(logs) + ([scores] if scores is not None else [])


def _timed(log: DataFrame, season: Season) -> DataFrame:
    """The log with ``event_time``: as it is, or parsed from its epoch-ms column.

    The raw column gets the bound that no slice looks beyond, as a plain
    predicate that reaches the scan.
    """
    if C.EVENT_TIME in log.columns:
        return log
    raw = next((c for c in (C.SCORE_TIME, C.CREATE_TIME) if c in log.columns), None)
    if raw is None:
        raise ValueError(f"a log needs {C.EVENT_TIME}, {C.CREATE_TIME} or {C.SCORE_TIME}")
    return parse_event_time(log.filter(F.col(raw) < epoch_ms(datetime(holdout_year_cap(season) + 1, 1, 1))), time_col=raw, text=None)


def time_window_parts(
    logs: Sequence[DataFrame],
    params: RulesParams,
    *,
    scores: DataFrame | None = None,
    resource_map: DataFrame | None = None,
    materialize: bool = False,
) -> dict[str, DataFrame]:
    """Intermediate frames of the time-window run.

    With ``materialize`` the behaviour set (read by baskets, history, hold-out
    and metrics) is checkpointed once; otherwise everything stays lazy.
    """
    season = Season.of(params.end_time, params.months)
    logs = [_timed(log, season) for log in logs]
    scores = _timed(scores, season) if scores is not None else None

    def behaviour(cap: int | None) -> DataFrame:
        windowed = [seasonal_window(log, season, year_cap=cap) for log in logs]
        scored = seasonal_window(scores, season, year_cap=cap) if scores is not None else None
        return behavior_union(
            windowed, resource_map, scores=scored, include_scores=params.include_scores, with_time=True
        )

    processed = behaviour(None)
    if materialize:
        processed = cut_lineage(processed)
    cap = holdout_year_cap(season)
    future = seasonal_future(processed if cap == season.year else behaviour(cap), season)
    training = processed
    if params.holdout:
        end = F.lit(params.end_time.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
        training = processed.filter(F.col(C.EVENT_TIME) < end)
    baskets = bucket_baskets(bucket_events(training, days=params.tran_days), max_items=params.max_items)
    history = seasonal_history(processed, season, half_open=params.holdout)
    return {"processed": processed, "history": history, "future": future, "baskets": baskets}


def full_history_parts(
    logs: Sequence[DataFrame],
    params: RulesParams,
    *,
    scores: DataFrame | None = None,
    resource_map: DataFrame | None = None,
    materialize: bool = False,
) -> dict[str, DataFrame]:
    processed = behavior_union(logs, resource_map, scores=scores, include_scores=params.include_scores)
    if materialize:
        processed = cut_lineage(processed)
    return {"processed": processed, "history": processed, "baskets": user_baskets(processed, max_items=params.max_items)}


def run_rules(
    logs: Sequence[DataFrame],
    params: RulesParams = RulesParams(),
    *,
    time_window: bool = True,
    scores: DataFrame | None = None,
    resource_map: DataFrame | None = None,
    check: bool = True,
) -> dict[str, DataFrame]:
    """All products of one run.  Fitting FP-growth is the only barrier.

    Products: User-history-logs, Frequents, Rules, User-frequent-priors,
    User-recommendations, Recommendation-metrics (+ Hold-out for the time
    window).  ``check`` raises ``ValueError`` on an empty processed set,
    history or hold-out, as the reference does.
    """
    build = time_window_parts if time_window else full_history_parts
    parts = build(logs, params, scores=scores, resource_map=resource_map, materialize=True)
    processed, history, baskets = parts["processed"], parts["history"], parts["baskets"]
    if check:
        _require(processed, "processed behaviour")
        if time_window:
            _require(history, "history slice")
            _require(parts["future"], "hold-out slice")
    # read by the fit and by the metrics
    baskets = cut_lineage(baskets, "baskets")
    model = fit_itemsets(
        baskets, min_support=params.min_support, min_confidence=params.min_confidence, num_partitions=params.num_partitions
    )
    # written once, read by every product; the fit's own copies can go
    frequents = cut_lineage(frequent_itemsets(model, max_len=params.max_len))
    rules = cut_lineage(association_rules(model))
    release(model)
    owned = history.select(C.USER_ID, C.PRODUCT_CODE)
    priors = contained_sets(frequents.select("ITEMS"), owned, set_col="ITEMS", max_size=params.max_prior)
    # at most top_n rows a user, read by four metrics and the product
    recs = cut_lineage(rule_recommendations(rules, owned, top_n=params.top_n, max_antecedent=params.max_antecedent))

    counts = {
        "n_raw": _union_count_rows(_raw_rows(logs, scores)),
        "n_processed": processed,
        "n_baskets": baskets,
        "n_users": owned.select(C.USER_ID).distinct(),
        "n_reco_users": recs.select(C.USER_ID).distinct(),
        "n_reco_items": recs.select(C.PRODUCT_CODE).distinct(),
        "n_items": processed.select(C.PRODUCT_CODE).distinct(),
        "n_recs": recs,
    }
    head = [("OP_TIME", params.op_time)]
    if time_window:
        actual = parts["future"].select(C.USER_ID, C.PRODUCT_CODE).distinct()
        counts["n_actual"] = actual
        counts["n_hits"] = recs.select(C.USER_ID, C.PRODUCT_CODE).join(actual, [C.USER_ID, C.PRODUCT_CODE], "left_semi")
        args = link_args(params.min_support, params.min_confidence, params.months, params.max_items, params.top_n, params.num_partitions)
        entries = head + [
            ("ARGUMENTS", args),
            ("NUM_RAW_LOGS", F.col("n_raw")),
            ("NUM_PROCESSED_LOG", F.col("n_processed")),
            ("NUM_ACTION_TRANSACTIONS", F.col("n_baskets")),
            ("NUM_ALL_USERS", F.col("n_users")),
            ("NUM_POSSIBLE_USERS", F.col("n_reco_users")),
            ("NUM_RECOMMEND_ITEMS", F.col("n_reco_items")),
            ("PRECISION", ratio_text("n_hits", "n_recs")),
            ("RECALL", ratio_text("n_hits", "n_actual")),
            ("COVERAGE", ratio_text("n_reco_items", "n_items")),
        ]
    else:
        args = link_args(params.min_support, params.min_confidence, params.max_items, params.top_n, params.num_partitions)
        entries = head + [
            ("ARGUMENTS", args),
            ("NUM_RAW_LOGS", F.col("n_raw")),
            ("NUM_PROCESSED_LOG", F.col("n_processed")),
            ("NUM_ACTION_TRANSACTIONS", F.col("n_baskets")),
            ("NUM_ALL_USERS", F.col("n_users")),
            ("NUM_POSSIBLE_USERS", F.col("n_reco_users")),
            ("NUM_POSSIBLE_ITEMS", F.col("n_reco_items")),
            ("COVERAGE", ratio_text("n_reco_items", "n_items")),
        ]
    metrics = metrics_table(one_row(counts=counts), entries)

    op = F.lit(params.op_time).alias(C.OP_TIME)
    history_cols = [C.USER_ID, C.PRODUCT_CODE] + ([format_datetime(C.EVENT_TIME).alias(C.DATE)] if time_window else [])
    products = {
        "User-history-logs": history.select(*history_cols),
        "Frequents": frequents.select(F.array_join("ITEMS", ",").alias("ITEMS"), "LENGTH", "FREQ", op),
        "Rules": rules.select(
            F.array_join(C.ANTECEDENT, ",").alias(C.ANTECEDENT), C.CONSEQUENT, C.CONFIDENCE, op
        ),
        "User-frequent-priors": priors.select(C.USER_ID, F.array_join("ITEMS", ",").alias("ITEMS"), op),
        "User-recommendations": recs.select(C.USER_ID, C.PRODUCT_CODE, C.RANK, op),
        "Recommendation-metrics": metrics,
    }
    if time_window:
        products["Hold-out"] = parts["future"].select(C.USER_ID, C.PRODUCT_CODE).distinct()
    return products


def _union_count_rows(frames: Sequence[DataFrame]) -> DataFrame:
    """All raw rows of several logs as one frame of a single constant column (for counting)."""
    out = frames[0].select(F.lit(1).alias("_one"))
    for f in frames[1:]:
        out = out.unionByName(f.select(F.lit(1).alias("_one")))
    return out
