"""Invariants of the ML runs and metamorphic checks on the provided tables (sf0.001)."""

from conftest import rows
from pyspark.sql import functions as F

from tastebud import columns as C
from tastebud.operators.ratings import avg_ratings, dense_index, user_vectors
from tastebud.operators.segments import cluster_users
from tastebud.plans.als_run import run_als
from tastebud.plans.cosine_run import run_cosine
from tastebud.plans.params import AlsParams, CosineParams
from tastebud.sources import bindings as B

SF = "/root/testdata/sf0.001"


def test_als_recommendations_are_new_and_ranked(spark):
    ratings = avg_ratings(B.event_score_log(spark, SF, ("purchase", "view")))
    out = run_als(ratings, AlsParams(rank=5, reg=0.1, max_iter=5, blocks=2, top_n=5))
    recs = out["User-recommendations"]
    assert recs.count() > 0
    assert recs.join(ratings, [C.USER_ID, C.PRODUCT_CODE], "left_semi").count() == 0
    ranks = recs.groupBy(C.USER_ID).agg(F.max(C.RANK).alias("m"), F.count(F.lit(1)).alias("n"), F.min(C.RANK).alias("lo"))
    assert ranks.filter("m != n OR lo != 1 OR n > 5").count() == 0
    preds = out["Rating-predictions"]
    assert preds.filter(F.col(C.PREDICTION) <= 3.0).count() == 0
    metrics = {r[C.METRIC]: r[C.VALUE] for r in out["Recommendation-metrics"].collect()}
    assert float(metrics["RMSE"]) >= 0 and int(metrics["NUM_ALL_USERS"]) == ratings.select(C.USER_ID).distinct().count()


def test_wssse_falls_as_k_rises(spark):
    scores = avg_ratings(B.event_score_log(spark, SF, ("purchase", "view")))
    idx = scores.join(dense_index(scores, C.USER_ID, "u"), C.USER_ID).join(dense_index(scores, C.PRODUCT_CODE, "i"), C.PRODUCT_CODE)
    n_items = scores.select(C.PRODUCT_CODE).distinct().count()
    vecs = user_vectors(idx, n_items=n_items).cache()
    costs = [cluster_users(vecs, k=k, max_iter=20, seed=3)[0].summary.trainingCost for k in (2, 6, 14)]
    assert costs[0] > costs[1] > costs[2]


def test_cosine_run_ignores_input_order(spark):
    ratings = avg_ratings(B.purchase_log(spark, SF))
    p = CosineParams(min_sim=0.7, top_sim=20, min_commons=5, min_rating=2, top_n=10)
    a = run_cosine(ratings, p)
    b = run_cosine(ratings.repartition(5, F.rand(11)).sortWithinPartitions(F.rand(5)), p)
    for name in ("Item-cossimularities", "User-recommendations", "Recommendation-metrics"):
        assert rows(a[name]) == rows(b[name])


def test_rules_holdout_mode_trains_before_end_time(spark):
    from datetime import datetime

    from tastebud.plans.params import RulesParams
    from tastebud.plans.rules_run import time_window_parts

    log = B.shopping_log(spark, SF)
    base = RulesParams(end_time=datetime(2000, 6, 15), min_support=0.02, min_confidence=0.15)
    shared = time_window_parts([log], base)
    split = time_window_parts([log], RulesParams(**{**base.__dict__, "holdout": True}))
    late = F.col(C.EVENT_TIME) >= F.lit("2000-06-15 00:00:00").cast("timestamp_ntz")
    assert shared["processed"].filter(late).count() > 0
    # baskets only from rows before end_time, history without day N; the hold-out is unchanged
    assert split["baskets"].count() <= shared["baskets"].count()
    assert split["history"].filter(F.dayofyear(C.EVENT_TIME) == 167).count() == 0
    assert rows(split["future"]) == rows(shared["future"])
