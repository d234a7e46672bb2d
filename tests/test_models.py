import math

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from tastebud import columns as C
from tastebud.operators.evaluate import catalog_coverage, metrics_table, one_row, precision_recall
from tastebud.operators import retrieval
from tastebud.operators.factors import als_candidates, als_cross_validation, als_fit, als_predictions, als_predictions_above
from tastebud.operators.ratings import avg_ratings, dense_index, preference_scores, user_vectors
from tastebud.operators.segments import assign_to_centres, cluster_users, model_centres, segment_item_scores, segment_recommendations, segment_topn
from tastebud.operators.topn import ranked_top_n
from tastebud.plans.params import SegmentParams
from tastebud.plans.segments_run import run_clusters


def _scores(spark):
    return spark.createDataFrame(
        [("A", "p", "4"), ("A", "p", "2"), ("A", "q", "5"), ("B", "p", "3")], "USER_ID string, PRODUCT_CODE string, SCORE string"
    )


def _log(spark, data):
    return spark.createDataFrame(data, "USER_ID string, PRODUCT_CODE string")


def test_preference_scores_worked_case(spark):
    downloads = _log(spark, [("A", "p"), ("A", "r"), ("A", "r")])
    collects = _log(spark, [("B", "r"), ("C", "q")])
    got = rows(preference_scores(_scores(spark), [(downloads, 0.3), (collects, 0.6)]))
    assert got == [("A", "p", -1.0), ("A", "q", 1.0), ("A", "r", 0.6), ("B", "p", 0.0), ("B", "r", 0.6), ("C", "q", 0.6)]


def test_avg_ratings_fills_and_drops_bad_scores(spark):
    scores = spark.createDataFrame(
        [("u", "r1", None, "4"), ("u", "r1", None, "2"), ("u", "r2", "x", ""), (None, "r1", "p", "3")],
        "USER_ID string, RES_ID string, PRODUCT_CODE string, SCORE string",
    )
    rmap = spark.createDataFrame([("r1", "p")], "RES_ID string, PRODUCT_CODE string")
    assert rows(avg_ratings(scores, rmap)) == [("u", "p", 3.0)]


def test_dense_index_is_contiguous_in_id_order(spark):
    ids = spark.range(0, 997).select(F.format_string("id%05d", (F.col("id") * 7919) % 997).alias("k")).repartition(7)
    out = sorted((r["k"], r["ix"]) for r in dense_index(ids, "k", "ix").collect())
    assert [ix for _, ix in out] == list(range(997))


def test_ranked_top_n_contiguous_ranks(spark):
    df = spark.createDataFrame([("g", f"i{k}", float(k % 3)) for k in range(10)], "g string, item string, s double")
    got = rows(ranked_top_n(df, by="g", score="s", tie="item", n=4), "item", "RANK")
    assert got == sorted([("i2", 1), ("i5", 2), ("i8", 3), ("i1", 4)])


def test_segments_given(spark):
    scores = spark.createDataFrame(
        [("u1", "a", 2.0), ("u2", "a", -3.0), ("u1", "b", 1.0), ("u3", "c", 4.0)], "USER_ID string, PRODUCT_CODE string, SCORE double"
    )
    seg = spark.createDataFrame([("u1", "s1"), ("u2", "s1"), ("u3", "s2")], "USER_ID string, prediction string")
    sums = segment_item_scores(scores, seg)
    assert rows(sums) == [("s1", "a", -1.0), ("s1", "b", 1.0), ("s2", "c", 4.0)]
    top = segment_topn(sums, top_n=5)
    assert rows(top, C.PREDICTION, C.PRODUCT_CODE, C.RANK) == [("s1", "b", 1), ("s2", "c", 1)]
    recs = segment_recommendations(seg, top)
    assert rows(recs) == [("u1", "b", 1), ("u2", "b", 1), ("u3", "c", 1)]
    seen = scores.select(C.USER_ID, C.PRODUCT_CODE)
    assert rows(segment_recommendations(seg, top, exclude_seen=seen)) == [("u2", "b", 1)]


def test_user_vectors_and_kmeans_run(spark):
    data = [(f"u{u}", f"i{i}", float((u // 10) * 3 + (i % 3))) for u in range(30) for i in range(6) if (u + i) % 2 == 0]
    scores = spark.createDataFrame(data, "USER_ID string, PRODUCT_CODE string, SCORE double")
    idx = scores.join(dense_index(scores, C.USER_ID, "u"), C.USER_ID).join(dense_index(scores, C.PRODUCT_CODE, "i"), C.PRODUCT_CODE)
    vecs = user_vectors(idx, n_items=6).collect()
    assert len(vecs) == 30 and all(v["features"].size == 6 and v["features"].numNonzeros() <= 3 for v in vecs)
    out = run_clusters(scores, SegmentParams(k=3, max_iter=10, top_n=2, seed=1))
    assert out["User-clusters"].count() == 30
    recs = out["User-recommendations"]
    assert recs.groupBy(C.USER_ID).count().filter("count > 2").count() == 0
    metrics = {r[C.METRIC]: r[C.VALUE] for r in out["Recommendation-metrics"].collect()}
    assert float(metrics["WSSSE"]) >= 0 and metrics["NUM_ALL_USERS"] == "30"


def _als_ratings(spark):
    rng = np.random.default_rng(3)
    data = [(int(u), int(i), float(rng.integers(1, 6))) for u in range(40) for i in range(25) if rng.random() < 0.4]
    return spark.createDataFrame(data, "u int, i int, SCORE double")


def test_als_candidates_are_exact_top_n(spark, monkeypatch):
    ratings = _als_ratings(spark)
    model = als_fit(ratings, rank=4, reg=0.1, max_iter=5, blocks=2, seed=7)
    uf = {r["id"]: np.array(r["features"]) for r in model.userFactors.collect()}
    itf = {r["id"]: np.array(r["features"]) for r in model.itemFactors.collect()}
    rated = {}
    for r in ratings.collect():
        rated.setdefault(r["u"], set()).add(r["i"])
    top_n = 3
    for first in (2, 1000):  # 2 spreads users and items over several blocks
        monkeypatch.setattr(retrieval, "USER_ROWS", first)
        monkeypatch.setattr(retrieval, "ITEM_ROWS", first)
        cand = als_candidates(model, ratings, top_n=top_n)
        got = {}
        for r in cand.collect():
            got.setdefault(r["u"], []).append((r[C.PREDICTION], r["i"]))
        for u, f in uf.items():
            brute = sorted(((float(np.float32(f @ itf[i])), i) for i in itf if i not in rated.get(u, set())), key=lambda t: (-t[0], t[1]))
            best = [i for _, i in brute[:top_n]]
            mine = [i for _, i in sorted(got.get(u, []), key=lambda t: (-t[0], t[1]))[:top_n]]
            assert mine == best


def test_als_predictions_above_are_every_pair_above(spark):
    ratings = _als_ratings(spark)
    model = als_fit(ratings, rank=4, reg=0.1, max_iter=5, blocks=2, seed=7)
    got = {(r["u"], r["i"]): r[C.PREDICTION] for r in als_predictions_above(model, ratings, min_score=2.5).collect()}
    pairs = ratings.select("u").distinct().crossJoin(ratings.select("i").distinct()).join(ratings, ["u", "i"], "left_anti")
    want = {(r["u"], r["i"]): r[C.PREDICTION] for r in als_predictions(model, pairs, min_score=2.5).collect()}
    assert len(want) > 100 and set(got) == set(want)
    assert all(math.isclose(got[k], want[k], rel_tol=1e-5) for k in want)


def test_als_predictions_query_keeps_more_than_the_best(spark, monkeypatch):
    """The registered query gives every unrated pair above the least score, however many a user has."""
    from tastebud import registry
    from tastebud.plans.params import AlsParams

    rng = np.random.default_rng(3)
    data = [(f"user{u}", f"item{i}", float(rng.integers(3, 6))) for u in range(40) for i in range(25) if rng.random() < 0.4]
    ratings = spark.createDataFrame(data, [C.USER_ID, C.PRODUCT_CODE, C.SCORE])
    params = AlsParams(rank=4, reg=0.1, max_iter=5, blocks=2, top_n=2, min_score=2.5, seed=7)
    monkeypatch.setattr(registry, "_event_ratings", lambda spark, d: ratings)
    monkeypatch.setattr(registry, "ALS_PARAMS", params)
    got = {(r[C.USER_ID], r[C.PRODUCT_CODE]) for r in registry.QUERIES["als_predictions"](spark, "").collect()}
    users, items, indexed = registry.index_ratings(ratings)
    model = als_fit(indexed, rank=4, reg=0.1, max_iter=5, blocks=2, seed=7)
    pairs = users.crossJoin(items).join(ratings, [C.USER_ID, C.PRODUCT_CODE], "left_anti")
    want = {(r[C.USER_ID], r[C.PRODUCT_CODE]) for r in als_predictions(model, pairs, min_score=2.5).collect()}
    assert len(want) > 2 * 40 and got == want


def test_als_cross_validation_shape(spark):
    cv = als_cross_validation(_als_ratings(spark), folds=3, rank=3, reg=0.1, max_iter=3, blocks=2, seed=1).collect()
    assert [r["fold"] for r in cv] == [0, 1, 2]
    assert all(r["train_rmse"] >= 0 and r["test_rmse"] >= 0 for r in cv)


def test_folds_side_by_side_equal_fits_one_by_one(spark):
    ratings = _als_ratings(spark)
    kw = dict(rank=3, reg=0.1, max_iter=3, blocks=2, seed=1)
    fold = F.pmod(F.col("u") * 7 + F.col("i"), F.lit(3))
    got = als_cross_validation(ratings, folds=3, fold=fold, **kw).collect()
    for f, r in enumerate(got):
        model = als_fit(ratings.filter(fold != f), **kw)
        for part, n, rmse in ((fold != f, r["n_train"], r["train_rmse"]), (fold == f, r["n_test"], r["test_rmse"])):
            errors = [(x[C.PREDICTION] - x[C.SCORE]) ** 2 for x in als_predictions(model, ratings.filter(part)).collect()]
            assert n == len(errors) and math.isclose(rmse, math.sqrt(sum(errors) / n), abs_tol=1e-4)


def test_given_centres_agree_with_the_model(spark):
    data = [(f"u{u}", f"i{i}", float((u * i) % 5 - 1 + (u // 10) * 3)) for u in range(30) for i in range(8) if (u + i) % 2 == 0]
    scores = spark.createDataFrame(data, "USER_ID string, PRODUCT_CODE string, SCORE double")
    items = dense_index(scores, C.PRODUCT_CODE, "i")
    idx = scores.join(dense_index(scores, C.USER_ID, "u"), C.USER_ID).join(items, C.PRODUCT_CODE)
    vectors = user_vectors(idx, n_items=8)
    model, labelled = cluster_users(vectors, k=3, seed=1)
    want = dict(labelled.join(idx.select(C.USER_ID, F.col("u").alias("label")).distinct(), "label").select(C.USER_ID, C.PREDICTION).collect())
    got = assign_to_centres(scores, model_centres(model, items), k=3).collect()
    assert {r[C.USER_ID]: r[C.PREDICTION] for r in got} == want
    assert math.isclose(sum(r["distance"] for r in got), model.summary.trainingCost, rel_tol=1e-6)


def test_given_centres_corner_cases(spark):
    centres = spark.createDataFrame([(0, "a", 3.0), (1, "b", 1.0)], "prediction int, PRODUCT_CODE string, value double")
    scores = spark.createDataFrame([("x", "a", 3.0), ("y", "z", 2.0), ("n", "b", None), ("m", "a", -1.0)], "USER_ID string, PRODUCT_CODE string, SCORE double")
    got = {r[C.USER_ID]: (r[C.PREDICTION], r["distance"]) for r in assign_to_centres(scores, centres, k=3).collect()}
    # centre 2 has no values: it lies at the origin
    assert got == {"x": (0, 0.0), "y": (2, 4.0), "n": (2, 0.0), "m": (2, 1.0)}
    assert assign_to_centres(scores.limit(0), centres, k=3).count() == 0
    assert {r["distance"] for r in assign_to_centres(scores.limit(1), centres.limit(0), k=2).collect()} == {9.0}


def test_precision_recall_and_coverage(spark):
    recs = _log(spark, [("u1", "a"), ("u1", "b"), ("u2", "a")])
    hold = _log(spark, [("u1", "a"), ("u1", "a"), ("u2", "c"), ("u3", "d")])
    [pr] = precision_recall(recs, hold).collect()
    assert (pr["TP"], pr["NUM_RECOMMENDED"], pr["NUM_HOLDOUT"]) == (1, 3, 3)
    assert math.isclose(pr["PRECISION"], 1 / 3) and math.isclose(pr["RECALL"], 1 / 3)
    [cov] = catalog_coverage(recs, hold.union(recs)).collect()
    assert (cov["NUM_RECOMMEND_ITEMS"], cov["NUM_ITEMS"], cov["COVERAGE"]) == (2, 4, 0.5)
    [empty] = precision_recall(recs.limit(0), hold.limit(0)).collect()
    assert empty["PRECISION"] is None


def test_metrics_table_order_and_text(spark):
    stats = one_row(counts={"n": _log(spark, [("a", "b")] * 3)}, means={"m": (spark.range(4), F.col("id"))})
    out = metrics_table(stats, [("OP_TIME", "2017032000"), ("N", F.col("n")), ("M", F.col("m"))]).collect()
    assert [(r[C.METRIC], r[C.VALUE]) for r in out] == [("OP_TIME", "2017032000"), ("N", "3"), ("M", "1.5")]


def test_metrics_as_text_lines(spark):
    from tastebud.operators.evaluate import metrics_lines

    stats = one_row(counts={"n": _log(spark, [("a", "b")] * 2)})
    lines = metrics_lines(metrics_table(stats, [("OP_TIME", "2017032000"), ("N", F.col("n"))])).collect()
    assert [r.value for r in lines] == ["OP_TIME : 2017032000", "N : 2"]


def test_user_vectors_are_built_without_python(spark):
    """Exact doubles in sparse vectors, no Python step in the plan, and an error for repeated items or null scores."""
    data = {0: [(0, 0.1), (2, 1 / 3), (7, -1e-300)], 1: [(3, 0.0), (6, 1.7976931348623157e308)], 2: [(5, 123456789.12345679)]}
    frame = lambda rows: spark.createDataFrame(rows, "u int, i long, SCORE double")
    vectors = user_vectors(frame([(u, i, x) for u, e in data.items() for i, x in e]), n_items=8)
    assert "Python" not in vectors._jdf.queryExecution().executedPlan().toString()
    got = {r["label"]: (r["features"].size, list(zip(r["features"].indices.tolist(), r["features"].values.tolist()))) for r in vectors.collect()}
    assert got == {u: (8, e) for u, e in data.items()}
    for wrong in ([(0, 1, 1.0), (0, 1, 2.0)], [(0, 1, None)], [(0, 8, 1.0)]):
        with pytest.raises(Exception, match="items of a user"):
            user_vectors(frame(wrong), n_items=8).collect()
