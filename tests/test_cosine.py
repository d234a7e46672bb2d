import random

from conftest import rows

from tastebud import columns as C
from tastebud.operators.cosine import adjusted_cosine, corated_pairs, cosine_recommendations, predict_ratings, similar_pairs, split_raters, top_similar_items
from tastebud.operators.evaluate import rating_rmse

RATINGS = [
    ("1", "x", 5.0), ("1", "y", 4.0), ("1", "z", 1.0),
    ("2", "x", 4.0), ("2", "y", 5.0), ("2", "w", 1.0),
    ("3", "x", 5.0), ("3", "w", 2.0),
    ("4", "y", 3.0), ("4", "z", 3.0),
]


def _ratings(spark, data=RATINGS):
    return spark.createDataFrame(data, "USER_ID string, PRODUCT_CODE string, SCORE double")


def test_adjusted_cosine_worked_case(spark):
    sims = adjusted_cosine(_ratings(spark), min_commons=2)
    got = [(i, j, round(s, 6)) for i, j, s in rows(sims)]  # the worked case is given to 6 digits
    want = sorted(
        [("x", "y", 0.689655), ("y", "x", 0.689655), ("w", "x", -0.835785), ("x", "w", -0.835785),
         ("y", "z", -1.0), ("z", "y", -1.0)]
    )
    assert got == want


def test_predictions_and_rmse_worked_case(spark):
    r = _ratings(spark)
    top = top_similar_items(adjusted_cosine(r, min_commons=2), min_sim=0.3, top_sim=20)
    unrated = predict_ratings(r, top, min_rating=2, unrated=True)
    rated = predict_ratings(r, top, min_rating=2, unrated=False)
    assert rows(unrated) == [("3", "y", 5.0), ("4", "x", 3.0)]
    assert rows(rated) == [("1", "x", 4.0), ("1", "y", 5.0), ("2", "x", 5.0), ("2", "y", 4.0)]
    [rmse] = rating_rmse(rated.join(r, [C.USER_ID, C.PRODUCT_CODE])).collect()
    assert abs(rmse["RMSE"] - 1.0) < 1e-12
    recs = cosine_recommendations(unrated, min_rating=2, top_n=1)
    assert rows(recs, C.USER_ID, C.PRODUCT_CODE, C.RANK) == [("3", "y", 1), ("4", "x", 1)]


def test_heavy_user_blocks_give_the_same_pairs(spark):
    # 1 user with 9 items, others small: block_rows=2 forces the blocked join.
    data = [("hot", f"i{k}", float(1 + k % 5)) for k in range(9)]
    data += [(f"u{u}", f"i{k}", float(1 + (u * k) % 5)) for u in range(6) for k in range(u % 4 + 2)]
    r = _ratings(spark, data)
    plain = rows(corated_pairs(r, min_commons=1, block_rows=10_000))
    blocked = rows(corated_pairs(r, min_commons=1, block_rows=2))
    assert len(plain) > 30
    assert [t[:2] + (round(t[2], 9), round(t[3], 9), round(t[4], 9), t[5]) for t in plain] == [
        t[:2] + (round(t[2], 9), round(t[3], 9), round(t[4], 9), t[5]) for t in blocked
    ]


def test_pairs_match_full_self_join(spark):
    """i < j then mirror == the full (i, j), (j, i) self-join."""
    r = _ratings(spark)
    mirrored = {(a, b) for a, b, _ in rows(adjusted_cosine(r, min_commons=1))}
    by_user = {}
    for u, i, _ in RATINGS:
        by_user.setdefault(u, set()).add(i)
    full = {(a, b) for items in by_user.values() for a in items for b in items if a != b}
    assert mirrored == full


def test_top_similar_ranks_and_limits(spark):
    sims = spark.createDataFrame(
        [("a", "b", 0.9), ("a", "c", 0.9), ("a", "d", 0.8), ("a", "e", 0.5)], "PRODUCT_CODE string, j_PRODUCT_CODE string, simularity double"
    )
    got = rows(top_similar_items(sims, min_sim=0.7, top_sim=2))
    assert got == [("a", "b", 0.9), ("a", "c", 0.9)]


def _skewed(rng, users, items, heavy):
    """Most users rate a few items, the heavy ones nearly all."""
    out = {(u, i): rng.randint(1, 5) for u in range(users) for i in rng.sample(range(items), rng.randint(1, 6))}
    out |= {(1000 + u, i): rng.randint(1, 5) for u in range(heavy) for i in range(items) if rng.random() < 0.9}
    return [(u, i, float(s)) for (u, i), s in out.items()]


def test_pruned_pairs_equal_the_full_join(spark):
    rng = random.Random(12)
    for heavy, heavy_times in ((4, 4.0), (9, 1.0), (3, 0.0)):
        data = _skewed(rng, 120, 25, heavy)
        for kind, name in (("int", int), ("string", lambda i: f"p{i}")):
            r = spark.createDataFrame([(u, name(i), s) for u, i, s in data], f"USER_ID int, PRODUCT_CODE {kind}, SCORE double")
            for commons in (2, 5):
                near = lambda df: {(x[0], x[1]): tuple(round(v, 9) for v in x[2:]) for x in df.collect()}
                full = near(corated_pairs(r, min_commons=commons))
                assert full and near(similar_pairs(r, min_commons=commons, heavy_times=heavy_times, block_rows=8)) == full
            if kind == "int":
                sims = {(a, b) for a, b, x in rows(adjusted_cosine(r, min_commons=5)) if x >= 0.4}
                pruned = similar_pairs(r, min_commons=5, min_sim=0.4, heavy_times=heavy_times)
                kept = {(x.PRODUCT_CODE, x.j_PRODUCT_CODE) for x in pruned.collect() if x.i_sq * x.j_sq > 0 and round(x.cross / (x.i_sq * x.j_sq) ** 0.5, 12) >= 0.4}
                assert kept == {(a, b) for a, b in sims if a < b}


def test_heavy_users_build_few_pairs(spark):
    """Three users who rate all of 400 items, 600 who rate five: pairs built from heads against all pairs."""
    rng = random.Random(5)
    data = [(u, i, float(rng.randint(1, 5))) for u in range(600) for i in rng.sample(range(400), 5)]
    data += [(1000 + u, i, float(rng.randint(1, 5))) for u in range(3) for i in range(400)]
    r = spark.createDataFrame(data, "USER_ID int, PRODUCT_CODE long, SCORE double")
    parted, _ = split_raters(r, heavy=20, min_commons=5, at_least=2)
    built = lambda df: df.groupBy("USER_ID").count().selectExpr("sum(count * (count - 1) / 2) as n").first().n
    assert built(r) == 245_400 and built(parted.filter("_head")) <= 6_000
    nine = lambda df: [tuple(round(v, 9) for v in x) for x in rows(df)]
    assert nine(similar_pairs(r, min_commons=5)) == nine(corated_pairs(r, min_commons=5))
