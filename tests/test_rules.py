import random
from itertools import combinations

from conftest import rows
from pyspark.sql import functions as F

from tastebud import columns as C
from tastebud.operators.behavior import behavior_union, bucket_baskets, positive_preferences, user_baskets
from tastebud.operators.rules import (
    association_rules,
    contained_sets,
    containment_levels,
    fit_itemsets,
    frequent_itemsets,
    rule_recommendations,
    set_paths,
)


def _baskets(spark, baskets):
    return spark.createDataFrame([(list(b),) for b in baskets], "ITEMS array<string>")


def test_fpgrowth_worked_case(spark):
    model = fit_itemsets(_baskets(spark, ["abc", "ab", "ac", "b"]), min_support=0.3, min_confidence=0.6)
    freq = {(",".join(r["ITEMS"]), r["FREQ"]) for r in frequent_itemsets(model).collect()}
    assert freq == {("a", 3), ("b", 3), ("c", 2), ("a,b", 2), ("a,c", 2)}
    rules = {(",".join(r[C.ANTECEDENT]), r[C.CONSEQUENT], round(r[C.CONFIDENCE], 9)) for r in association_rules(model).collect()}
    assert rules == {("b", "a", round(2 / 3, 9)), ("a", "b", round(2 / 3, 9)), ("c", "a", 1.0), ("a", "c", round(2 / 3, 9))}


def test_itemsets_of_any_size_match_brute_force(spark):
    baskets = ["abcde", "abcd", "abce", "abde", "bcde", "abcde", "ab", "cde"]
    model = fit_itemsets(_baskets(spark, baskets), min_support=0.3, min_confidence=0.5)
    got = {(",".join(r["ITEMS"]), r["FREQ"]) for r in frequent_itemsets(model).collect()}
    need = -(-0.3 * len(baskets) // 1)  # ceil
    want = set()
    for k in range(1, 6):
        for combo in combinations("abcde", k):
            f = sum(1 for b in baskets if set(combo) <= set(b))
            if f >= need:
                want.add((",".join(combo), f))
    assert got == want
    assert max(len(s.split(",")) for s, _ in got) >= 4


def test_containment_join_matches_subset_enumeration(spark):
    history = [("u1", "a"), ("u1", "b"), ("u1", "c"), ("u2", "a"), ("u2", "c"), ("u3", "d"), ("u1", "a")]
    sets = [["a"], ["b"], ["a", "b"], ["a", "c"], ["a", "b", "c"], ["c", "d"], ["a", "b", "c", "d"]]
    h = spark.createDataFrame(history, "USER_ID string, PRODUCT_CODE string")
    s = spark.createDataFrame([(x,) for x in sets], "ITEMS array<string>")
    got = {(r[C.USER_ID], ",".join(r["ITEMS"])) for r in contained_sets(s, h, max_size=3).collect()}
    owned = {}
    for u, i in history:
        owned.setdefault(u, set()).add(i)
    want = set()
    for u, items in owned.items():
        for k in (1, 2, 3):
            for combo in combinations(sorted(items), k):
                if list(combo) in sets:
                    want.add((u, ",".join(combo)))
    assert got == want


def test_rule_recommendations_best_confidence_new_items_only(spark):
    rules = spark.createDataFrame(
        [(["a"], "b", 0.7), (["a", "c"], "b", 0.9), (["c"], "d", 0.8), (["a"], "c", 0.6), (["x"], "y", 1.0)],
        "ANTECEDENT array<string>, CONSEQUENT string, CONFIDENCE double",
    )
    history = spark.createDataFrame([("u1", "a"), ("u1", "c"), ("u2", "a")], "USER_ID string, PRODUCT_CODE string")
    got = rows(rule_recommendations(rules, history, top_n=10), C.USER_ID, C.PRODUCT_CODE, C.CONFIDENCE, C.RANK)
    assert got == [("u1", "b", 0.9, 1), ("u1", "d", 0.8, 2), ("u2", "b", 0.7, 1), ("u2", "c", 0.6, 2)]
    top1 = rows(rule_recommendations(rules, history, top_n=1), C.USER_ID, C.PRODUCT_CODE)
    assert top1 == [("u1", "b"), ("u2", "b")]


def test_positive_preferences_worked_case(spark):
    scores = spark.createDataFrame(
        [("A", "p", "4"), ("A", "p", "2"), ("A", "q", "5"), ("B", "p", "3")], "USER_ID string, PRODUCT_CODE string, SCORE string"
    )
    assert rows(positive_preferences(scores)) == [("A", "p", 4.0), ("A", "q", 5.0)]


def test_behaviour_union_and_baskets(spark):
    log1 = spark.createDataFrame([("u1", "a"), ("u1", "b"), ("u2", "a"), (None, "c")], "USER_ID string, PRODUCT_CODE string")
    log2 = spark.createDataFrame([("u1", "a"), ("u2", None), ("u3", "z")], "USER_ID string, PRODUCT_CODE string")
    beh = behavior_union([log1, log2])
    assert rows(beh) == [("u1", "a"), ("u1", "b"), ("u2", "a"), ("u3", "z")]
    baskets = user_baskets(beh, max_items=100)
    assert rows(baskets, C.USER_ID, "N_ITEMS") == [("u1", 2)]
    assert [list(r["ITEMS"]) for r in baskets.collect()] == [["a", "b"]]
    assert user_baskets(beh, max_items=2).count() == 0


def test_bucket_baskets_count_rows_not_items(spark):
    df = spark.createDataFrame(
        [("u1", "a", 0), ("u1", "a", 0), ("u1", "b", 1), ("u2", "a", 1), ("u1", "c", 1)],
        "USER_ID string, PRODUCT_CODE string, BUCKET long",
    )
    got = {(r[C.USER_ID], r["BUCKET"], tuple(r["ITEMS"]), r["N_ROWS"]) for r in bucket_baskets(df, max_items=100).collect()}
    assert got == {("u1", 0, ("a",), 2), ("u1", 1, ("b", "c"), 2)}


def test_behaviour_union_fills_items_from_resource_map(spark):
    log = spark.createDataFrame(
        [("u1", "r1", None), ("u1", "r2", "b"), ("u2", "r9", None)], "USER_ID string, RES_ID string, PRODUCT_CODE string"
    )
    rmap = spark.createDataFrame([("r1", "a"), ("r1", "c"), ("r2", "z")], "RES_ID string, PRODUCT_CODE string")
    # r1 fans out to a and c; u1/r2 keeps its own item b; u2/r9 has no item and is dropped
    assert rows(behavior_union([log], rmap)) == [("u1", "a"), ("u1", "b"), ("u1", "c")]


def _contained_brute(sets, history):
    owned = {}
    for u, i in history:
        if i:
            owned.setdefault(u, set()).add(i)
    return {(u, tuple(x)) for u, items in owned.items() for x in sets if x and set(x) <= items}


def test_prefix_tree_matches_enumeration_for_sets_of_any_size(spark):
    rng = random.Random(4)
    for trial in range(3):
        pool = [f"i{k}" for k in range(9)] + ["", None]
        history = [(f"u{min(int(rng.expovariate(0.3)), 12)}", rng.choice(pool)) for _ in range(150)]
        sets = [[rng.choice(pool[:-1]) for _ in range(rng.randint(0, 5))] for _ in range(60)] + [["i1", "i1"], ["none"], ["i0", None]]
        h = spark.createDataFrame(history, "USER_ID string, PRODUCT_CODE string")
        s = spark.createDataFrame([(x,) for x in sets * 2], "ITEMS array<string>")
        found = contained_sets(s, h, max_size=None).collect()
        got = {(r[C.USER_ID], tuple(r["ITEMS"])) for r in found}
        assert len(found) == len(got)
        assert got == _contained_brute([x for x in sets if None not in x], history)
    empty = s.limit(0)
    assert contained_sets(empty, h).count() == 0 and contained_sets(s, h.limit(0)).count() == 0


def test_a_hot_item_meets_only_owners_of_the_rarer_ones(spark):
    """Every set holds the item that all users own; each other item has a few owners."""
    history = [(u, 0) for u in range(2000)] + [(u, 1 + u % 200) for u in range(2000)]
    sets = [[0, k] for k in range(1, 201)] + [[0, k, k + 1] for k in range(1, 200)]
    h = spark.createDataFrame(history, "USER_ID int, PRODUCT_CODE int")
    s = spark.createDataFrame([(x,) for x in sets], "ITEMS array<int>")
    members = s.select("ITEMS", F.explode("ITEMS").alias(C.PRODUCT_CODE))
    before = h.join(members, C.PRODUCT_CODE).count()  # each member of each set meets its owners
    paths = set_paths(s, h, set_col="ITEMS", max_size=3)
    assert paths.filter(F.col("_path")[F.size("_path") - 1] == 0).count() == len(sets)  # the hot item comes last
    levels = containment_levels(paths, h, set_col="ITEMS", depth=3)
    after = sum(x.count() for x in levels)
    assert (before, after) == (803_980, 8_000)
    got = {(r[C.USER_ID], tuple(r["ITEMS"])) for r in contained_sets(s, h).collect()}
    assert got == {(u, (0, 1 + u % 200)) for u in range(2000)}


def test_items_without_a_frequent_pair_build_no_trees(spark, monkeypatch):
    """Only the items of frequent pairs go to FP-growth; the others are counted, with the same sets and rules."""
    from tastebud.operators import rules as R

    rng = random.Random(5)
    baskets = [rng.sample("abcdefgh", 3) + (["x", "y"] if k % 2 else []) for k in range(60)] + [[], ["x"]]
    df = _baskets(spark, baskets)
    model = R.fit_itemsets(df, min_support=0.3, min_confidence=0.5)
    mined = {x for r in model.mined.freqItemsets.collect() for x in r["items"]}
    assert mined == {"x", "y"}
    sets = lambda m: {(tuple(r["ITEMS"]), r["FREQ"]) for r in frequent_itemsets(m).collect()}
    got = sets(model)
    want = {((x,), n) for x in "abcdefghxy" if (n := sum(x in b for b in baskets)) >= 0.3 * 62} | {(("x", "y"), 30)}
    assert got == want and len(got) > 4
    monkeypatch.setattr(R, "MAX_PAIRS", 0)
    plain = R.fit_itemsets(df, min_support=0.3, min_confidence=0.5)
    assert sets(plain) == got
    assert sorted(map(str, association_rules(plain).collect())) == sorted(map(str, association_rules(model).collect()))
    alone = R.fit_itemsets(df, min_support=0.99, min_confidence=0.5)
    assert sets(alone) == set() and association_rules(alone).count() == 0
