"""Profile and top-N vs direct Python computations on random data."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tastebud.operators.cleansing import column_profile
from tastebud.operators.topn import ranked_top_n

cell = st.one_of(st.none(), st.just(""), st.sampled_from(["a", "b", "c", "d"]))


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=st.lists(st.tuples(cell, cell), min_size=1, max_size=40))
def test_column_profile_matches_python(spark, data):
    df = spark.createDataFrame(data, "x string, y string")
    got = {r["cname"]: (round(r["nonePercent"], 12), r["dispersion"], round(r["modePercent"], 12)) for r in column_profile(df).collect()}
    for k, name in enumerate(("x", "y")):
        values = [row[k] for row in data]
        present = [v for v in values if v not in (None, "")]
        counts = {v: present.count(v) for v in set(present)}
        mode = max(counts.values()) / len(present) if present else 0.0
        assert got[name] == (round(1 - len(present) / len(values), 12), len(counts), round(mode, 12))


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    data=st.lists(st.tuples(st.sampled_from(["g1", "g2", "g3"]), st.integers(0, 30), st.integers(0, 4)), min_size=1, max_size=60, unique_by=lambda t: (t[0], t[1])),
    n=st.integers(1, 5),
)
def test_ranked_top_n_matches_python(spark, data, n):
    df = spark.createDataFrame([(g, f"i{i:02d}", float(s)) for g, i, s in data], "g string, item string, s double")
    got = sorted((r["g"], r["item"], r["RANK"]) for r in ranked_top_n(df, by="g", score="s", tie="item", n=n).collect())
    want = []
    for g in {t[0] for t in data}:
        rows = sorted(((-s, f"i{i:02d}") for gg, i, s in data if gg == g))
        want += [(g, item, k + 1) for k, (_, item) in enumerate(rows[:n])]
    assert got == sorted(want)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    data=st.lists(
        st.tuples(st.integers(0, 7), st.integers(0, 9), st.integers(1, 5)), min_size=4, max_size=60, unique_by=lambda t: (t[0], t[1])
    ),
    block_rows=st.sampled_from([2, 3, 10_000]),
    min_commons=st.integers(1, 3),
)
def test_adjusted_cosine_matches_definition(spark, data, block_rows, min_commons):
    from tastebud.operators.cosine import adjusted_cosine

    df = spark.createDataFrame([(f"u{u}", f"i{i}", float(r)) for u, i, r in data], "USER_ID string, PRODUCT_CODE string, SCORE double")
    got = {(r[0], r[1]): r[2] for r in adjusted_cosine(df, min_commons=min_commons, block_rows=block_rows).collect()}
    by_user = {}
    for u, i, r in data:
        by_user.setdefault(f"u{u}", {})[f"i{i}"] = float(r)
    dev = {u: {i: round(r - sum(v.values()) / len(v), 9) for i, r in v.items()} for u, v in by_user.items()}
    items = sorted({f"i{i}" for _, i, _ in data})
    want = {}
    for a in items:
        for b in items:
            if a == b:
                continue
            common = [d for d in dev.values() if a in d and b in d]
            if len(common) < min_commons:
                continue
            cross = sum(d[a] * d[b] for d in common)
            sa, sb = sum(d[a] ** 2 for d in common), sum(d[b] ** 2 for d in common)
            want[(a, b)] = 0.0 if sa * sb == 0 else cross / (sa ** 0.5 * sb ** 0.5)
    assert set(got) == set(want)
    assert all(abs(got[k] - want[k]) <= 1e-6 for k in want)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    scores=st.lists(st.tuples(st.sampled_from("ABC"), st.sampled_from("pqr"), st.integers(1, 5)), max_size=12),
    downloads=st.lists(st.tuples(st.sampled_from("ABCD"), st.sampled_from("pqrs")), max_size=12),
    collects=st.lists(st.tuples(st.sampled_from("ABCD"), st.sampled_from("pqrs")), max_size=12),
)
def test_preference_scores_match_definition(spark, scores, downloads, collects):
    from tastebud.operators.ratings import preference_scores

    s = spark.createDataFrame([(u, i, str(r)) for u, i, r in scores], "USER_ID string, PRODUCT_CODE string, SCORE string")
    d = spark.createDataFrame(downloads, "USER_ID string, PRODUCT_CODE string")
    c = spark.createDataFrame(collects, "USER_ID string, PRODUCT_CODE string")
    got = {(r[0], r[1]): r[2] for r in preference_scores(s, [(d, 0.3), (c, 0.6)]).collect()}
    explicit = {}
    for u, i, r in scores:
        explicit.setdefault((u, i), []).append(r)
    explicit = {k: sum(v) / len(v) for k, v in explicit.items()}
    means = {}
    for (u, _), v in explicit.items():
        means.setdefault(u, []).append(v)
    implicit = {}
    for log, w in ((downloads, 0.3), (collects, 0.6)):
        for key in log:
            implicit[key] = implicit.get(key, 0.0) + w
    want = {}
    for key in set(explicit) | set(implicit):
        if key in explicit:
            want[key] = explicit[key] - sum(means[key[0]]) / len(means[key[0]])
        else:
            want[key] = implicit[key]
    assert set(got) == set(want)
    assert all(abs(got[k] - want[k]) < 1e-8 for k in want)
