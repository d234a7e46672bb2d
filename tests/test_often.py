"""Pairs counted by codes before they are built, against the full join."""

import random

import pytest
from pyspark.sql import functions as F

from tastebud.operators import cosine as K
from tastebud.operators import often as O


def _rounded(df):
    return {(x[0], x[1]): tuple(round(v, 6) for v in x[2:]) for x in df.collect()}


def _sparse(rng, users, items, heavy=0):
    data = {(u, rng.choice((i, i // 9))): float(rng.randint(1, 5)) for u in range(users) for i in rng.sample(range(items), rng.randint(2, 8))}
    data |= {(1000 + u, i): float(rng.randint(1, 5)) for u in range(heavy) for i in range(0, items, 3)}
    return [(u, i, s) for (u, i), s in data.items()]


def _brute(data, commons):
    """Sums over common raters, repeated ratings each on their own."""
    users, out = {}, {}
    for u, i, x in data:
        users.setdefault(u, []).append((i, x))
    for held in users.values():
        mean = sum(x for _, x in held) / len(held)
        dev = [(i, round(x - mean, 9)) for i, x in held]
        for i, d in dev:
            for j, e in dev:
                if i < j:
                    s = out.setdefault((i, j), [0.0, 0.0, 0.0, 0])
                    s[0], s[1], s[2], s[3] = s[0] + d * e, s[1] + d * d, s[2] + e * e, s[3] + 1
    return {k: tuple(round(v, 6) for v in s) for k, s in out.items() if s[3] >= commons}


@pytest.mark.parametrize("kind, codes, counted, passed, block_rows", [("int", 65_536, 2_000_000, 8_000_000, 2048), ("string", 16, 40, 60, 8)])
def test_counted_pairs_equal_the_full_join(spark, monkeypatch, kind, codes, counted, passed, block_rows):
    name = int if kind == "int" else lambda i: f"p{i}"
    data = [(u, name(i), s) for u, i, s in _sparse(random.Random(4), 200, 120, heavy=2)]
    data += data[:30]  # ratings that the table repeats
    r = spark.createDataFrame(data + [(None, name(1), 2.0)], f"USER_ID int, PRODUCT_CODE {kind}, SCORE double")
    monkeypatch.setattr(K, "MANY_PAIRS", 0)
    for key, value in {"CODES": codes, "COUNTED": counted, "PASSED": passed}.items():
        monkeypatch.setattr(O, key, value)
    want = _brute(data, 4)
    assert len(want) > 20 and _rounded(K.corated_pairs(r, min_commons=4, block_rows=block_rows)) == want


def test_rare_pairs_never_become_rows(spark):
    """4,000 users of 12 among 4,000 items, five users of three items in common: 264,000 co-ratings, few pairs built."""
    rng = random.Random(2)
    data = {(u, i) for u in range(4000) for i in rng.sample(range(4000), 12)} | {(u, i) for u in range(5) for i in (1, 2, 3)}
    placed = spark.createDataFrame(sorted(data), "USER_ID long, _place long").withColumn("_blocks", F.lit(1))
    met = O.often_met(placed, 5, 8)
    assert met.count() <= 100
    assert {(x.USER_ID, x._i, x._code + O.CODES // 2) for x in met.collect()} >= {(u, i, j) for u in range(5) for i, j in ((2, 1), (3, 1), (3, 2))}
