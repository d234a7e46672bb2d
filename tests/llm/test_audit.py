"""Filter interactions: the Gray-code walk against filters run one after the other."""

import random
from itertools import permutations

import numpy as np

from tastebud.llm import audit

NAMES = "ABCDE"


def brute_fails(rows):
    """Failure flags of (doc_id, text) rows, straight from the definition."""
    import re

    out = []
    for doc_id, text, *_ in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        out.append(
            (
                len(words) < 50,
                100 * len(set(words)) < 65 * len(words),
                100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
                bool(re.search("[#$%&*|]", text)),
                doc_id is not None and any(d is not None and d < doc_id and (t or "") == text for d, t, *_ in rows),
            )
        )
    return out


def brute_report(rows, labels):
    """Every order run filter by filter over the rows that are left."""
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    fails = brute_fails(rows)
    parts, want = {}, {}
    for row, f in zip(rows, fails):
        parts.setdefault(row[2] or "", []).append((row[0], f))
    for part, docs in parts.items():
        total = dict.fromkeys(range(5), 0)
        for order in permutations(range(5)):
            left = docs
            for step, i in enumerate(order, 1):
                gone = [x for x in left if x[1][i]]
                left = [x for x in left if not x[1][i]]
                failing = sum(f[i] for _, f in docs)
                alone = sum(f[i] and sum(f) == 1 for _, f in docs)
                total[i] += len(gone)
                name = "".join(NAMES[j] for j in order)
                want[part, name, step] = [len(left), len(gone), failing - len(gone), alone, i, sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone)]
        for (p, _, _), v in want.items():
            if p == part:
                v[4] = total[v[4]]
    return {k: tuple(v) for k, v in want.items()}


def some_rows(rng, n):
    pool = ["alpha", "Beta", "GAMMA", "d", "é#", "x|y", "ß", "zeta"]
    texts = [" ".join(rng.choice(pool[: rng.randint(1, 8)]) + str(rng.randint(0, rng.choice([2, 90]))) for _ in range(rng.randint(0, 90))) for _ in range(n)]
    texts += [None, "", " \t\n", "A" * 20_000, "w " * 30_000]
    return [(rng.choice([None, *range(40)]), rng.choice(texts), rng.choice(["s", "t", None, ""]), 1, "m") for _ in range(2 * n)]


def test_orders_match_filters_run_in_turn(spark):
    rng = random.Random(13)
    rows = some_rows(rng, 40)
    rows += [rows[0]] * 5
    labels = [(rng.choice([None, *range(50)]), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(60)]
    # names that the operator uses itself are among the columns that it does not read
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, A int, part string").withColumnRenamed("part", "mask")
    found = audit.audit_documents(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    got = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.shapley, r.good_lost, r.toxic_lost) for r in found}
    assert len(found) == len(got) == 600 * len({r[2] or "" for r in rows})
    assert got == brute_report(rows, labels)


def test_empty_tables_give_no_rows_or_no_losses(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit.audit_documents(docs, labels).collect() == []
    one = spark.createDataFrame([(None, None, None)], docs.schema)
    rows = audit.audit_documents(one, labels).collect()
    assert len(rows) == 600 and {r.part for r in rows} == {""}
    assert {(r.removed, r.redundant) for r in rows if r.filter_order[r.step - 1] == "A"} == {(1, 0)}
    assert {r.shapley for r in rows if r.filter_order[r.step - 1] == "A"} == {120}


def test_walk_switches_one_filter_at_a_time_and_equals_direct_sums():
    rng = np.random.default_rng(5)
    for k in (1, 3, 5, 7):
        masks = np.arange(1 << k)
        values = rng.integers(0, 50, (1 << k, 3))
        state = audit.gray_walk(masks, values, k)
        for active in range(1 << k):
            assert (state[active] == values[(masks & active) == 0].sum(axis=0)).all()
        codes = [i ^ (i >> 1) for i in range(1 << k)]
        assert sorted(codes) == list(range(1 << k)) and all(bin(a ^ b).count("1") == 1 for a, b in zip(codes, codes[1:]))


def test_shapley_shares_add_up_to_all_that_goes():
    rng = np.random.default_rng(6)
    values = rng.integers(0, 9, (32, 1))
    rows = audit.order_report(NAMES, np.arange(32), values)
    share = {r[0][r[1] - 1]: r[6] for r in rows}
    assert sum(share.values()) == 120 * (values.sum() - values[0, 0])


def test_a_text_held_by_most_rows_is_marked_right(spark):
    rows = spark.range(3000).selectExpr("id as doc_id", "if(id % 3 = 0, 'same', concat('t', id)) as text", "'s' as source")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    r = audit.audit_documents(rows, labels).filter("filter_order = 'EABCD' and step = 1").collect()
    assert [(x.removed, x.kept) for x in r] == [(999, 2001)]
