"""Periodic runs: extensions and runs against direct comparison, the query against its definition."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from tastebud.llm import periods, queries

SF = "/root/testdata/sf0.001"


def some_sequence(rng, n):
    k = rng.choice([1, 2, 3, 10, 50])
    s = [rng.randrange(k) for _ in range(n)]
    for _ in range(rng.randint(0, 4)):
        if n > 3:
            a, p = rng.randrange(n), rng.randint(1, max(1, n // 4))
            for i in range(a + p, rng.randint(a, n)):
                s[i] = s[i - p]
    return s


def brute_runs(s, min_length, min_exponent):
    """All maximal stretches of every period, of equal stretches the smallest period."""
    n, out = len(s), {}
    number = {}
    line = np.array([number.setdefault(x, len(number)) for x in s])
    for p in range(1, n // min_exponent + 1):
        same = np.concatenate([[False], line[:-p] == line[p:], [False]])
        edge = np.flatnonzero(same[1:] != same[:-1])
        for i, j in zip(edge[0::2].tolist(), edge[1::2].tolist()):  # words i to j - 1 come again p later
            if j - i + p >= max(min_length, min_exponent * p):
                out.setdefault((i, j - i + p), p)
    return sorted((a, m, p) for (a, m), p in out.items())


def test_extensions_on_both_sides_are_exact():
    rng = random.Random(2)
    for _ in range(150):
        s = np.array([*some_sequence(rng, rng.choice([1, 2, 5, 20, 60, 200])), 1000])
        grammar = periods.Grammar(s)
        for g, line in ((grammar, s), (grammar.mirror(), s[::-1])):
            a = np.array([rng.randrange(len(s)) for _ in range(200)])
            b = np.array([rng.randint(i + 1, len(s)) for i in a])
            want = []
            for i, j in zip(a, b):
                n = 0
                while j + n < len(s) and line[i + n] == line[j + n]:
                    n += 1
                want.append(n)
            assert g.common(a, b).tolist() == want


def test_runs_equal_those_of_direct_comparison():
    rng = random.Random(3)
    for _ in range(150):
        parts = [some_sequence(rng, rng.choice([0, 1, 30, 80, 150])) for _ in range(rng.randint(1, 4))]
        edges, s = [0], []
        for i, x in enumerate(parts):
            s += [*x, 1000 + i]
            edges.append(len(s))
        least = rng.choice([(24, 3), (5, 2), (4, 3), (1, 5)])
        got = list(zip(*[x.tolist() for x in periods.runs(np.array(s), np.array(edges), *least)]))
        assert got == sorted((a + e, m, p) for x, e in zip(parts, edges) for a, m, p in brute_runs(x, *least))


def test_the_grammar_is_small_and_long_repeats_take_few_levels():
    grammar = periods.Grammar(np.append(np.tile([0, 1, 2, 3, 4, 5, 6], 30_000), 99))
    assert sum(map(len, grammar.sym)) < 5 * 210_001 and len(grammar.sym) < 80
    start, length, period = periods.runs(np.append(np.tile([0, 1, 2, 3, 4, 5, 6], 30_000), 99), np.array([0, 210_001]), 24, 3)
    assert (start.tolist(), length.tolist(), period.tolist()) == ([0], [210_000], [7])


def brute_row(doc_id, text, plant):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1, len(words)
    if plant and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    own = brute_runs(words, 24, 3)
    gone = {i for s, m, p in own for i in range(s + p, s + m)}
    best = None
    for r in own:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (
        doc_id,
        len(own),
        *(best or (None, None, None)),
        1000 * best[1] // best[2] if best else None,
        digest("".join(f"{s},{m},{p}\n" for s, m, p in own)),
        digest(" ".join(w for i, w in enumerate(words) if i not in gone)),
    )


def test_query_equals_its_definition(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = sorted(brute_row(r.doc_id, r.text, True) for r in docs)
    got = sorted(tuple(r) for r in queries.op12_recompressed_runs(spark, SF).collect())
    assert got == want and sum(r[1] > 0 for r in want) > 5


def test_corner_cases(spark):
    once = " ".join(f"w{i}" for i in range(40))
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "a " * 24), (5, "a " * 23), (6, "A a " * 12), (7, "a\tb\nc " * 8), (8, once), (9, f"{once} {once}"),
        (10, f"{once} " * 3), (11, "é" * 3000 + " x" * 30), (None, "z " * 40), (4, "a " * 24), (12, "x " * 50_000), (13, "p q " * 30 + "p p " * 30),
    ]
    frame = spark.createDataFrame([(d, t, 1, "s") for d, t in rows], "doc_id long, text string, start int, runs string")
    got = sorted(((r.doc_id, [tuple(x) for x in r.runs], r.collapsed) for r in periods.find_runs(frame).collect()), key=str)
    want = []
    for d, t in rows:
        words = (t or "").split()
        own = brute_runs(words, 24, 3) if len(words) < 10_000 else [(0, len(words), 1)]
        gone = {i for s, m, p in own for i in range(s + p, s + m)}
        want.append((d, own, " ".join(w for i, w in enumerate(words) if i not in gone)))
    assert got == sorted(want, key=str)
    assert periods.find_runs(frame.limit(0)).collect() == []
    with pytest.raises(ValueError):
        periods.find_runs(frame, min_exponent=1)
