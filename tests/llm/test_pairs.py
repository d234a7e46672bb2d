"""Near-duplicate texts and vectors, and benchmark windows, against brute force on small tables."""

import hashlib
import itertools
import random
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tastebud.llm import decontam, jaccard, vectors
from tastebud.llm.components import components
from tastebud.llm.decontam import contamination

SYLLABLES = "ba ce di fo gu ha je ki lo mu na pe".split()


def words(rng, n, pool=400):
    vocabulary = ["".join(p) for p in itertools.product(SYLLABLES, repeat=3)][:pool]
    return [rng.choice(vocabulary) for _ in range(n)]


def shingles(text, width):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def reach(ids, links):
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def corpus(rng, groups, size, edits):
    """Texts with groups of copies that differ in up to ``edits`` words, some passages shared by many."""
    passage, out = words(rng, 30), []
    for g in range(groups):
        base = words(rng, rng.randint(3, 90))
        if g % 3 == 0:
            base = base[: len(base) // 2] + passage + base[len(base) // 2 :]
        for _ in range(rng.randint(1, size)):
            w = list(base)
            for _ in range(rng.randint(0, edits)):
                w[rng.randrange(len(w))] = words(rng, 1)[0]
            out.append(" ".join(w))
    return out


@pytest.mark.parametrize("width,num", [(4, 85), (5, 80)])
def test_jaccard_components_match_brute_force(spark, width, num):
    rng = random.Random(width)
    texts = corpus(rng, 40, 6, 4) + corpus(rng, 2, 90, 3) + ["", " \t", "one", "ONE", "one two", "two one", None, "x " * 5000]
    rows = list(enumerate(texts)) + [(0, texts[0]), (None, texts[0])]
    rng.shuffle(rows)
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, n int, token int")
    got = jaccard.near_duplicates(docs, width, num).collect()
    sets = {i: shingles(t, width) for i, t in enumerate(texts)}
    links = [(a, b) for a, b in itertools.combinations(sets, 2) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])]
    want = reach(list(sets), links)
    assert len(got) == len(rows)
    assert any(len(sets[a]) > 20 for a, _ in links)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None
        else:
            assert (r.n_shingles, r.component_id) == (len(sets[r.doc_id]), want[r.doc_id])


def test_jaccard_clumps_match_brute_force(spark, monkeypatch):
    """Small limits send most pairs through heavy shingles and several blocks."""
    monkeypatch.setattr(jaccard, "HEAVY", 4)
    monkeypatch.setattr(jaccard, "BLOCK", 8)
    rng = random.Random(7)
    texts = corpus(rng, 6, 40, 6)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard.near_duplicates(docs, 4, 85).collect()}
    sets = [shingles(t, 4) for t in texts]
    links = [(a, b) for a, b in itertools.combinations(range(len(sets)), 2) if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    assert got == reach(range(len(texts)), links)


def test_jaccard_rows_that_repeat_an_id_go_by_their_own_text(spark):
    rng = random.Random(21)
    a, b = words(rng, 60), words(rng, 60)
    near = lambda w: " ".join(w[:-1] + ["changed"])
    rows = [(5, " ".join(a)), (5, " ".join(b)), (7, near(a)), (3, near(b)), (9, "alone in the world"), (9, near(a)), (9, None)]
    got = sorted(map(tuple, jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "n_shingles", "component_id").collect()))
    assert got == [(3, 56, 3), (5, 56, 3), (5, 56, 5), (7, 56, 5), (9, 0, 9), (9, 1, 9), (9, 56, 5)]


def test_jaccard_empty_table(spark):
    assert jaccard.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_levels_never_pass_over_every_shared_shingle():
    """What two linked sets share in their pools always holds a shingle that both look for."""
    rng = np.random.default_rng(3)
    for _ in range(300):
        n = int(rng.integers(1, 200))
        df = rng.choice([2, 3, 30, 60], size=n, p=[0.2, 0.1, 0.4, 0.3])
        pool = int(jaccard.pool_length(np.int64(n), 85, 100))
        pos, tokens = np.arange(pool), rng.permutation(n)[:pool]
        level, keep, passed = jaccard.choose_level(n, pos, df[:pool], tokens, 85, 100)
        base = n - int(jaccard.least_overlap(n, 85, 100))
        assert 1 <= level <= int(jaccard.own_level(np.int64(n), 85, 100))
        inside = pos < base + level
        assert (inside & ~keep).sum() < level  # fewer are passed over than must be shared


def test_components_of_chains_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(9, k) for k in range(10, 40)] + [(5, 5), (3, 2), (2, 3), (None, 1)]
    random.Random(1).shuffle(links)
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 9 for i in range(9, 40)}, 5: 5, 2: 2, 3: 2}


def test_near_vectors_match_brute_force(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 24))
    x[100:180] = x[0] + rng.normal(size=(80, 24)) * 0.12
    x[200:210] = x[1]
    x[211] = x[1] * 1e200
    rows = [(i, [float(v) for v in row], 0) for i, row in enumerate(x)]
    bad = [None, [], [0.0] * 24, [None] + [1.0] * 23, [float("nan")] * 24, [float("inf")] + [1.0] * 23]
    rows += [(1000 + i, v, 0) for i, v in enumerate(bad)] + [(None, rows[0][1], 0), (2000, [1.0, 2.0], 0), (2001, [2.0, 4.0], 0)]
    got = vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, list int"), 0.95).collect()
    good = {i: np.pad(np.array(v), (0, 24 - len(v))) for i, v, _ in rows if i is not None and (i < 1000 or i >= 2000)}
    unit = {i: (v / np.abs(v).max()) / np.linalg.norm(v / np.abs(v).max()) for i, v in good.items()}
    links = [(a, b) for a, b in itertools.combinations(unit, 2) if unit[a] @ unit[b] >= 0.95]
    want = reach(list(unit), links)
    degree = {i: sum(i in p for p in links) for i in unit}
    assert len(got) == len(rows)
    for r in got:
        if r.vec_id is None:
            assert (r.n_links, r.component_id) == (0, None)
        else:
            assert (r.n_links, r.component_id) == (degree.get(r.vec_id, 0), want.get(r.vec_id, r.vec_id))
            assert r.kept == (r.vec_id == r.component_id)
    assert vectors.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_near_vectors_recall(spark):
    """Recall of links against all pairs, on vectors whose cosines crowd around the threshold."""
    rng = np.random.default_rng(9)
    base = rng.normal(size=(60, 64))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    noise = rng.normal(size=(1500, 64))
    noise /= np.linalg.norm(noise, axis=1, keepdims=True)
    x = base[rng.integers(0, 60, 1500)] + noise * rng.uniform(0.05, 0.35, size=(1500, 1))
    got = vectors.near_vectors(spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, embedding array<double>")).agg(F.sum("n_links")).first()[0]
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = int((unit @ unit.T >= 0.95).sum()) - len(x)
    assert want > 1000 and 0.99 * want <= got <= want


@pytest.mark.parametrize("dim", [12, 64, 256])
def test_near_vectors_of_a_low_rank_group(spark, monkeypatch, dim):
    """A group that varies in three directions and is spread over many lists: its links cross their borders at right angles."""
    monkeypatch.setattr(vectors, "LIST_SIZE", 20)
    rng = np.random.default_rng(dim)
    x = rng.normal(size=(900, dim))
    span = np.linalg.qr(rng.normal(size=(dim, 3)))[0]
    x[300:] = x[0] + rng.normal(size=(600, 3)) @ span.T * np.linalg.norm(x[0]) * 0.25
    x[890:] = x[880]  # equal vectors: an entry with a weight
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    got = {r.vec_id: r.n_links for r in vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = (unit @ unit.T >= 0.95).sum(axis=1) - 1
    assert want.sum() > 10_000
    assert [got[i] for i in range(len(x))] == want.tolist()


GAP = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.mark.parametrize("broadcast_rows", [decontam.BROADCAST_ROWS, 0])
def test_contamination_matches_brute_force(spark, monkeypatch, broadcast_rows):
    monkeypatch.setattr(decontam, "BROADCAST_ROWS", broadcast_rows)
    rng = random.Random(2)
    items = [" ".join(words(rng, n, 30)) for n in (14, 25, 40, 9, 3, 2, 1)] + ["", None, "Émile's ÉTÉ a-b"]
    items.append(items[1])
    texts = [" ".join(words(rng, rng.randint(0, 60), 30)) for _ in range(60)]
    for t in items[:8]:
        texts.append(" ".join(words(rng, 5, 30)) + ". " + t.upper() + "! " + " ".join(words(rng, 5, 30)))
    texts += ["émile's été A B", "Émile S ÉTÉ a/B", "", None, items[2] * 2, "ba " * 3000]
    rows = list(enumerate(texts)) + [(3, texts[3])]
    windows = {}
    for k, t in enumerate(items):
        w = GAP.findall((t or "").translate(LOWER))
        m = min(10, len(w))
        for i in range(len(w) - m + 1 if m else 0):
            windows.setdefault(tuple(w[i : i + m]), set()).add(str(k))
    docs = spark.createDataFrame([(i, t, "r") for i, t in rows], "doc_id long, text string, row string")
    bench = spark.createDataFrame([(i, t, 3) for i, t in enumerate(items)], "item_id long, text string, win int")
    got = contamination(docs, bench).collect()
    assert len(got) == len(rows)
    for r in got:
        w = GAP.findall((texts[r.doc_id] or "").translate(LOWER))
        hit, found = set(), set()
        for m in {len(k) for k in windows}:
            for i in range(len(w) - m + 1):
                if (own := windows.get(tuple(w[i : i + m]))) is not None:
                    hit.update(range(i, i + m))
                    found |= own
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == (len(w), len(hit), len(found), digest, bool(hit))
    assert sum(r.contaminated for r in got) > 8
    none = contamination(docs, bench.limit(0))
    assert none.filter("contaminated").count() == 0 and none.count() == len(rows)
    assert contamination(docs.limit(0), bench).count() == 0


def test_many_benchmark_shingles_shuffle_places_only(spark):
    """The exact join's exchanges are keyed by the shingle and hold no array of words."""
    docs = spark.range(50).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit("one two three four"), F.col("id").cast("string")).alias("text"))
    grams = spark.createDataFrame([("one two three", 3), ("two three", 2), ("not there at", 3)], "gram string, q int")
    base = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", decontam.words(F.col("text")).alias("w"))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = decontam.many_grams(base, grams, [2, 3], 3)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert found.filter("gram is null").count() == 50
        assert {(r.gram, r.pos, r.n) for r in found.filter("gram is not null").groupBy("gram", "pos").agg(F.count("*").alias("n")).collect()} == {("one two three", 0, 50), ("two three", 1, 50)}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(exchanges) == 2 and all("hashpartitioning(gram#" in line for line in exchanges)
    assert set(found.columns) == {"row", "doc_id", "n_words", "pos", "gram"}


def test_near_vectors_of_repeated_ids(spark):
    """Rows of one id and different vectors are vectors of their own."""
    rng = np.random.default_rng(8)
    rows = [(5, [0, 1, 0]), (5, [0, 0.999, 0.01]), (5, [0, 0, 0.98]), (7, [0, 1, 0.02]), (9, [0, 0, 1]), (1, [1, 0, 0]), (3, [1, 0.01, 0]), (5, [0, 0, 0.98])]
    base = rng.normal(size=(6, 3))
    rows += [(int(rng.integers(20, 30)), (base[k % 6] + rng.normal(size=3) * 0.1).tolist()) for k in range(60)]
    rows = [(i, [float(x) for x in v]) for i, v in rows]
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect())
    unit = [np.array(v) / np.linalg.norm(v) for _, v in rows]
    links = [(a, b) for a, b in itertools.combinations(range(len(rows)), 2) if unit[a] @ unit[b] >= 0.95]
    root = reach(list(range(len(rows))), links)
    least = {}
    for k, (i, _) in enumerate(rows):
        least[root.get(k, k)] = min(i, least.get(root.get(k, k), i))
    want = [(i, sum(k in p for p in links), least[root.get(k, k)], i == least[root.get(k, k)]) for k, (i, _) in enumerate(rows)]
    assert got == sorted(want)


def test_filter_of_keys_is_bounded_and_misses_none(spark):
    """What the driver holds of the keys does not grow with them: 120,000 keys are 32,768 rows at most; the rows found are exact."""
    from tastebud.llm import rows as R

    table = spark.range(200_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id") % 1000).alias("text"))
    table = table.unionByName(spark.createDataFrame([(None, None), (5, "text 5")], "doc_id long, text string"))
    key = R.row_key("doc_id", "text")
    keys = table.filter("doc_id is null or doc_id % 5 < 3").select(key.alias("key")).distinct().withColumn("mark", F.lit(1))
    assert keys.count() == 120_001
    assert R.key_filter(keys).count() <= 1 << 15
    own = R.packed(table, key)
    sure = R.maybe(own, keys, "left_anti")
    assert sure.join(keys, "key").count() == 0 and sure.count() > 70_000
    assert R.among(table, keys, key).agg(F.count("*"), F.sum("doc_id"), F.sum("mark")).first()[0:3] == (120_002, sum(i for i in range(200_000) if i % 5 < 3) + 5, 120_002)
    assert R.packed_among(table, keys, key).filter("row.doc_id % 5 >= 3").count() == 0
    rest = R.without(table, keys, key)
    assert rest.columns == table.columns and rest.count() == 80_000 and rest.filter("doc_id % 5 < 3 or doc_id is null").count() == 0


def test_a_vector_goes_once_to_a_group_of_lists(spark, monkeypatch):
    """However many lists a vector searches, it is dealt to each group once, with its probes there; a list longer than a group is shared."""
    rng = np.random.default_rng(4)
    lists, n, groups = 60, 500, 5
    probes = [np.unique(rng.integers(0, lists, 30)).astype(np.uint16) for _ in range(n)]
    home = np.array([p[0] for p in probes], np.int32)
    counts = np.bincount(home, minlength=lists)
    side = vectors.Side(np.arange(n), np.ones(n, np.int64), rng.normal(size=(n, 4)), home, np.zeros((n, 2), np.uint8), np.zeros(n), np.array([len(p) for p in probes], np.int32), np.concatenate(probes))
    first, span = vectors.groups_of_lists(counts, groups)
    rows = list(vectors.deal(side, first, span, groups))
    assert sum(r["n"] for _, seeks, r in rows if not seeks) == n
    seeking = [(g, vectors.Side.unpacked(pd.DataFrame([r]), 4, "double")) for g, seeks, r in rows if seeks]
    assert len(seeking) == groups and sum(len(s.ids) for _, s in seeking) <= n * groups < sum(map(len, probes)) / 4
    got = {i: set() for i in range(n)}
    for g, s in seeking:
        for i, a, b in zip(s.ids, s.first, s.first[1:]):
            assert all(first[p] <= g < first[p] + span[p] for p in s.probes[a:b])
            got[int(i)] |= set(s.probes[a:b].tolist())
    assert got == {i: set(p.tolist()) for i, p in enumerate(probes)}
    assert vectors.groups_of_lists(np.array([10, 400, 0, 90]), 5)[1].tolist() == [1, 5, 1, 1]

    # a clump that one list holds, of more vectors than a group and than a tile
    monkeypatch.setattr(vectors, "BLOCK", 64)
    x = rng.normal(size=(700, 16))
    x[200:] = x[0] + rng.normal(size=(500, 16)) * 0.08
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    for kind in ("double", "float"):
        rows = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], f"vec_id long, embedding array<{kind}>")
        found = {r.vec_id: (r.n_links, r.component_id) for r in vectors.near_vectors(rows, 0.95).collect()}
        exact = unit if kind == "double" else x.astype(np.float32).astype(float) / np.linalg.norm(x.astype(np.float32).astype(float), axis=1, keepdims=True)
        near = exact @ exact.T >= 0.95
        assert [found[i][0] for i in range(len(x))] == (near.sum(axis=1) - 1).tolist()
