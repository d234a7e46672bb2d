"""Sharding, mixing, URL filter and chat formatting."""

import hashlib
import itertools
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tastebud.llm import chat, mixing, shards, urls
from tastebud.llm.rows import row_key, without


def test_flow_moves_the_fewest_bytes():
    rng = random.Random(4)
    for _ in range(200):
        supply = {i: rng.randint(0, 60) for i in range(rng.randint(1, 6))}
        capacity = shards.equal_capacities(sum(supply.values()), rng.randint(1, 8))
        pieces = shards.plan_moves(supply, capacity)
        for o in supply:
            spans = sorted((a, b) for old, _, a, b in pieces if old == o)
            assert [a for a, _ in spans] == [0, *[b for _, b in spans[:-1]]][: len(spans)]
            assert sum(b - a for a, b in spans) == supply[o]
        assert all(sum(b - a for _, new, a, b in pieces if new == j) <= c for j, c in enumerate(capacity))
        moved = sum(b - a for old, new, a, b in pieces if old != new)
        assert moved == sum(max(0, s - (capacity[i] if i < len(capacity) else 0)) for i, s in supply.items())


def test_flow_with_costs_matches_enumeration():
    rng = random.Random(8)
    for _ in range(30):
        supply, capacity = [rng.randint(0, 3) for _ in range(3)], [rng.randint(1, 4) for _ in range(3)]
        if sum(supply) > sum(capacity):
            continue
        price = [[rng.randint(0, 5) for _ in range(3)] for _ in range(3)]
        flow = shards.min_cost_flow(supply, capacity, lambda i, j: price[i][j])
        units = [i for i, s in enumerate(supply) for _ in range(s)]
        best = min(
            (sum(price[i][j] for i, j in zip(units, to)) for to in itertools.product(range(3), repeat=len(units)) if all(to.count(j) <= capacity[j] for j in range(3))),
            default=0,
        )
        assert sum(price[i][j] * f for (i, j), f in flow.items()) == best
    with pytest.raises(ValueError):
        shards.min_cost_flow([5], [4], lambda i, j: 0)


def test_reshard_places_every_row_once(spark, tmp_path):
    rng = random.Random(6)
    rows = [(i, "x" * rng.randint(0, 300), rng.choice(["a", "a", "b", None]), 7, "s") for i in range(400)]
    rows += [(1, None, "c", 7, "s"), (None, "y", "a", 7, "s"), rows[0], rows[0]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, slot int, shard string")
    placed = shards.reshard(shards.document_rows(docs, 3), 5).collect()
    assert len(placed) == len(rows)
    by = defaultdict(list)
    for r in placed:
        by[r.shard].append(r)
    assert all(sorted(r.slot for r in v) == list(range(len(v))) for v in by.values())
    sizes = [sum(r["size"] for r in by[s]) for s in range(5)]
    assert max(sizes) - min(sizes) <= 2 * 308
    assert shards.reshard(shards.document_rows(docs.limit(0), 3), 5).count() == 0


def test_reshard_rewrites_only_affected_shards(spark, tmp_path):
    rows = spark.createDataFrame([(i, 0 if i < 60 else 1 if i < 70 else 2, 10, str(i)) for i in range(90)], "row long, old_shard int, size long, key string")
    old, new = str(tmp_path / "old"), str(tmp_path / "new")
    rows.select("row", F.col("old_shard").alias("shard"), F.concat(F.lit("t"), "key").alias("text")).write.partitionBy("shard").parquet(old)
    moves = shards.reshard(rows, 3, capacity=[500, 200, 200])
    assert shards.rewrite_affected(old, new, moves, spark, 3) == [0, 1]
    got = {(r["row"], r["shard"]) for r in spark.read.parquet(new).collect()}
    assert got == {(r["row"], r["shard"]) for r in moves.collect() if r["shard"] in (0, 1)}


def test_targets_stop_at_three_times_the_size():
    assert mixing.target_words([10, 10, 100, 5], [1, 2, 3, 1]) == [20.0, 30.0, 60.0, 15.0]
    assert mixing.target_words([], []) == [] and mixing.target_words([0, 4], [1, 2]) == [0.0, 4.0]


def test_mix_meets_targets(spark):
    rng = random.Random(3)
    rows = [(i, " ".join("w" * 3 for _ in range(rng.randint(0, 400))), rng.choice(["a", "a", "a", "b", "é", None]), 1, 2) for i in range(300)]
    rows += [(7, None, "a", 1, 2), (None, "p q", "zero", 1, 2), (8, "", "none", 1, 2), rows[5], rows[5]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size int, row int")
    mixed = mixing.mix(docs, block=64)
    got = mixed["documents"].collect()
    again = {(r.doc_id, r.row, r.taken) for r in mixing.mix(docs, block=64)["documents"].collect()}
    assert len(got) == len(rows) and {(r.doc_id, r.row, r.taken) for r in got} == again
    words = defaultdict(int)
    for _, t, s, _, _ in rows:
        words[s] += len((t or "").split())
    names = sorted(words, key=lambda s: (s is None, (s or "").encode()))
    target = dict(zip(names, mixing.target_words([words[s] for s in names], [i % 3 + 1.0 for i in range(len(names))])))
    taken = defaultdict(int)
    for r in got:
        assert r.taken <= 3 * r["size"] and r.source_size == words[r.source] and r.target == pytest.approx(target[r.source])
        taken[r.source] += r.taken
    assert all(abs(taken[s] - target[s]) <= 1 for s in names)
    # the stream itself: every prefix of the schedule stays close to the sources' shares
    slots = [r.no for r in mixed["schedule"].orderBy("slot").collect()]
    share = {n: slots.count(n) / len(slots) for n in set(slots)}
    for cut in range(50, len(slots), 50):
        assert all(abs(slots[:cut].count(n) - cut * share[n]) < 6 for n in share)
    assert mixing.mix(docs.limit(0))["documents"].count() == 0


def test_urls(spark):
    cases = {
        "http://WWW.Example.ORG/es/x?a#b": ("www.example.org", "/es/x", "example.org/es/", "block"),
        "https://a.org/en/1": ("a.org", "/en/1", "org/", "allow"),
        "https://example.org/en/100": ("example.org", "/en/100", "example.org/en/1", "block"),
        "https://notexample.org": ("notexample.org", "", None, "allow"),
        "x://com/fr/": ("com", "/fr/", "com/fr/", "allow"),
        "//com/fr/": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        "http://ÉÀ.com/de/\n": ("ÉÀ.com", "/de/\n", "com/de/", "block"),
        "http://bad.net/p/?utm_source=z&b=2&a=1": ("bad.net", "/p/", None, "block"),
        "http://bad.net/p?b=2": ("bad.net", "/p", None, "allow"),
        "http://bad.net/" + "p" * 100000: ("bad.net", "/" + "p" * 100000, None, "allow"),
    }
    rules = [urls.Rule("allow", "org", "/"), urls.Rule("block", "example.org", "/es/"), urls.Rule("block", "example.org", "/en/1"), urls.Rule("allow", "com", "/fr/"), urls.Rule("block", "com", "/de/")]
    given = list(cases) + ["//com/fr/"]
    pages = spark.createDataFrame([(i, u, 1, 2) for i, u in enumerate(given)], "page_id long, url string, block int, rule int")
    listed = spark.createDataFrame([("http://www.bad.net/p?a=1&b=2#x",), (None,)], "u string").select(urls.canonical_url(F.col("u")).alias("canonical"))
    got = urls.judge_urls(pages, listed.union(listed), rules).collect()
    assert len(got) == len(given)
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == cases[given[r.page_id]], given[r.page_id][:80]
    assert urls.judge_urls(pages, listed.limit(0), rules).filter("verdict = 'block' and rule is null").count() == 0
    assert urls.judge_urls(pages.limit(0), listed, rules).count() == 0


def test_bloom_filter_has_no_false_negatives_and_few_positives(spark):
    listed = spark.range(3000).select(F.concat(F.lit("h/"), F.col("id")).alias("canonical"))
    pages = spark.range(9000).select(F.col("id").alias("page_id"), F.concat(F.lit("http://h/"), F.col("id")).alias("url"))
    r = urls.judge_urls(pages, listed, []).agg(F.sum(F.col("listed").cast("int")), F.sum(F.col("maybe_listed").cast("int"))).first()
    assert r[0] == 3000 and 3000 <= r[1] < 3060


def test_escapes_round_trip():
    nasty = ["", "\\", "\\h", "### user: </turn>\n", "####", "</turn>", "\\### Assistant: </turn> ok", " </turn>\n### assistant: x", "é\u2028\U0001f600", "a" * 100000]
    turns = [(r, t) for r in ("user", "assistant", "a: b\n", "") for t in nasty]
    text, starts, ends = chat.format_turns(turns)
    assert chat.read_turns(text) == turns
    assert [chat.unescape(text[s:e]) for s, e in zip(starts, ends)] == nasty
    assert text.count("</turn>") == len(turns) == text.count("###")


def test_reply_trees(spark):
    rows = [(1, 1, None, "user", "q", 0.0), (1, 2, 1, "assistant", "a", 1.0), (1, 3, 1, "assistant", "b", 2.0), (1, 4, 3, "user", None, None), (1, 5, 99, None, "orphan", 0.5)]
    rows += [(2, i, i - 1 if i else None, "user" if i % 2 else "assistant", f"t{i}", 0.0) for i in range(70)]
    rows += [(3, 1, 2, "user", "x", 0.0), (3, 2, 1, "user", "y", 0.0), (None, 1, None, "user", "n", 0.0)]
    messages = spark.createDataFrame(rows, "tree long, node long, parent long, role string, text string, score double")
    paths = defaultdict(list)
    for r in chat.tree_paths(messages, "tree", "node", "parent").orderBy("depth").collect():
        paths[(r.tree, r.leaf)].append(r.node)
    assert paths == {(1, 2): [1, 2], (1, 4): [1, 3, 4], (1, 5): [5], (2, 69): list(range(70)), (None, 1): [1]}
    every = chat.format_branches(messages, score="score", top=None).collect()
    ranks = {(r.tree, r.leaf): r.branch for r in every}
    assert ranks == {(1, 4): 1, (1, 2): 2, (1, 5): 3, (2, 69): 1, (None, 1): 1}
    best = {r.tree: r for r in chat.format_branches(messages, score="score").collect()}
    assert chat.read_turns(best[1].formatted) == [("user", "q"), ("assistant", "b"), ("user", "")]
    assert len(chat.read_turns(best[2].formatted)) == 70


def test_linear_conversations_read_back(spark):
    rows = [(1, 2, "assistant", "b"), (1, 1, "user", "a"), (1, 2, "assistant", "b"), (1, None, None, None), (None, 1, "assistant", "x"), (2, 1, "system", "</turn>")]
    conversations = spark.createDataFrame([(*r, 5) for r in rows], "conv_id long, turn long, role string, text string, node int")
    got = {r.tree: r for r in chat.digests(chat.format_branches(chat.conversation_trees(conversations))).collect()}
    assert set(got) == {1, None, 2} and got[1].n_turns == 4 and got[1].loss_chars == 2
    assert got[1].turns_sha256 == hashlib.sha256(b"\n\nuser\na\nassistant\nb\nassistant\nb\n").hexdigest()
    assert got[1].loss_sha256 == hashlib.sha256(b"bb").hexdigest()
    assert chat.digests(chat.format_branches(chat.conversation_trees(conversations.limit(0)))).count() == 0


def test_without_drops_named_rows_only(spark):
    rows = [(1, "a"), (1, "a"), (2, None), (None, "b"), (3, "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    keys = df.filter("doc_id = 3 or doc_id is null").select(row_key("doc_id").alias("key"))
    assert sorted(map(tuple, without(df, keys, row_key("doc_id")).collect()), key=str) == sorted([(1, "a"), (1, "a"), (2, None)], key=str)
