"""Toxicity, token counts, language id and the pipeline."""

import base64
import itertools
import random

import numpy as np
import pytest
import tiktoken
from pyspark.sql import functions as F

from tastebud.llm import langid, tokens, toxicity
from .test_pairs import GAP, LOWER, reach, shingles

CLEAN = "the of to river mountain garden window table letter morning yellow silent travel kitchen paper summer".split()
INSULTS = "grobnak vilethud snarkel".split()


def subsequence_kernel(s, t):
    """Sum over subsequences of P letters of span at most SPAN, each occurrence weighing DECAY ** span."""

    def features(w):
        out = {}
        for at in itertools.combinations(range(len(w)), toxicity.P):
            if at[-1] - at[0] < toxicity.SPAN:
                u = "".join(w[i] for i in at)
                out[u] = out.get(u, 0.0) + toxicity.DECAY ** (at[-1] - at[0] + 1)
        return out

    a, b = features(s), features(t)
    return sum(v * b.get(u, 0.0) for u, v in a.items())


def test_folded_weights_are_the_kernel_expansion():
    words = ["grobnak", "river", "garden", "grobnik", "x", "ab", "aaaa"]
    toxic, clean = np.array([0.9, 0.1, 0.1, 0.8, 0.1, 0.1, 0.2]), np.array([0.0, 0.1, 0.2, 0.0, 0.1, 0.1, 0.2])
    m = toxicity.fit_machine(words, toxic, clean)
    factor = {w: float(toxicity.length_factor(np.array([len(w)]))[0]) for w in words}

    def values(texts):
        return np.array([m.word_values(x[2], x[4])[0] - m.bias for w in texts for x in toxicity.word_streams([w])])

    # any function of the form sum(alpha k(., landmark)) is found again from its values at the landmarks
    gram = np.array([[subsequence_kernel(a, b) / factor[a] / factor[b] for b in words] for a in words])
    alpha = np.linalg.lstsq(gram, values(words), rcond=None)[0]
    other = ["grobnnak", "garden", "grxobnak"]
    want = [sum(a * subsequence_kernel(o, w) / factor[w] for a, w in zip(alpha, words)) / toxicity.length_factor(np.array([len(o)]))[0] for o in other]
    assert np.allclose(values(other), want, atol=1e-6)


def test_words_of_a_text():
    found = []
    for _, _, _, chars, starts, first in toxicity.word_streams(["I.d-i0ot  x y\tÄb", "", "z", "q r"]):
        flat = chars.tobytes().decode("utf-32-le")
        ends = [*starts[1:], len(flat)]
        found = [[flat[s:e] for s, e in zip(starts[a:b], ends[a:b])] for a, b in zip(first, first[1:])]
    assert found == [["idiot", "xy", "äb"], [], ["z"], ["qr"]]


def toxic_corpus(rng, n):
    rows = []
    for i in range(n):
        w = [rng.choice(CLEAN) + rng.choice(["", "", "s", "ing"]) for _ in range(rng.randint(5, 60))]
        bad = i % 4 == 0
        for _ in range(2 if bad else 0):
            w.insert(rng.randrange(len(w)), rng.choice(INSULTS) + rng.choice(["", "s", "ed"]))
        rows.append((i, " ".join(w), int(bad)))
    return rows


def test_toxicity_on_held_out_texts_and_gaps(spark):
    rows = toxic_corpus(random.Random(1), 600)
    docs = spark.createDataFrame([(i, t, 5) for i, t, _ in rows] + [(9000, None, 5), (9001, "", 5)], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(3, None), (None, 1), (3, rows[3][2]), (77777, 1)], "doc_id long, toxic int")
    machine = toxicity.train(docs, labels, F.col("doc_id") % 3 != 0)
    got = {r.doc_id: r for r in toxicity.score_documents(docs, machine).collect()}
    held = [(i, y) for i, _, y in rows if i % 3 == 0]
    assert len(got) == 602 and sum(got[i].predicted == y for i, y in held) >= 0.98 * len(held)
    assert got[9000].score == got[9001].score and got[9000].predicted == 0
    hidden = machine.scores(["the river g.r.o.b.n.a.k garden v i l e t h u d", "the river grobxnak garden vilethhud of"])
    assert (hidden >= toxicity.THRESHOLD).all()
    kept = toxicity.keep_clean(docs, machine)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if not r.predicted}
    assert toxicity.score_documents(docs.limit(0), machine).count() == 0
    assert machine.scores(["river " * 200000])[0] < toxicity.THRESHOLD


def test_toxicity_learns_insults_rarer_than_most_words(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "STRINGS", 60)
    rng = random.Random(17)
    pool = [a[:3] + b[:3] for a in CLEAN for b in CLEAN]
    rows = [(i, " ".join([rng.choice(pool) for _ in range(30)] + [rng.choice(INSULTS)] * (i % 20 == 0)), int(i % 20 == 0)) for i in range(600)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    machine = toxicity.train(docs, spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int"))
    bad = machine.scores([" ".join([rng.choice(pool) for _ in range(30)] + [w]) for w in INSULTS for _ in range(20)])
    good = machine.scores([" ".join(rng.choice(pool) for _ in range(30)) for _ in range(60)])
    assert (bad >= toxicity.THRESHOLD).mean() > 0.9 and (good < toxicity.THRESHOLD).mean() > 0.9


def test_toxicity_without_both_labels(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0)], "doc_id long, toxic int")
    assert toxicity.train(docs, labels).scores(["a"])[0] < 0.05
    assert toxicity.train(docs, labels.limit(0)).scores(["a", None])[1] == 0.5


def brute_kneser_ney(counts, order, text, vocabulary_size):
    """Interpolated Kneser-Ney probability of each character of ``text`` after the first, from its definition."""
    levels = [dict(counts)]
    for _ in range(order - 1):
        lower = {}
        for g in levels[0]:
            lower[g[1:]] = lower.get(g[1:], 0) + 1
        levels.insert(0, lower)
    discounts = []
    for lv in levels:
        ones, twos = sum(n == 1 for n in lv.values()), sum(n == 2 for n in lv.values())
        discounts.append(max(0.1, ones / (ones + 2 * twos) if ones else 0.5))

    def p(gram):
        k = len(gram) - 1
        lower = p(gram[1:]) if k else 1.0 / (len(levels[0]) + 1)
        own = {g: n for g, n in levels[k].items() if g[:-1] == gram[:-1]}
        if not own:
            return lower
        total = sum(own.values())
        return max(own.get(gram, 0) - discounts[k], 0) / total + discounts[k] * len(own) / total * lower

    return [p(text[max(0, i - order + 1) : i + 1]) for i in range(1, len(text))]


def test_kneser_ney_matches_its_definition():
    training = " abracadabra cabbage bad card drab " * 2
    counts = {}
    for i in range(len(training) - 3):
        counts[training[i : i + 4]] = counts.get(training[i : i + 4], 0) + 1
    model = langid.fit_kneser_ney({"x": counts, "y": {k: v + 1 for k, v in list(counts.items())[:9]}})
    for text in ("abracadabra", "drab cab", "gab", "dddd"):
        got = model.cross_entropies([text])[0][0, 0]
        assert got == pytest.approx(-np.log(brute_kneser_ney(counts, 4, f" {text} ", 0)).mean(), rel=1e-4)


def test_language_id(spark):
    rng = random.Random(4)
    pool = {"aa": "kala mino taro vesi puu lumi".split(), "bb": "schrift kraft zwerg pflug strumpf".split(), "cc": "ñandú côte çava éxito".split()}
    rows = [(i, " ".join(rng.choice(pool[lang]) for _ in range(rng.randint(1, 40))), lang) for i in range(300) for lang in [rng.choice(list(pool))]]
    rows += [(900, None, "aa"), (901, "", None), (902, "12 + 3", "bb"), (903, "KALA mino", None), (904, "kala " * 100000, "aa"), rows[0]]
    docs = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, lang string, score double")
    model = langid.train(docs.filter("doc_id % 5 <> 0"))
    got = langid.identify(docs, model).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert all(by[i].lang_pred == lang for i, _, lang in rows[:300]) and all(0 <= r.score <= 1 for r in got)
    assert [by[i].lang_pred for i in (900, 901, 902, 903, 904)] == ["und", "und", "und", "aa", "aa"]
    strange = langid.identify(spark.createDataFrame([(1, "qqx wjq xxq " * 5), (2, "漢字")], "doc_id long, text string"), model).collect()
    assert all(r.rejected for r in strange)
    assert langid.identify(docs.limit(0), model).count() == 0
    nothing = langid.train(docs.limit(0))
    assert {(r.lang_pred, r.score, r.rejected) for r in langid.identify(docs, nothing).collect()} == {("und", 0.0, True)}


def brute_language(counts, texts):
    """Languages by the definition of the model: lowest cross-entropy, ties to the first."""
    alphabets = {lang: len({g[-1] for g in c}) for lang, c in counts.items()}
    assert len(set(alphabets.values())) == 1  # so that no text meets a character that one language lacks
    out = []
    for t in texts:
        x = [(-np.log(brute_kneser_ney(counts[lang], 4, f" {t} ", 0)).mean(), lang) for lang in sorted(counts)]
        out.append(min(x)[1])
    return out


def test_language_query_matches_its_definition(spark):
    """Whole sample, model and decision against plain Python; ids repeat, or are null, throughout."""
    rng = random.Random(21)
    pool = {"aa": "abba cadda beeda dace".split(), "bb": "deca bedd ccab eabe".split()}
    rows = [(7 if lang == "aa" else None, " ".join(rng.choice(pool[lang]) for _ in range(rng.randint(3, 9))), lang) for _ in range(60) for lang in pool]
    rows += rows[:20]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    sample = langid.training_texts(docs).collect()
    assert sorted((r.lang, r.text) for r in sample) == sorted({(lang, t) for _, t, lang in rows})
    counts = {}
    for r in sample:
        if r.r % langid.KEPT_BACK:
            own, t = counts.setdefault(r.lang, {}), f" {r.text} "
            for i in range(len(t) - 3):
                own[t[i : i + 4]] = own.get(t[i : i + 4], 0) + 1
    got = langid.identify(docs, langid.train(docs)).collect()
    predicted = {t: lang for t, lang in zip((r[1] for r in rows), brute_language(counts, [r[1] for r in rows]))}
    # the order of rows is kept by a narrow map
    assert [r.lang_pred for r in got] == [predicted[t] for _, t, _ in rows]


def test_one_id_for_a_whole_language(spark, monkeypatch):
    monkeypatch.setattr(langid, "TRAIN_TEXTS", 50)
    docs = spark.range(3000).select(F.lit(1).cast("long").alias("doc_id"), F.concat(F.lit("mot "), F.col("id").cast("string")).alias("text"), F.when(F.col("id") % 3 == 0, "xx").otherwise("yy").alias("lang"))
    n = langid.training_texts(docs).groupBy("lang").count().collect()
    assert {r["lang"]: r["count"] for r in n} == {"xx": 50, "yy": 50}
    copies = spark.range(3000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("le même mot").alias("text"), F.lit("fr").alias("lang"))
    assert langid.training_texts(copies).count() == 1


def test_toxicity_sample_of_a_repeated_id(spark):
    docs = spark.range(2000).select(F.lit(1).cast("long").alias("doc_id"), F.format_string("text %04d", "id").alias("text"))
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, 0)], "doc_id long, toxic int")
    assert [(r.text, r.toxic) for r in toxicity.training_texts(docs, labels, F.lit(True)).collect()] == [("text 0000", 1)]


def test_attribution_rules():
    ends = np.array([2, 5, 6, 9])  # tokens [0,2) [2,5) [5,6) [6,9)
    edges = np.array([0, 3, 7, 9])
    assert tokens.attribute(ends, edges, "start").tolist() == [2, 2, 0]
    assert tokens.attribute(ends, edges, "majority").tolist() == [1, 2, 1]
    assert np.allclose(tokens.attribute(ends, edges, "split"), [1 + 1 / 3, 2 / 3 + 1 + 1 / 3, 2 / 3])
    assert tokens.partition([("b", 4, 8), ("a", 1, 5), ("z", 3, 3)], 10) == (["outside", "a", "b", "outside"], pytest.approx([0, 1, 5, 8, 10]))


@pytest.mark.parametrize("rule", tokens.RULES)
def test_token_counts_match_brute_force(spark, rule):
    texts = ["Title: été\nThe first line.\n\nlast é\U0001f600line", "one line", "", None, "a\n", "\n\n\n", "word " * 30000 + "\n" + "x" * 5000]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)] + [(0, texts[0], 1)], "doc_id long, text string, spans int")
    got = {}
    for r in tokens.count_tokens(docs, tokens.line_sections(F.col("text")), rule).collect():
        got.setdefault((r.doc_id, r.section), []).append((r.n_chars, r.n_tokens, r.doc_tokens))
    ranks = {base64.b64decode(a): int(n) for a, n in map(bytes.split, open(tokens.RANKS, "rb"))}
    enc = tiktoken.Encoding("t", pat_str=tokens.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for i, t in enumerate(texts):
        t = t or ""
        lines = t.split("\n")
        head = lines[0] + ("\n" if len(lines) > 1 else "")
        want = {"lead": head} if len(lines) == 1 else {"lead": head, "tail": lines[-1]}
        if len(lines) > 2:
            want["body"] = t[len(head) : len(t) - len(lines[-1])]
        edge, spans = 0, []
        for name in ("lead", "body", "tail"):
            if name in want:
                spans.append((name, edge, edge + len(want[name].encode())))
                edge = spans[-1][2]
        counts, at = dict.fromkeys(want, 0.0), 0
        encoded = enc.encode_ordinary(t)
        for token in encoded:
            end = at + len(enc.decode_single_token_bytes(token))
            held = [(min(end, e) - max(at, s), name) for name, s, e in spans if min(end, e) > max(at, s)]
            if rule == "split":
                for n, name in held:
                    counts[name] += n / (end - at)
            else:
                counts[held[0][1] if rule == "start" else max(held, key=lambda h: h[0])[1]] += 1
            at = end
        for name, part in want.items():
            for chars, n, total in got[(i, name)]:
                assert (chars, total) == (len(part), len(encoded)) and n == pytest.approx(counts[name])
        assert {name for j, name in got if j == i} == set(want)
    assert len(got[(0, "lead")]) == 2
    assert tokens.count_tokens(docs.limit(0), tokens.line_sections(F.col("text"))).count() == 0


def test_pipeline_stages_match_brute_force(spark, tmp_path):
    import corpus_pipeline as cp

    rng = random.Random(12)
    rows = [(i, t, "en", f"s{i % 4}", len(t)) for i, t, _ in toxic_corpus(rng, 200)]
    item = " ".join(rng.choice(CLEAN) + str(k) for k in range(15))
    base = " ".join(rng.choice(CLEAN) + rng.choice("abcdefgh") for _ in range(80))
    rows += [(500 + k, base.replace(base.split()[k], "changed", 1), "en", "s0", 1) for k in range(4)] + [(600, f"before {item} after", "en", "s1", 1)]
    rows += [(700, None, None, None, None), (701, "", "en", "s2", 0), (None, "garden " * 7 + "only here", "en", "s1", 3), rows[5], rows[5]]
    labels = [(i, y) for i, _, y in toxic_corpus(random.Random(12), 200)]
    d = str(tmp_path)
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    docs = spark.read.parquet(f"{d}/documents.parquet")
    seen = [docs.collect()]
    for k, (name, stage) in enumerate(cp.STAGES):
        stage(spark, docs, d).write.parquet(f"{d}/{k}")
        docs = spark.read.parquet(f"{d}/{k}")
        if name != "sharding":
            assert docs.columns == schema.replace(" long", "").replace(" string", "").split(", ")
        seen.append(docs.collect())
    raw, clean, single, safe, mixed, placed = seen
    toxic = {i for i, y in labels if y}
    wrong = {r.doc_id for r in raw} - {r.doc_id for r in clean} ^ toxic
    assert len(wrong) <= 4 and {500, 501, 502, 503, 600, 700, 701, None} <= {r.doc_id for r in clean}
    by = {r.doc_id: r for r in clean if r.doc_id is not None}
    sets = {i: shingles(r.text, 5) for i, r in by.items()}
    links = [(a, b) for a, b in itertools.combinations(sets, 2) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    root = reach(list(sets), links)
    assert sorted((r.doc_id for r in single), key=str) == sorted([i for i in by if root[i] == i] + [None], key=str)
    words = GAP.findall(item.translate(LOWER))
    windows = {tuple(words[i : i + 10]) for i in range(6)}
    dirty = {r.doc_id for r in single if any(tuple(w[i : i + 10]) in windows for w in [GAP.findall((r.text or "").translate(LOWER))] for i in range(len(w)))}
    assert dirty == {600} and sorted((r.doc_id for r in safe), key=str) == sorted((r.doc_id for r in single if r.doc_id not in dirty), key=str)
    times = {r.doc_id: sum(x.doc_id == r.doc_id for x in mixed) for r in safe}
    assert max(times.values()) <= 3 and times[700] == times[701] == 1
    size = {r.doc_id: len((r.text or "").split()) for r in safe}
    assert abs(sum(size[i] * n for i, n in times.items()) - sum(size.values())) < 4 * 60
    assert sorted(str(r.doc_id) for r in placed) == sorted(str(r.doc_id) for r in mixed)
    for s in range(cp.SHARDS):
        slots = sorted(r.slot for r in placed if r.shard == s)
        assert slots == list(range(len(slots)))


def test_pipeline_rows_that_share_an_id_or_have_none(spark, tmp_path):
    import corpus_pipeline as cp

    rng = random.Random(31)
    text = lambda n: " ".join(rng.choice(CLEAN) + rng.choice("abcdefgh") for _ in range(n))
    a, b, item = text(60), text(60), text(12)
    schema = "doc_id long, text string, lang string, source string, n_chars long"

    def through(stage, rows):
        docs = spark.createDataFrame(rows, schema)
        return sorted(map(tuple, stage(spark, docs, str(tmp_path)).collect()), key=str)

    row = lambda i, t, source="s": (i, t, "en", source, 1)
    # (5, a) goes for (3, a x); its namesakes, of another text, none or no words, stay; of equal rows one stays
    stay = [row(3, a + " x"), row(5, b), row(5, None), row(5, ""), row(None, a), row(None, a)]
    got = through(cp.drop_near_duplicates, [*stay, row(5, a), row(3, a + " y"), row(6, b + " x"), row(5, b)])
    assert got == sorted(stay, key=str)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    stay = [row(None, a), row(None, None), row(4, b)]
    assert through(cp.drop_contaminated, [*stay, row(None, f"{b} {item}"), row(4, item)]) == sorted(stay, key=str)
    # a is of a source that comes three times; the row without words beside it once, equal rows each
    rows = [row(None, a, "t"), row(None, a, "t"), row(None, "", "t"), row(None, "", "t"), (None, "", None, "t", 1), (None, "", "en", "t", None)]
    got = through(cp.mix_sources, rows + [row(8, text(4000), "s")])
    assert [sum(r == w for r in got) for w in rows] == [6, 6, 2, 2, 1, 1]


def test_bounded_sample(spark):
    from tastebud.llm.rows import bounded_sample

    rows = spark.range(5000).select("id", F.when(F.col("id") % 10 == 0, "few").otherwise("many").alias("g"))
    got = bounded_sample(rows, "g", "id", 400)
    assert {r.g: r["count"] for r in got.groupBy("g").count().collect()} == {"few": 400, "many": 400}
    assert {r.n for r in got.select("n").distinct().collect()} == {500, 4500}
    assert sorted(r.r for r in got.filter("g = 'few'").collect()) == list(range(1, 401))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, bounded_sample(rows, "g", "id", 400).collect()))
    assert bounded_sample(rows.limit(30), "g", "id", 400).count() == 30


def test_pipeline_keeps_columns_of_any_name(spark, tmp_path):
    import corpus_pipeline as cp

    rng = random.Random(37)
    text = lambda n: " ".join(rng.choice(CLEAN) + rng.choice("abcdefgh") for _ in range(n))
    names = ["key", "group", "each", "over", "_copy", "_mark", "best", "row", "_key", "n", "times"]
    base = [(i, text(60), "en", f"s{i % 2}", 1) for i in range(8)]
    base += [(20, base[0][1] + " x", "en", "s0", 1), (21, None, "en", "s1", 1), (22, text(3000), "en", "s1", 1), base[3]]
    plain = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([(1, base[1][1])], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    more = [(*r, *[f"{c}{r[0]}" for c in names]) for r in base]
    wide = spark.createDataFrame(more, plain + "".join(f", {c} string" for c in names))
    own = {r[0]: r[5:] for r in more}
    for stage in (cp.drop_near_duplicates, cp.drop_contaminated, cp.mix_sources):
        want = sorted((tuple(r) for r in stage(spark, spark.createDataFrame(base, plain), str(tmp_path)).collect()), key=str)
        out = stage(spark, wide, str(tmp_path))
        assert out.columns == wide.columns
        got = [tuple(r) for r in out.collect()]
        assert sorted((r[:5] for r in got), key=str) == want and all(r[5:] == own[r[0]] for r in got)
    placed = cp.shard(spark, wide, str(tmp_path)).collect()
    assert len(placed) == len(base)
