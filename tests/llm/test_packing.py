"""Packing: pieces against a round-robin run step by step, ids against the tokenizer, the mixture of every window."""

import random
import struct
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tastebud.llm import packing

WORDS = public_tokenizers.path("word_bpe_49k.json")


def stream_of(service):
    """Queue numbers of the stream's tokens, by serving the queues one after the other."""
    deficit, left, out = [0] * len(service.tokens), [int(n) for n in service.tokens], []
    while any(left):
        for s, q in enumerate(service.quanta.tolist()):
            deficit[s] += q
            give = min(left[s], deficit[s] >> service.bits)
            deficit[s] -= give << service.bits
            left[s] -= give
            out += [s] * give
    return out


def test_pieces_are_those_of_the_round_robin():
    rng = random.Random(11)
    for trial in range(60):
        k, window = rng.randint(1, 6), rng.choice([1, 3, 8, 16, 40])
        tokens = [rng.choice([0, 1, rng.randint(1, 30), rng.randint(50, 300)]) for _ in range(k)]
        if not sum(tokens):
            continue
        weights = [max(n, 1) for n in tokens] if trial % 2 else [rng.choice([0.02, 1.0, 5.0]) for _ in tokens]
        service = packing.Service.of(tokens, weights, window)
        stream, got = stream_of(service), {}
        for s, total in enumerate(tokens):
            before = 0
            while before < total:
                m = min(total - before, rng.choice([1, 2, 30]))  # of two documents, one after the other
                cut = rng.randint(1, m)
                sizes = np.array([cut, m - cut] if m > cut else [m])
                doc, start, length, place = service.pieces(s, before + np.cumsum(sizes) - sizes, sizes, window)
                n, start = m, start + (np.cumsum(sizes) - sizes)[doc]
                assert start[0] == 0 and (start[1:] == (start + length)[:-1]).all() and (start + length)[-1] == n
                assert (place // window == (place + length - 1) // window).all()  # no piece crosses a window
                for a, m, x in zip(start, length, place):
                    for i in range(m):
                        assert x + i not in got
                        got[x + i] = (s, before + a + i)
                before += n
        assert [got[i][0] for i in range(sum(tokens))] == stream
        for s in range(k):  # first in, first out
            mine = [got[i][1] for i in range(len(stream)) if got[i][0] == s]
            assert mine == list(range(tokens[s]))


def test_rounds_are_exact_where_products_pass_64_bits():
    service = packing.Service.of([10**12, 3, 7 * 10**9], [10.0**12, 3.0, 7.0 * 10**9], 2048)
    for s in range(3):
        for token in (0, 1, 2, service.tokens[s] - 1):
            r = int(service.round_of(s, np.array([token]))[0])
            q = int(service.quanta[s])
            assert (r * q) >> service.bits > token >= ((r - 1) * q) >> service.bits


def test_every_window_holds_the_mixture():
    tokens = [5_000, 300, 40_000, 17, 0]
    service = packing.Service.of(tokens, [max(n, 1) for n in tokens], 512)
    held = defaultdict(int)
    for s, n in enumerate(tokens):
        if n:
            for _, a, m, x in zip(*service.pieces(s, np.array([0]), np.array([n]), 512)):
                held[x // 512, s] += m
    total, windows = sum(tokens), -(-sum(tokens) // 512)
    for w in range(windows - 1):
        assert sum(held[w, s] for s in range(5)) == 512
        assert all(abs(held[w, s] - 512 * n / total) <= len(tokens) + 1 for s, n in enumerate(tokens))


def test_weights_hold_until_a_queue_is_empty():
    service = packing.Service.of([1_000, 8_000, 8_000], [2.0, 1.0, 1.0], 200)
    held = defaultdict(int)
    for s, n in enumerate(service.tokens.tolist()):
        for _, a, m, x in zip(*service.pieces(s, np.array([0]), np.array([n]), 200)):
            held[x // 200, s] += m
    assert all(abs(held[w, 0] - 100) <= 4 for w in range(9))  # 100 a window until 1,000 are gone
    assert all(abs(held[w, 1] - 100) <= 4 and held[w, 0] == 0 for w in range(12, 80))  # the others share its room


def read_back(pieces, docs, length, end_id=1):
    tokenizer = Tokenizer.from_file(WORDS)
    by, line = defaultdict(list), defaultdict(list)
    for p in pieces:
        by[p.doc_id].append(p)
        line[p.sequence_id].append(p)
    want = defaultdict(list)
    for d, text, *_ in docs:
        want[d].append(tokenizer.encode(text or "", add_special_tokens=False).ids + [end_id])
    assert set(by) == set(want)
    for d, texts in want.items():
        # of a repeated id the pieces' tokens are those of all its rows
        got = sorted(x for p in by[d] for x in struct.unpack(f"<{p.length}I", p.ids))
        assert got == sorted(x for t in texts for x in t)
        if len(texts) == 1:
            mine, at = sorted(by[d], key=lambda p: p.start), 0
            for p in mine:
                assert p.start == at and p.doc_tokens == len(texts[0])
                assert list(struct.unpack(f"<{p.length}I", p.ids)) == texts[0][at : at + p.length]
                at += p.length
            assert at == len(texts[0])
    for s, ps in line.items():
        at = 0
        for p in sorted(ps, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == length or s == max(line)
    assert sorted(line) == list(range(len(line)))


def some_docs(rng, n):
    words = ["the", "don't", "Straße", "ΣΑΣ", "naïve", "x2", "日本", "a<|endoftext|>b", "q" * 90, "́z", "1,000.5", "é"]
    docs = [(i, rng.choice([" ", "\n", " \t"]).join(rng.choice(words) for _ in range(rng.randint(0, 60))), rng.choice(["a", "a", "b", "c", None]), 3, "s") for i in range(n)]
    return [*docs, (n, None, "b", 3, "s"), (n + 1, "", None, 3, "s"), (n + 2, "deep well " * 9_000, "c", 3, "s"), (None, "no id", "a", 3, "s"), (None, None, "a", 3, "s"), docs[0], docs[0]]


SCHEMA = "doc_id long, text string, source string, queue int, ids string"


@pytest.mark.parametrize("weights", [None, {"a": 5.0, None: 0.5}])
def test_all_ids_lie_in_exactly_one_piece(spark, weights):
    docs = some_docs(random.Random(3), 120)
    frame = spark.createDataFrame(docs, SCHEMA).repartition(5)
    found = packing.pack(frame, WORDS, weights, length=64)
    read_back(found.collect(), docs, 64)
    whole = packing.sequences(found).collect()
    assert all(len(r.ids) == 4 * r.n_tokens for r in whole) and sum(r.n_tokens != 64 for r in whole) <= 1


def test_more_sources_than_queues_share_them(spark, monkeypatch):
    monkeypatch.setattr(packing, "MAX_QUEUES", 3)
    docs = [(i, "one two three " * (i % 7), f"s{i % 11}") for i in range(60)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string")
    for weights in (None, {"s1": 4.0}):
        found = packing.pack(frame, WORDS, weights, length=32).collect()
        assert {p.source_queue for p in found} <= {0, 1, 2}
        read_back(found, docs, 32)


def test_offsets_by_a_shuffle_give_the_same(spark, monkeypatch):
    docs = some_docs(random.Random(9), 40)
    frame = spark.createDataFrame(docs, SCHEMA).coalesce(1).sortWithinPartitions("doc_id", "text")
    one = sorted(map(tuple, packing.pack(frame, WORDS, length=32).collect()), key=str)
    monkeypatch.setattr(packing, "BROADCAST_OFFSETS", 0)
    assert sorted(map(tuple, packing.pack(frame, WORDS, length=32).collect()), key=str) == one


def test_empty_table_and_bad_arguments(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, source string")
    assert packing.pack(empty, WORDS).collect() == []
    one = spark.createDataFrame([(1, "a b", "s")], empty.schema)
    with pytest.raises(ValueError):
        packing.pack(one, WORDS, length=0)
    with pytest.raises(ValueError):
        packing.pack(one, WORDS, {"s": -1.0})


def test_remembered_words_give_the_tokenizers_ids(monkeypatch):
    tokenizer = Tokenizer.from_file(WORDS)
    rng = random.Random(21)
    letters = ["a", "B", "é", "É", "İ", "Σ", "ß", "Ǆ", "K", "ﬁ", "日", "ل", "́", "̈", "1", "２", "Ⅷ", "'s", "'", "’", ".", "…", "!", "-", "_", "#", "​", "\xa0", " ", "\x1c", "\x85", "😀", "<|startoftext|>"]
    texts = ["".join(rng.choice(letters[: rng.randint(2, len(letters))]) + rng.choice(["", "", " ", "\n"]) for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    texts += ["", " ", "x" * 500 + ". y", "Don't. won't! ça, va?"]
    texts = [t for t in texts for _ in range(2)]
    texts[100:150] = [t.replace("<|startoftext|>", "") for t in texts[100:150]]
    with open(WORDS, encoding="utf-8") as f:
        encode = packing.word_encoder(f.read())
    monkeypatch.setattr(packing, "REMEMBERED", 300)  # so that it forgets now and then
    for i in range(0, len(texts), 50):
        part = texts[i : i + 50]
        want = [tokenizer.encode(t, add_special_tokens=False).ids for t in part]
        ids, counts = encode(pa.array(part))
        assert counts.tolist() == [len(x) for x in want]
        assert ids.tolist() == [x for w in want for x in w]
