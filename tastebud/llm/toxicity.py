"""Toxicity: support vector machine on a gap-weighted subsequence kernel, with Nystroem landmarks.

Strings are the words of a text: lower-cased letters between white space, with
anything else inside them left out, and single letters in a row put together,
so that ``i.d.i.o.t`` and ``i d i o t`` are words too.  The kernel of two words
sums over all subsequences of ``P`` letters that span at most ``SPAN``; each
occurrence weighs ``DECAY`` to the power of its span, so letters put in between
or left out cost something but do not hide a word.  Kernels are divided by a
factor of each word's length.

Labels belong to texts, so every word of a marked text counts for the toxic
side as far as it is more frequent there.  Landmark words give Nystroem
features, on which a linear machine with squared hinge loss is trained; as the
kernel is a sum over subsequences, the trained function folds into one weight
per subsequence.  A text's score is a logistic function of its two highest
word values and its number of words, fitted on texts that the machine has not
learned from.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastebud.llm.rows import bounded_sample
from tastebud.llm.words import chunks, code_points

P, SPAN, DECAY = 3, 5, 0.6
SYMBOLS = 64
#: Training texts of each label at most, strings and landmarks of the machine: the fit's documented bounds.
TRAIN_TEXTS = 5_000
STRINGS = 30_000
LANDMARKS = 160
THRESHOLD = 0.3
_GAPS = [(a, b) for b in range(2, SPAN) for a in range(1, b)]
_KIND: list = []


def _kinds() -> np.ndarray:
    """Symbol of each code point below 65536: 0 neither letter nor space, 255 white space."""
    if not _KIND:
        kind = np.zeros(0x10000, dtype=np.uint8)
        for c in range(0x10000):
            if chr(c).isalpha():
                kind[c] = 1 + c - 97 if 97 <= c < 123 else 27 + c % (SYMBOLS - 27)
            elif chr(c).isspace():
                kind[c] = 255
        _KIND.append(kind)
    return _KIND[0]


def word_streams(texts: list[str]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per chunk: its range, symbols of its letters, their code points, word starts, and each text's first word."""
    kinds = _kinds()
    for a, b in chunks([len(t) for t in texts], 2_000_000):
        parts = [t.lower() + " " for t in texts[a:b]]
        c = code_points(parts)
        kind = kinds[np.minimum(c, 0xFFFF)]
        ends = np.cumsum([len(p) for p in parts])
        letter = (kind > 0) & (kind < 255)
        word = np.cumsum(kind == 255)[letter]  # white space so far: the same inside a word
        text = np.searchsorted(ends, np.flatnonzero(letter), side="right")
        if not len(word):
            yield a, b, np.zeros(0, np.int64), np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(b - a + 1, np.int64)
            continue
        new = np.flatnonzero(np.diff(word, prepend=-1) != 0)
        size = np.diff(np.append(new, len(word)))
        single = size == 1
        join = np.zeros(len(new), dtype=bool)
        join[1:] = single[1:] & single[:-1] & (text[new[1:]] == text[new[:-1]])
        new = new[~join]
        yield a, b, kind[letter].astype(np.int64), c[letter], new, np.searchsorted(text[new], np.arange(b - a + 1))


def length_factor(n: np.ndarray) -> np.ndarray:
    """What kernels of a word of n letters are divided by."""
    total = np.zeros(len(n))
    for _, b in _GAPS:
        total += np.maximum(n - b, 0) * DECAY ** (2 * (b + 1))
    return np.sqrt(np.maximum(total, DECAY ** (2 * P)))


def subsequences(symbols: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """For each way to choose letters: places that have it inside their word, the subsequence's code, its weight."""
    n = len(symbols)
    room = np.repeat(np.append(starts[1:], n), np.diff(np.append(starts, n))) - np.arange(n) if n else np.zeros(0, np.int64)
    for a, b in _GAPS:
        at = np.flatnonzero(room > b)
        yield at, (symbols[at] * SYMBOLS + symbols[at + a]) * SYMBOLS + symbols[at + b], DECAY ** (b + 1)


@dataclass
class Machine:
    weights: np.ndarray  # by subsequence code
    bias: float
    logistic: np.ndarray  # constant, highest word, second highest, log number of words

    def word_values(self, symbols: np.ndarray, starts: np.ndarray) -> np.ndarray:
        if not len(starts):
            return np.zeros(0)
        at_place = np.zeros(len(symbols))
        for at, code, weight in subsequences(symbols, starts):
            at_place[at] += weight * self.weights[code]
        size = np.diff(np.append(starts, len(symbols)))
        return np.add.reduceat(at_place, starts) / length_factor(size) + self.bias

    def features(self, texts: list[str | None]) -> np.ndarray:
        """Per text: 1, highest and second highest word value, log of 1 + words.  Without words the values are the bias."""
        out = np.zeros((len(texts), 4))
        out[:, 0], out[:, 1], out[:, 2] = 1.0, self.bias, self.bias
        for a, b, symbols, _, starts, first in word_streams([t or "" for t in texts]):
            v = self.word_values(symbols, starts)
            for i in range(b - a):
                mine = v[first[i] : first[i + 1]]
                if len(mine) > 1:
                    out[a + i, 2], out[a + i, 1] = np.partition(mine, len(mine) - 2)[-2:]
                elif len(mine):
                    out[a + i, 1] = mine[0]
                out[a + i, 3] = np.log1p(len(mine))
        return out

    def scores(self, texts: list[str | None]) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.features(texts) @ self.logistic, -30, 30)))


def newton(z: np.ndarray, plus: np.ndarray, minus: np.ndarray, ridge: float) -> np.ndarray:
    """Weights v and bias of the linear machine: squared hinge with the examples' weights for either label."""
    x = np.hstack([z, np.ones((len(z), 1))])
    v = np.zeros(x.shape[1])
    penalty = np.append(np.full(z.shape[1], ridge), 1e-6)

    def loss(v: np.ndarray) -> float:
        f = x @ v
        return float(0.5 * (penalty * v * v).sum() + (plus * np.maximum(0, 1 - f) ** 2).sum() + (minus * np.maximum(0, 1 + f) ** 2).sum())

    now = loss(v)
    for _ in range(30):
        f = x @ v
        p, m = plus * (f < 1), minus * (f > -1)
        gradient = penalty * v + 2 * x.T @ (p * (f - 1) + m * (f + 1))
        hessian = 2 * x.T @ (x * (p + m)[:, None]) + np.diag(penalty)
        step, size = np.linalg.solve(hessian, gradient), 1.0
        while size > 1e-4 and loss(v - size * step) > now:
            size /= 2
        v = v - size * step
        before, now = now, loss(v)
        if before - now < 1e-9 * max(1.0, before):
            break
    return v


def logistic_fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    v = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ v, -30, 30)))
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(x.shape[1])
        step = np.linalg.solve(h, x.T @ (weight * (p - y)) + 0.05 * v)
        v -= step
        if np.abs(step).max() < 1e-7:
            break
    return v


def fit_machine(words: list[str], toxic: np.ndarray, clean: np.ndarray, ridge: float = 1e-3) -> Machine:
    """Machine from words and the shares of toxic and of clean texts that hold them."""
    gain = toxic - clean
    half = LANDMARKS // 2
    marks = list(dict.fromkeys([*np.argsort(-gain, kind="stable")[:half], *np.argsort(-clean, kind="stable")[:half]]))
    pieces, offset = [], 0
    for _, _, letters, _, own, _ in word_streams(words):  # each word a text of its own
        pieces.append((letters, own + offset))
        offset += len(letters)
    symbols, starts = np.concatenate([x for x, _ in pieces]), np.concatenate([y for _, y in pieces])
    if len(starts) != len(words):
        raise ValueError("each string must be one word")
    size = np.diff(np.append(starts, len(symbols)))
    factor = length_factor(size)
    owner = np.repeat(np.arange(len(words)), size)
    rows, codes, values = [], [], []
    for at, code, weight in subsequences(symbols, starts):
        rows.append(owner[at])
        codes.append(code)
        values.append(weight / factor[owner[at]])
    rows, codes, values = np.concatenate(rows), np.concatenate(codes), np.concatenate(values)
    # landmarks as a dense matrix over the subsequences that they have
    place = np.full(len(words), -1)
    place[marks] = np.arange(len(marks))
    own = place[rows] >= 0
    used = np.unique(codes[own])
    dense = np.zeros((len(used), len(marks)))
    np.add.at(dense, (np.searchsorted(used, codes[own]), place[rows[own]]), values[own])
    at = np.minimum(np.searchsorted(used, codes), max(len(used) - 1, 0))
    hit = used[at] == codes if len(used) else np.zeros(len(codes), dtype=bool)
    rows, at, values = rows[hit], at[hit], values[hit]
    order = np.argsort(rows, kind="stable")
    rows, at, values = rows[order], at[order], values[order]
    kernel = np.zeros((len(words), len(marks)))
    for lo in range(0, len(rows), 100_000):
        np.add.at(kernel, rows[lo : lo + 100_000], values[lo : lo + 100_000, None] * dense[at[lo : lo + 100_000]])
    eigen, base = np.linalg.eigh(dense.T @ dense)
    good = eigen > 1e-6 * max(float(eigen.max()), 1e-12)
    root = base[:, good] / np.sqrt(eigen[good])
    v = newton(kernel @ root, toxic, clean, ridge)
    weights = np.zeros(SYMBOLS**P)
    weights[used] = dense @ (root @ v[:-1])
    return Machine(weights, float(v[-1]), np.zeros(4))


def word_shares(texts: DataFrame) -> DataFrame:
    """``(word, toxic, clean)``: how many of the texts (text, toxic) of either label hold each word."""

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts, label = b["text"].tolist(), b["toxic"].to_numpy()
            for a, _, _, chars, starts, first in word_streams([t or "" for t in texts]):
                flat = chars.tobytes().decode("utf-32-le", "surrogatepass")
                ends = np.append(starts[1:], len(flat))
                found, marks = [], []
                for i in range(len(first) - 1):
                    own = {flat[s:e] for s, e in zip(starts[first[i] : first[i + 1]], ends[first[i] : first[i + 1]])}
                    found += own
                    marks += [int(label[a + i])] * len(own)
                m = np.array(marks, dtype=np.int64)
                yield pd.DataFrame({"word": found, "toxic": m, "clean": 1 - m}).groupby("word", as_index=False).sum()

    rows = texts.select("text", "toxic").mapInPandas(split, "word string, toxic long, clean long")
    return rows.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def strings(shares: DataFrame, n_toxic: int, n_clean: int) -> pd.DataFrame:
    """The ``STRINGS`` words to learn from: half by how far toxic texts hold them more often than clean ones, the rest by number of texts."""
    gain, texts = F.col("toxic") / n_toxic - F.col("clean") / n_clean, F.col("toxic") + F.col("clean")
    typical = shares.orderBy(F.desc(gain), "word").limit(STRINGS // 2).toPandas()
    frequent = shares.orderBy(F.desc(texts), "word").limit(STRINGS).toPandas()
    frequent["at"] = np.arange(len(frequent))
    both = pd.concat([typical, frequent.drop(columns="at")]).drop_duplicates("word").head(STRINGS)
    at = both["word"].map(dict(zip(frequent["word"], frequent["at"]))).fillna(len(frequent))
    return both.iloc[np.argsort(at.to_numpy(), kind="stable")]


def training_texts(docs: DataFrame, labels: DataFrame, usable: Column) -> DataFrame:
    """``(text, toxic, r, share)``: the sample that is learned from, ``TRAIN_TEXTS`` of each label at most.

    Those of the smallest id hashes.  ``share`` is how many labelled texts each
    stands for.  A null label is none; of several labels of a text the largest holds.
    Of rows that share a doc_id the smallest text is learned from.
    """
    marked = labels.filter("toxic is not null and doc_id is not null").filter(usable).groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    few = bounded_sample(marked, "toxic", "doc_id", TRAIN_TEXTS).withColumn("share", F.col("n") / F.least(F.col("n"), F.lit(TRAIN_TEXTS)))
    # at most 2 * TRAIN_TEXTS rows; rows that share an id fold into one map-side
    met = docs.select("doc_id", "text").join(F.broadcast(few), "doc_id")
    return met.groupBy("doc_id", "toxic", "r", "share").agg(F.min("text").alias("text")).select("text", "toxic", "r", "share")


def train(docs: DataFrame, labels: DataFrame, usable: Column | None = None) -> Machine:
    """Learn from documents (doc_id, text) and labels (doc_id, toxic) for which ``usable`` holds.

    Every third text of the sample is kept from the machine and fits the
    logistic function.  Without texts of both labels, every score is that of
    the label there is (0.5 without any).
    """
    spark = docs.sparkSession
    sample = training_texts(docs, labels, F.lit(True) if usable is None else usable).persist()
    try:
        counted = {r["toxic"]: r["n"] for r in sample.filter("r % 3 <> 0").groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
        n_toxic, n_clean = counted.get(1, 0), counted.get(0, 0)
        if not n_toxic or not n_clean:
            only = 0.0 if n_toxic == n_clean else (4.0 if n_toxic else -4.0)
            return Machine(np.zeros(SYMBOLS**P), 0.0, np.array([only, 0.0, 0.0, 0.0]))
        shares = word_shares(sample.filter("r % 3 <> 0")).filter("toxic + clean > 1")
        best = strings(shares, n_toxic, n_clean)
        machine = fit_machine(best["word"].tolist(), best["toxic"].to_numpy() / n_toxic, best["clean"].to_numpy() / n_clean)
        state = spark.sparkContext.broadcast(vars(machine))

        def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            m = Machine(**state.value)
            for b in batches:
                yield pd.DataFrame({"toxic": b["toxic"], "share": b["share"], "x": list(m.features(b["text"].tolist()))})

        kept = sample.filter("r % 3 = 0").mapInPandas(measure, "toxic int, share double, x array<double>").toPandas()
        if len(kept):
            machine.logistic = logistic_fit(np.array(kept["x"].tolist()), kept["toxic"].to_numpy().astype(float), kept["share"].to_numpy())
    finally:
        sample.unpersist()
    return machine


def score_documents(docs: DataFrame, machine: Machine) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, score, predicted (score at least ``THRESHOLD``).

    Whole texts are scored.  A null or empty text has no word and scores as
    such; repeated rows score each; columns other than the two are not read.
    """
    state = docs.sparkSession.sparkContext.broadcast(vars(machine))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = Machine(**state.value)
        for b in batches:
            s = m.scores(b["text"].tolist())
            yield pd.DataFrame({"doc_id": b["doc_id"], "score": s, "predicted": (s >= THRESHOLD).astype(np.int32)})

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInPandas(score, f"doc_id {kind}, score double, predicted int")


#: Rows whose texts a task takes out of a batch at a time.
KEEP_ROWS = 500


def keep_clean(docs: DataFrame, machine: Machine) -> DataFrame:
    """The rows of ``docs``, all columns, that score below ``THRESHOLD``."""
    state = docs.sparkSession.sparkContext.broadcast(vars(machine))

    def keep(batches):
        m = Machine(**state.value)
        for whole in batches:
            for lo in range(0, whole.num_rows, KEEP_ROWS):
                b = whole.slice(lo, KEEP_ROWS)
                yield b.filter(m.scores(b.column("text").to_pylist()) < THRESHOLD)

    return docs.mapInArrow(keep, docs.schema)
