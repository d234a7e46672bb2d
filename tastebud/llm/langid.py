"""Language identification by interpolated Kneser-Ney character models.

Text is lower-cased, and each run of characters that are not letters becomes
one space.  Per language, n-grams of ``ORDER`` characters are counted over the
training texts (a Spark aggregate); lower orders follow from them as
continuation counts.  The model is, for each order, one sorted array of
n-gram hashes with a row of log probabilities, one column a language, each
already interpolated with all lower orders; and the same for the weight that a
context leaves to the next lower order.  Scoring looks hashes up by binary
search, from the highest order down, only for characters not yet settled.

The language of the lowest cross-entropy per character wins.  ``score`` is the
winner's share under a softmax whose sharpness is fitted on training texts
kept back from counting, and ``rejected`` marks texts whose cross-entropy is
far above what the winning language's kept-back texts have.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastebud.llm.rows import bounded_sample, row_key
from tastebud.llm.words import chunks, code_points, mixed

ORDER = 4
#: Training texts of each language at most: the fit's documented bound.
TRAIN_TEXTS = 2_000
#: One training text in so many is kept back for the calibration.
KEPT_BACK = 5
_DISCOUNT_FLOOR = 0.1
_LETTER: list = []


def _letters() -> np.ndarray:
    """Whether each code point below 65536 is a letter; those above count as letters."""
    if not _LETTER:
        _LETTER.append(np.array([chr(c).isalpha() for c in range(0x10000)]))
    return _LETTER[0]


def letter_streams(texts: list[str]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Per chunk of texts: its range, their characters (letters, single spaces) and where each text starts.

    Every text starts and ends with a space, so its first letters have a context.
    """
    for a, b in chunks([len(t) for t in texts], 2_000_000):
        parts = [" " + t.lower() + " " for t in texts[a:b]]
        c = code_points(parts)
        ok = _letters()[np.minimum(c, 0xFFFF)] | (c > 0xFFFF)
        c = np.where(ok, c, np.uint32(32))
        offsets = np.zeros(len(parts) + 1, dtype=np.int64)
        np.cumsum([len(p) for p in parts], out=offsets[1:])
        keep = ok.copy()
        keep[1:] |= ok[:-1]  # the first of a run of other characters stays as a space
        keep[offsets[:-1]] = True
        at = np.zeros(len(c) + 1, dtype=np.int64)
        np.cumsum(keep, out=at[1:])
        yield a, b, c[keep], at[offsets]


def gram_hashes(chars: np.ndarray, order: int) -> np.ndarray:
    """Hash of the ``order`` characters that end at each place (the first ones are of no use)."""
    h = np.zeros(len(chars), dtype=np.uint64)
    c = chars.astype(np.uint64) + np.uint64(1)
    for k in range(order - 1, -1, -1):
        h *= np.uint64(0x2545F4914F6CDD1D)
        h[k:] += c[: len(c) - k] if k else c
    return mixed(h)


@dataclass
class Model:
    languages: list[str]
    grams: list[np.ndarray]  # by order - 1: sorted hashes
    logs: list[np.ndarray]  # by order - 1: log probabilities [gram, language]
    contexts: list[np.ndarray]  # by length of the context - 1
    weights: list[np.ndarray]  # log of what the context leaves to the lower order
    floor: float
    sharpness: float = 20.0
    limits: list[float] | None = None

    def cross_entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Nats per character in each language, and the characters scored; no row's value depends on the others."""
        out = np.zeros((len(texts), len(self.languages)))
        sizes = np.zeros(len(texts), dtype=np.int64)
        for a, b, chars, first in letter_streams(texts):
            total = np.zeros((len(chars), len(self.languages)), dtype=np.float32)
            start = np.repeat(first[:-1], np.diff(first))
            open_ = np.flatnonzero(np.arange(len(chars)) > start)  # not the leading space
            place = np.arange(len(chars)) - start
            for order in range(len(self.grams), 0, -1):
                able = open_[place[open_] >= order - 1]
                short = open_[place[open_] < order - 1]
                h = gram_hashes(chars, order)[able]
                at = np.minimum(np.searchsorted(self.grams[order - 1], h), len(self.grams[order - 1]) - 1)
                found = self.grams[order - 1][at] == h
                total[able[found]] += self.logs[order - 1][at[found]]
                missed = able[~found]
                if order == 1:
                    total[missed] += self.floor
                elif len(missed):
                    h = gram_hashes(chars, order - 1)[missed - 1]
                    known = self.contexts[order - 2]
                    at = np.minimum(np.searchsorted(known, h), len(known) - 1)
                    hit = known[at] == h
                    total[missed[hit]] += self.weights[order - 2][at[hit]]
                open_ = np.concatenate([short, missed])
            sums = np.add.reduceat(total.astype(np.float64), first[:-1], axis=0)
            sizes[a:b] = np.maximum(np.diff(first) - 1, 1)
            out[a:b] = -sums / sizes[a:b, None]
        return out, sizes


def fit_kneser_ney(counts: dict[str, dict[str, int]], order: int = ORDER) -> Model:
    """Model from the counts of ``order``-grams of each language."""
    languages = sorted(counts)
    tables: list[dict[str, np.ndarray]] = [{} for _ in range(order)]
    lefts: list[dict[str, np.ndarray]] = [{} for _ in range(order)]
    for col, lang in enumerate(languages):
        level = {g: float(n) for g, n in counts[lang].items()}
        by_order = [level]
        for _ in range(order - 1):  # continuation counts: how many different characters precede
            lower: dict[str, float] = {}
            for g in by_order[0]:
                lower[g[1:]] = lower.get(g[1:], 0.0) + 1.0
            by_order.insert(0, lower)
        probability: dict[str, float] = {}
        size = sum(by_order[0].values())
        alphabet = len(by_order[0]) + 1
        for k, grams in enumerate(by_order):
            ones = sum(1 for n in grams.values() if n == 1)
            twos = sum(1 for n in grams.values() if n == 2)
            discount = max(_DISCOUNT_FLOOR, ones / (ones + 2 * twos) if ones else 0.5)
            totals: dict[str, float] = {}
            kinds: dict[str, int] = {}
            for g, n in grams.items():
                totals[g[:-1]] = totals.get(g[:-1], 0.0) + n
                kinds[g[:-1]] = kinds.get(g[:-1], 0) + 1
            nxt: dict[str, float] = {}
            for g, n in grams.items():
                c = g[:-1]
                lower = probability[g[1:]] if k else 1.0 / alphabet
                nxt[g] = max(n - discount, 0.0) / totals[c] + discount * kinds[c] / totals[c] * lower
            for g, p in nxt.items():
                tables[k].setdefault(g, np.full(len(languages), np.nan))[col] = np.log(p)
            for c in totals:
                lefts[k].setdefault(c, np.zeros(len(languages)))[col] = np.log(discount * kinds[c] / totals[c])
            probability = nxt
        del size
    floor = -np.log(2.0 * max(len(tables[0]), 1)) - 3.0
    # a gram that a language lacks: what its context leaves times the lower order's probability
    for k in range(order):
        for g, row in tables[k].items():
            gap = np.isnan(row)
            if gap.any():
                if k == 0:
                    row[gap] = floor
                else:
                    left = lefts[k].get(g[:-1])
                    row[gap] = (0.0 if left is None else left[gap]) + tables[k - 1][g[1:]][gap]
    def arrays(table: dict[str, np.ndarray], n: int) -> tuple[np.ndarray, np.ndarray]:
        keys = list(table)
        flat = code_points(keys)
        h = gram_hashes(flat, n)[n - 1 :: n]
        o = np.argsort(h)
        return h[o], np.array([table[g] for g in keys], dtype=np.float32)[o]

    grams, logs = zip(*(arrays(tables[k], k + 1) for k in range(order)))
    contexts, weights = zip(*(arrays(lefts[k], k) for k in range(1, order)))
    return Model(languages, list(grams), list(logs), list(contexts), list(weights), float(floor))


def gram_counts(texts: DataFrame, order: int = ORDER) -> DataFrame:
    """``(lang, gram, n)``: character n-grams of the texts (lang, text), counted by Spark."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for lang, part in b.groupby("lang"):
                for _, _, chars, first in letter_streams(part["text"].tolist()):
                    place = np.arange(len(chars)) - np.repeat(first[:-1], np.diff(first))
                    h = gram_hashes(chars, order)
                    ends = np.flatnonzero(place >= order - 1)
                    _, one, n = np.unique(h[ends], return_index=True, return_counts=True)
                    at = ends[one]
                    grams = ["".join(map(chr, chars[i - order + 1 : i + 1])) for i in at]
                    yield pd.DataFrame({"lang": lang, "gram": grams, "n": n})

    counted = texts.select("lang", "text").mapInPandas(count, "lang string, gram string, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def training_texts(labelled: DataFrame) -> DataFrame:
    """``(lang, text, r)``: the sample that is learned from, ``TRAIN_TEXTS`` different texts of each language at most.

    Those of the smallest text hashes: ids play no part, so rows that share
    one, or have none, are told apart, and a text that a language repeats is
    learned from once.
    """
    usable = labelled.filter("text is not null and lang is not null").filter(F.col("text").rlike(r"\p{L}")).select("lang", "text", row_key("text").alias("key"))
    few = bounded_sample(usable.select("lang", "key").distinct(), "lang", "key", TRAIN_TEXTS).select("lang", "key", "r")
    # at most TRAIN_TEXTS rows a language; copies of a text fold into one map-side
    return usable.join(F.broadcast(few), ["lang", "key"]).groupBy("lang", "key", "r").agg(F.min("text").alias("text")).select("lang", "text", "r")


def train(labelled: DataFrame, order: int = ORDER) -> Model:
    """Fit on labelled rows (text, lang): ``training_texts`` says which.

    All n-grams of the sample enter the discounts and continuation counts and
    stay in the model, whose size the sample bounds.  Without a labelled text
    that has a letter the model knows no language, and ``identify`` answers
    ``und``.
    """
    spark = labelled.sparkSession
    few = training_texts(labelled).persist()
    try:
        rows = gram_counts(few.filter(F.col("r") % KEPT_BACK != 0), order).toPandas()
        counts = {lang: dict(zip(p["gram"], p["n"])) for lang, p in rows.groupby("lang")}
        if not counts:
            return Model([], [], [], [], [], 0.0)
        model = fit_kneser_ney(counts, order)
        kept = few.filter(F.col("r") % KEPT_BACK == 0).select("lang", "text")
        calibrate(model, entropies(kept, spark.sparkContext.broadcast(vars(model)), "lang").toPandas())
    finally:
        few.unpersist()
    return model


def entropies(texts: DataFrame, model, *keep: str) -> DataFrame:
    """Cross-entropies of texts under a broadcast model, beside the columns to keep."""

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = b[list(keep)].copy()
            out["xent"] = list(Model(**model.value).cross_entropies(b["text"].tolist())[0])
            yield out

    kinds = dict(texts.dtypes)
    return texts.select(*keep, "text").mapInPandas(measure, ", ".join(f"{k} {kinds[k]}" for k in keep) + ", xent array<double>")


def calibrate(model: Model, kept: pd.DataFrame) -> None:
    """Sharpness of the scores and rejection limits from kept-back texts (lang, xent)."""
    index = {lang: i for i, lang in enumerate(model.languages)}
    kept = kept[kept["lang"].isin(index)]
    limits = [np.inf] * len(model.languages)
    if len(kept):
        x = np.array(kept["xent"].tolist())
        y = np.array([index[v] for v in kept["lang"]])
        own = x[np.arange(len(y)), y]
        best = None
        for sharp in (1.0, 2.0, 5.0, 10.0, 20.0, 40.0, 80.0):
            z = -x * sharp
            z -= z.max(axis=1, keepdims=True)
            loss = -(z[np.arange(len(y)), y] - np.log(np.exp(z).sum(axis=1))).mean()
            if best is None or loss < best[0]:
                best = (loss, sharp)
        model.sharpness = best[1]
        for i in range(len(limits)):
            mine = own[y == i]
            if len(mine):
                limits[i] = float(np.quantile(mine, 0.99) + 4 * mine.std() + 0.25)
    model.limits = limits


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, lang_pred, score, xent, rejected.

    A null text, or one without a letter, is ``und`` with score 0 and rejected;
    so is every text under a model that knows no language.
    Whole texts are scored; repeated rows are scored each; ties go to the
    language first in order.  Columns other than the two are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))

    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = Model(**shared.value)
        for b in batches:
            texts = [t or "" for t in b["text"]]
            if not model.languages:
                yield pd.DataFrame({"doc_id": b["doc_id"], "lang_pred": "und", "score": 0.0, "xent": np.nan, "rejected": True})
                continue
            x, _ = model.cross_entropies(texts)
            z = -x * model.sharpness
            z = np.exp(z - z.max(axis=1, keepdims=True))
            z /= z.sum(axis=1, keepdims=True)
            best = x.argmin(axis=1)
            low = x.min(axis=1)
            none = np.array([not any(map(str.isalpha, t)) for t in texts], dtype=bool)
            limit = np.array(model.limits or [np.inf] * len(model.languages))
            yield pd.DataFrame(
                {
                    "doc_id": b["doc_id"],
                    "lang_pred": np.where(none, "und", np.array(model.languages, dtype=object)[best]),
                    "score": np.where(none, 0.0, z.max(axis=1)),
                    "xent": np.where(none, np.nan, low),
                    "rejected": none | (low > limit[best]),
                }
            )

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInPandas(predict, f"doc_id {kind}, lang_pred string, score double, xent double, rejected boolean")
