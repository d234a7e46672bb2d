"""Token counts of parts of documents, from one encoding of the whole document.

Every document is encoded once.  The byte lengths of its tokens give each
token's span, and the spans of tokens are joined to the spans of the parts
(fields, sections) by their order: an interval join inside the document, where
both sides are sorted.  A token that crosses a boundary goes by ``rule``:

* ``start``: to the part that holds its first byte;
* ``majority``: to the part that holds most of its bytes, the earlier of equals;
* ``split``: to each part in proportion to its bytes.

So the counts of a document's parts always add up to the document's tokens.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Where the tokenizer's ranks are read from unless a path is given, and how it cuts texts: fixed values.
RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
RULES = ("start", "majority", "split")
_OUTSIDE = "outside"


def line_sections(text: Column) -> Column:
    """Spans of ``lead`` (first line), ``tail`` (last of several lines) and ``body`` (what lies between), newlines with their line.

    An empty or null text is an empty lead.
    """
    n = F.length(text)
    first = F.locate("\n", text)
    last = n - F.locate("\n", F.reverse(text)) + 1  # characters up to and with the last newline

    def span(name: str, start: Column, end: Column) -> Column:
        return F.struct(F.lit(name).alias("section"), start.cast("long").alias("start"), end.cast("long").alias("end"))

    whole = F.array(span("lead", F.lit(0), F.coalesce(n, F.lit(0))))
    two = F.array(span("lead", F.lit(0), first), span("tail", first, n))
    three = F.array(span("lead", F.lit(0), first), span("body", first, last), span("tail", last, n))
    return F.when(F.coalesce(first, F.lit(0)) == 0, whole).when(first == last, two).otherwise(three)


def partition(spans: list[tuple[str, int, int]], size: int) -> tuple[list[str], np.ndarray]:
    """Parts that cover [0, size) without gap or overlap: the spans by start, what an earlier one left, and ``outside``."""
    names, edges, at = [], [0], 0
    for name, start, end in sorted(spans, key=lambda s: (s[1], s[2])):
        start, end = max(at, min(max(start, 0), size)), min(end, size)
        if end <= start:
            continue
        if start > at:
            names.append(_OUTSIDE)
            edges.append(start)
        names.append(name)
        edges.append(end)
        at = end
    if at < size:
        names.append(_OUTSIDE)
        edges.append(size)
    return names, np.array(edges, dtype=np.int64)


def attribute(ends: np.ndarray, edges: np.ndarray, rule: str) -> np.ndarray:
    """Tokens of each part: tokens end at ``ends`` and follow each other from 0, part k is [edges[k], edges[k + 1])."""
    starts = np.concatenate([[0], ends[:-1]])
    first = np.searchsorted(edges, starts, side="right") - 1
    last = np.searchsorted(edges, ends - 1, side="right") - 1
    if rule == "start":
        return np.bincount(first, minlength=len(edges) - 1).astype(np.float64)
    whole = first == last
    out = np.bincount(first[whole], minlength=len(edges) - 1).astype(np.float64)
    for t in np.flatnonzero(~whole):
        parts = np.arange(first[t], last[t] + 1)
        held = np.minimum(edges[parts + 1], ends[t]) - np.maximum(edges[parts], starts[t])
        if rule == "majority":
            out[parts[held.argmax()]] += 1.0
        else:
            out[parts] += held / (ends[t] - starts[t])
    return out


def count_tokens(docs: DataFrame, spans: Column, rule: str = "majority", ranks_path: str = RANKS) -> DataFrame:
    """One row per document and part: doc_id, section, n_chars, n_tokens, doc_tokens.

    ``spans`` is an array of structs (section, start, end) in characters of
    ``text``; parts of one name in a document are summed, characters in no span
    count as ``outside``, of overlapping spans the one that starts first keeps
    what they share, and a named part without characters has a row with 0.
    A null text is empty; repeated rows have rows each; other columns are not
    read.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(n) for a, n in map(bytes.split, f)}
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import tiktoken

        encoding = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=shared.value, special_tokens={})
        lengths = np.zeros(max(shared.value.values()) + 1, dtype=np.int64)
        for token, i in shared.value.items():
            lengths[i] = len(token)
        for b in batches:
            ids, names, chars, counts, totals = [], [], [], [], []
            for doc_id, text, own in zip(b["doc_id"], b["text"], b["spans"]):
                text = text or ""
                raw = np.frombuffer(text.encode("utf-8"), dtype=np.uint8)
                parts, edges = partition([(s["section"], s["start"], s["end"]) for s in own], len(text))
                ends = np.cumsum(lengths[np.array(encoding.encode_ordinary(text), dtype=np.int64)])
                byte_of = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))  # of each character
                tokens = attribute(ends, byte_of[edges], rule) if len(ends) else np.zeros(len(parts))
                sums = {s["section"]: [0, 0.0] for s in own}
                for name, n, k in zip(parts, np.diff(edges), tokens):
                    at = sums.setdefault(name, [0, 0.0])
                    at[0] += int(n)
                    at[1] += float(k)
                for name, (n, k) in sums.items():
                    ids.append(doc_id)
                    names.append(name)
                    chars.append(n)
                    counts.append(k)
                    totals.append(len(ends))
            out = pd.DataFrame({"doc_id": ids, "section": names, "n_chars": chars, "n_tokens": counts, "doc_tokens": totals})
            yield out

    kind = dict(docs.dtypes)["doc_id"]
    rows = docs.select("doc_id", "text", F.coalesce(spans, F.array().cast("array<struct<section:string,start:bigint,end:bigint>>")).alias("spans"))
    return rows.mapInPandas(count, f"doc_id {kind}, section string, n_chars long, n_tokens double, doc_tokens long")
