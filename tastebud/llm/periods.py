"""Stretches of words that repeat with a period, found through a recompressed grammar.

A run is a stretch of consecutive words with smallest period p, long enough
(``min_length`` words and ``min_exponent`` periods), that no neighbouring word
extends keeping the period.

Recompression turns a chunk of texts into a run-length grammar, level by level:
first every block of equal symbols becomes one symbol (symbol, length), then
every neighbouring pair of a left and a right symbol becomes one, where a hash
of the symbol decides its side.  Equal stretches are rewritten alike but for
their ends, so the longest common extension of two positions is found by
climbing the levels while both sides agree and coming down where they differ,
a few symbols a level.  The extension to the left reads the same levels
mirrored.

Candidates come from a harmonic grid: a run of period p holds at least
max(min_length - p, (min_exponent - 1) p) neighbouring places whose word comes
again p words later, so places that far apart are tried for each p, about
n log n in all, and each is extended exactly on both sides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of text that a task works on at a time; a longer text is worked on alone.
TEXT_BYTES = 1_000_000
#: Candidates that are tried at a time.
CANDIDATES = 250_000
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def _sides(symbols: int, rounds: int) -> np.ndarray:
    """Whether each symbol is a left one in this round."""
    x = (np.arange(symbols, dtype=np.uint64) + np.uint64(0x632BE59BD9B4E019 * (rounds + 1) % 2**64)) * _GOLD
    x = (x ^ (x >> np.uint64(29))) * _MIX
    return (x >> np.uint64(40)) & np.uint64(1) == 1


class Grammar:
    """Levels of a recompressed sequence, from the sequence itself up to one in which nothing more is joined.

    Level l has its symbols ``sym[l]``.  ``up[l]`` gives for a symbol of level l
    the one of level l + 1 that begins with it, or -1 where it is inside one;
    ``down[l]`` gives for a symbol of level l + 1 its first of level l.  All
    levels together hold about four times the sequence, some 80 bytes a word
    with the mirror.
    """

    def __init__(self, sequence: np.ndarray):
        self.n = len(sequence)
        self.sym = [sequence.astype(np.int32)]
        self.rest: list[np.ndarray | None] = []
        self.up: list[np.ndarray] = []
        self.down: list[np.ndarray] = []
        symbols, idle, rounds = int(sequence.max()) + 1 if self.n else 0, 0, 0
        while len(self.sym[-1]) > 1 and idle < 40:  # so many rounds of sides without a pair: what is left is compared as it is
            before, rounds = len(self.sym[-1]), rounds + 1
            symbols = self._blocks(symbols)
            symbols = self._pairs(symbols, rounds)
            idle = idle + 1 if len(self.sym[-1]) >= before - before // 64 else 0
        self._mirror: Grammar | None = None

    def _push(self, head: np.ndarray, sym: np.ndarray, rest: np.ndarray | None) -> None:
        """A level whose symbols begin at the ``head`` symbols of the one before."""
        self.rest.append(rest)
        up = np.full(len(self.sym[-1]), -1, dtype=np.int32)
        up[head] = np.arange(len(head))
        self.up.append(up)
        self.down.append(head.astype(np.int32))
        self.sym.append(sym)

    def _blocks(self, symbols: int) -> int:
        """Blocks of two or more equal symbols become one symbol for each (symbol, length)."""
        s = self.sym[-1]
        head = np.flatnonzero(np.append(True, s[1:] != s[:-1]))
        if len(head) == len(s):
            return symbols
        length = np.diff(np.append(head, len(s)))
        sym, many = s[head], length > 1
        _, name = np.unique(sym[many].astype(np.int64) * (self.n + 1) + length[many], return_inverse=True)
        sym = sym.copy()
        sym[many] = symbols + name
        end = np.repeat(head + length, length)
        self._push(head, sym, (end - np.arange(len(s))).astype(np.int32))
        return symbols + int(name.max()) + 1

    def _pairs(self, symbols: int, rounds: int) -> int:
        """A left symbol and a right one after it become one symbol for each pair."""
        s = self.sym[-1]
        left = _sides(symbols, rounds)[s]
        first = np.flatnonzero(left[:-1] & ~left[1:])
        if not len(first):
            return symbols
        inside = np.zeros(len(s), dtype=bool)
        inside[first + 1] = True
        head = np.flatnonzero(~inside)
        _, name = np.unique(s[first].astype(np.int64) * symbols + s[first + 1], return_inverse=True)
        sym = s.copy()
        sym[first] = symbols + name
        self._push(head, sym[head], None)
        return symbols + int(name.max()) + 1

    def mirror(self) -> Grammar:
        """The same levels read from the end: its extensions are those to the left."""
        if self._mirror is None:
            m = object.__new__(Grammar)
            m.n, m._mirror = self.n, None  # no way back: a cycle would keep the levels until a collection
            m.sym = [s[::-1] for s in self.sym]
            m.up, m.down, m.rest = [], [], []
            for level, head in enumerate(self.down):
                size = len(self.sym[level])
                if self.rest[level] is None:
                    m.rest.append(None)
                else:  # symbols since the block's begin, the symbol's own with it
                    m.rest.append((np.arange(1, size + 1) - np.repeat(head, np.diff(np.append(head, size)))).astype(np.int32)[::-1])
                last = np.append(head[1:], size) - 1  # last part of each symbol is its first one mirrored
                first = (size - 1 - last)[::-1].astype(np.int32)
                up = np.full(size, -1, dtype=np.int32)
                up[first] = np.arange(len(first))
                m.up.append(up)
                m.down.append(first)
            self._mirror = m
        return self._mirror

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many symbols of the sequence agree from places ``a`` and ``b`` on (a < b, elementwise)."""
        out = np.zeros(len(a), dtype=np.int64)
        live = np.arange(len(a))
        x, y = a.astype(np.int64), b.astype(np.int64)  # symbols of the current level that come next on either side
        stopped: list[list[np.ndarray]] = [[] for _ in self.sym]  # queries that differ at a level
        where = (np.empty(len(a), dtype=np.int64), np.empty(len(a), dtype=np.int64))
        for level, s in enumerate(self.sym):
            up, rest = (self.up[level], self.rest[level]) if level < len(self.up) else (None, None)
            todo = np.arange(len(live))
            x, y = x.copy(), y.copy()
            rising = np.zeros(len(live), dtype=bool)
            while len(todo):
                if up is not None:
                    inner = (x[todo] < len(s)) & (y[todo] < len(s))
                    both = np.zeros(len(todo), dtype=bool)
                    both[inner] = (up[x[todo[inner]]] >= 0) & (up[y[todo[inner]]] >= 0)
                    rising[todo[both]] = True
                    todo = todo[~both]
                same = (x[todo] < len(s)) & (y[todo] < len(s))
                same[same] = s[x[todo[same]]] == s[y[todo[same]]]
                halt = todo[~same]
                if len(halt):
                    q = live[halt]
                    stopped[level].append(q)
                    where[0][q], where[1][q] = x[halt], y[halt]
                todo = todo[same]
                step = 1 if rest is None else np.minimum(rest[x[todo]], rest[y[todo]])
                x[todo] += step
                y[todo] += step
            live, x, y = live[rising], x[rising], y[rising]
            if up is not None:
                x, y = up[x], up[y]
            if not len(live):
                break
        # come down from the highest level: compare the parts of the symbols that differ
        falling = np.empty(0, dtype=np.int64)
        for level in range(len(self.sym) - 1, -1, -1):
            s, size = self.sym[level], len(self.sym[level])
            rest = self.rest[level] if level < len(self.rest) else None
            falling = np.concatenate([falling, *stopped[level]])
            if not len(falling):
                continue
            x, y = where[0][falling], where[1][falling]
            todo = np.arange(len(falling))
            while len(todo):
                same = (x[todo] < size) & (y[todo] < size)
                same[same] = s[x[todo[same]]] == s[y[todo[same]]]
                todo = todo[same]
                step = 1 if rest is None else np.minimum(rest[x[todo]], rest[y[todo]])
                x[todo] += step
                y[todo] += step
            if level:
                low = np.append(self.down[level - 1], len(self.sym[level - 1]))
                where[0][falling], where[1][falling] = low[x], low[y]
            else:
                out[falling] = x - a[falling]
        return out


def _grid(n: int, longest: int, min_length: int, min_exponent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, period) of the harmonic grid over ``n`` places, up to ``CANDIDATES`` at a time (one period at least)."""
    periods = np.arange(1, min(longest // min_exponent, n - 1) + 1)
    step = np.maximum(np.maximum(min_length - periods, (min_exponent - 1) * periods), 1)
    count = -(-(n - periods) // step)
    upto = np.cumsum(count)
    start = 0
    while start < len(periods):
        end = max(start + 1, int(np.searchsorted(upto, (upto[start - 1] if start else 0) + CANDIDATES, side="right")))
        c = count[start:end]
        nth = np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c)
        yield nth * np.repeat(step[start:end], c), np.repeat(periods[start:end], c)
        start = end


def runs(sequence: np.ndarray, edges: np.ndarray, min_length: int, min_exponent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and period of all runs of the texts that lie between ``edges``, by start, then period.

    The sequence holds numbers of words, equal for equal words; each text is
    followed by a number of its own, so no run goes from one into the next.
    """
    n, none = len(sequence), np.empty(0, dtype=np.int64)
    longest = int(np.diff(edges).max()) - 1 if len(edges) > 1 else 0
    if longest < max(min_length, min_exponent):
        return none, none, none
    found, grammar = [], None
    for place, period in _grid(n, longest, min_length, min_exponent):
        hit = sequence[place] == sequence[place + period]
        place, period = place[hit], period[hit]
        if not len(place):
            continue
        grammar = grammar or Grammar(sequence)
        right = grammar.common(place, place + period)
        # places mirrored: what lies to the left of a place comes next from n - place on
        left = grammar.mirror().common(n - place - period, n - place)
        length = left + right + period
        keep = length >= np.maximum(min_length, min_exponent * period)
        if keep.any():
            found.append(np.unique(np.stack([(place - left)[keep], length[keep], period[keep]]), axis=1))
    if not found:
        return none, none, none
    start, length, period = np.unique(np.concatenate(found, axis=1), axis=1)
    # of one stretch the smallest period counts; the others are its multiples
    first = np.append(True, (start[1:] != start[:-1]) | (length[1:] != length[:-1]))
    start, length, period = start[first], length[first], period[first]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def _texts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch's rows in order, about ``TEXT_BYTES`` of text at a time."""
    upto = np.cumsum(pc.binary_length(batch.column("text")).to_numpy().astype(np.int64)) // TEXT_BYTES
    edges = [0, *(np.flatnonzero(np.diff(upto)) + 1).tolist(), batch.num_rows]
    for a, b in zip(edges[:-1], edges[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def _work(texts: pa.Array, min_length: int, min_exponent: int) -> tuple[list, list]:
    """Runs of each text as (start, length, period), and the text without repeats."""
    words = [t.encode("utf-8", "surrogatepass").split() for t in texts.to_pylist()]
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    edges = np.append(0, np.cumsum(sizes + 1))
    number: dict[bytes, int] = {}
    sequence = np.empty(edges[-1], dtype=np.int64)
    for w, a in zip(words, edges):
        sequence[a : a + len(w)] = [number.setdefault(x, len(number)) for x in w]
    sequence[edges[1:] - 1] = len(number) + np.arange(len(words))
    start, length, period = runs(sequence, edges, min_length, min_exponent)
    text = np.searchsorted(edges, start, side="right") - 1
    found: list[list[tuple]] = [[] for _ in words]
    for t, s, n, p in zip(text.tolist(), (start - edges[text]).tolist(), length.tolist(), period.tolist()):
        found[t].append((s, n, p))
    short = []
    for w, own in zip(words, found):
        if own:
            gone = np.zeros(len(w) + 1, dtype=np.int64)
            for s, n, p in own:
                gone[s + p] += 1
                gone[s + n] -= 1
            w = [x for x, g in zip(w, np.cumsum(gone).tolist()) if not g]
        short.append(b" ".join(w))
    return found, short


def find_runs(docs: DataFrame, min_length: int = 24, min_exponent: int = 3) -> DataFrame:
    """One row per document: doc_id, runs (array of start, length, period) and collapsed.

    Words are stretches without the characters 20 and 09 to 0D, counted from 0.
    ``runs`` holds every maximal stretch with smallest period p of at least
    ``min_length`` words and ``min_exponent`` periods, by start, then period.
    ``collapsed`` is the text's words, joined by one space, without those that
    any run holds behind its first p words.  A null text is empty: no runs, an
    empty text.  Repeated rows have a row each; an empty table gives none;
    other columns are not read.  Words are compared exactly, whatever their
    length.
    """
    if min_exponent < 2 or min_length < 1:
        raise ValueError("min_exponent must be at least 2, min_length at least 1")
    kind = docs.schema["doc_id"].dataType.simpleString()
    structs = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _texts(whole):
                found, short = _work(batch.column("text"), min_length, min_exponent)
                rows = [[{"start": s, "length": n, "period": p} for s, n, p in own] for own in found]
                collapsed = pa.array(short, pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, structs), collapsed], names=["doc_id", "runs", "collapsed"])

    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(work, f"doc_id {kind}, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")
