"""Packing documents into equal sequences whose mixture is steered token by token.

Documents wait in queues, one a source, in the order of the table's files.  A
deficit round-robin serves the queues: in every round a queue's deficit grows by
its quantum (its share of a window), and it gives as many whole tokens as the
deficit holds; what is left over is carried to the next round.  Rounds follow
each other without regard to the windows, so a queue that a window's end cuts
short goes on in the next window with what it is still owed.  A window thus
holds every queue's share to within the number of queues.

Nothing of this needs a walk over the windows.  After round r a queue of
quantum q has given ``min(its tokens, floor(r * q))`` tokens, so the round and
the place in the stream of any token follow from the token's place in its own
queue and the table of queues (one row each).  Tasks work out the pieces of
their own documents; what they need from others are the tokens that earlier
files hold of each queue.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tastebud.llm.scratch import written

#: Sources share queues by hash beyond this number: a window has no room for more shares of a token.
MAX_QUEUES = 2_048
#: Rows of (part, queue) offsets that are broadcast at most; more are joined by a shuffle.
BROADCAST_OFFSETS = 200_000
#: Words whose ids a task remembers, and the longest of them in bytes.
REMEMBERED, REMEMBERED_BYTES = 400_000, 64
#: How the tokenizer parts words of ASCII without apostrophes, in lower case: fixed values.
ASCII_PARTS = re.compile(rb"[a-z]+|[0-9]|[^a-z0-9]+")
#: Bytes of texts, and of ids, that a task works on at a time.
TEXT_BYTES, ID_BYTES = 8_000_000, 8_000_000


def word_encoder(definition: str) -> Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]:
    """Texts to their ids, one after the other, and the number of each text's, for a tokenizer that ignores case, drops white space and never joins words over it.

    ``definition`` is the tokenizer's JSON.  Words are encoded once and
    remembered; a text that holds one of the tokenizer's added tokens goes
    through the tokenizer as a whole.  New words of letters alone are encoded a
    hundred at a time, side by side, and told apart by the tokenizer's end of
    word; where that does not give one end a word, they are encoded singly.
    Marks behind letters, and parts of ASCII words, are encoded apart, as the
    tokenizer parts them.
    """
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tokenizer = Tokenizer.from_str(definition)
    added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    suffix = getattr(tokenizer.model, "end_of_word_suffix", None)
    ends = np.zeros(tokenizer.get_vocab_size() + 1, dtype=bool)
    if suffix:
        ends[[i for token, i in tokenizer.get_vocab(with_added_tokens=False).items() if token.endswith(suffix)]] = True
    known: dict[bytes, bytes] = {}

    def packed(ids: list[int]) -> bytes:
        return np.asarray(ids, dtype="<u4").tobytes()

    def singly(words: list[str]) -> list[bytes]:
        return [packed(e.ids) for e in tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def side_by_side(words: list[str]) -> list[bytes]:
        out, chunks = [], [words[i : i + 100] for i in range(0, len(words), 100)]
        for chunk, e in zip(chunks, tokenizer.encode_batch_fast([" ".join(c) for c in chunks], add_special_tokens=False)):
            ids = np.asarray(e.ids, dtype="<u4")
            last = np.flatnonzero(ends[ids])
            if len(last) != len(chunk):
                out += singly(chunk)
                continue
            raw, at = ids.tobytes(), 0
            for end in (4 * (last + 1)).tolist():
                out.append(raw[at:end])
                at = end
        return out

    def learn(new: list[bytes]) -> None:
        plain, composed, rest = {}, [], []
        for word in new:
            text = word.decode("utf-8")
            if not suffix:
                rest.append(word)
            elif text.isalpha():
                plain[word] = text
            elif text[-1] in ".,;:!?" and text[:-1].lower().isalpha():
                composed.append((word, (word[:-1], word[-1:])))
            elif text.isascii() and "'" not in text:
                composed.append((word, ASCII_PARTS.findall(word)))
            else:
                rest.append(word)
        others = {}
        for _, parts in composed:
            for p in parts:
                if p not in known:
                    (plain if p[:1].isalpha() or p[0] > 127 else others)[p] = p.decode("utf-8")
        known.update(zip(plain, side_by_side(list(plain.values()))))
        known.update(zip(others, singly(list(others.values()))))
        known.update((w, b"".join(map(known.__getitem__, parts))) for w, parts in composed)
        known.update(zip(rest, singly([w.decode("utf-8") for w in rest])))

    def encode(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if len(known) > REMEMBERED:
            known.clear()
        special = np.zeros(len(texts), dtype=bool)
        for token in added:
            special |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        split = pc.ascii_split_whitespace(pc.ascii_lower(pc.if_else(pa.array(special), "", texts) if special.any() else texts))
        every = split.flatten().dictionary_encode()
        words = [w.encode("utf-8") for w in every.dictionary.to_pylist()]
        known[b""] = b""  # before white space at a text's start
        learn([w for w in words if w not in known])
        own = [known[w] for w in words]
        for word in words:
            if len(word) > REMEMBERED_BYTES:
                known.pop(word, None)
        sizes = np.array([len(x) // 4 for x in own], dtype=np.int64)
        table, at = np.frombuffer(b"".join(own), dtype="<u4"), np.cumsum(sizes) - sizes
        index, edges = every.indices.to_numpy(), split.offsets.to_numpy() - split.offsets[0].as_py()
        ids = table[_ranges(at[index], sizes[index])]
        upto = np.append(0, np.cumsum(sizes[index]))[edges]
        counts = np.diff(upto)
        if special.any():
            pieces = [ids[a:b] for a, b in zip(upto[:-1], upto[1:])]
            for i in np.flatnonzero(special):
                pieces[i] = np.asarray(tokenizer.encode(texts[i].as_py(), add_special_tokens=False).ids, dtype="<u4")
            ids, counts = np.concatenate(pieces), np.array([len(x) for x in pieces], dtype=np.int64)
        return ids, counts

    return encode


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... of size[0] numbers, then those of the next."""
    return np.arange(size.sum()) + np.repeat(start - (np.cumsum(size) - size), size)


def encode_queues(docs: DataFrame, queue: Column, tokenizer_path: str, end_id: int) -> DataFrame:
    """doc_id, queue, n (tokens), ids, and where the document lies: ``part`` and ``before``, the queue's tokens earlier in that part.

    A null text is empty; every document ends with ``end_id``.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    with open(tokenizer_path, encoding="utf-8") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())  # a vocabulary, whatever the table

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, part = word_encoder(shared.value), TaskContext.get().partitionId()
        given: dict[int, int] = {}
        for whole in batches:
            for batch in _cut(whole, pc.binary_length(whole.column("text")).to_numpy(), TEXT_BYTES):
                ids, counts = encode(batch.column("text"))
                n = counts + 1
                ended = np.full(n.sum(), end_id, dtype="<u4")
                ended[np.arange(len(ids)) + np.repeat(np.arange(len(counts)), counts)] = ids
                before, queues = np.zeros(len(n), dtype=np.int64), batch.column("queue").to_numpy()
                for k in np.unique(queues):
                    own = np.flatnonzero(queues == k)
                    upto = np.cumsum(n[own]) + given.get(int(k), 0)
                    before[own], given[int(k)] = upto - n[own], int(upto[-1])
                edges = pa.py_buffer(np.append(0, np.cumsum(4 * n)).astype(np.int32))
                column = pa.Array.from_buffers(pa.binary(), len(n), [None, edges, pa.py_buffer(ended)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("queue"), pa.array(n), pa.array(np.full(len(n), part, dtype=np.int32)), pa.array(before), column],
                    names=["doc_id", "queue", "n", "part", "before", "ids"],
                )

    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), queue.alias("queue"))
    return rows.mapInArrow(run, f"doc_id {kind}, queue int, n long, part int, before long, ids binary")


@dataclass(frozen=True)
class Service:
    """The round-robin in closed form: tokens and quanta (in units of 2**-bits tokens) of the queues, in the order of service."""

    tokens: np.ndarray
    quanta: np.ndarray
    bits: int

    @staticmethod
    def of(tokens: list[int], weights: list[float], window: int) -> Service:
        """Quanta are ``window`` shared by weight.  Weights are positive; queues without tokens are allowed."""
        share = np.array(weights, dtype=np.float64)
        if not (np.isfinite(share).all() and (share > 0).all()):
            raise ValueError("weights must be positive and finite")
        quanta = window * share / share.sum()
        rounds = int(max([2, *[n / q for n, q in zip(tokens, quanta)]])) + 2
        # rounds * quantum must stay below 2**62
        bits = 61 - rounds.bit_length() - int(window).bit_length()
        if bits < 4:
            raise ValueError("weights lie too far apart for the number of tokens")
        return Service(np.array(tokens, dtype=np.int64), np.maximum(1, np.floor(quanta * (1 << bits))).astype(np.int64), bits)

    def given(self, rounds: np.ndarray) -> np.ndarray:
        """Tokens that each queue (columns) has given after so many rounds (rows)."""
        rounds = np.minimum(rounds[:, None], (1 << 62) // self.quanta)
        return np.minimum(self.tokens, (rounds * self.quanta) >> self.bits)

    def round_of(self, queue: int, token: np.ndarray) -> np.ndarray:
        """The round (from 1) in which the queue gives its token of that place (from 0)."""
        q = int(self.quanta[queue])
        # smallest r with floor(r q / 2**bits) > token, that is r >= (token + 1) 2**bits / q
        whole, rest = np.divmod(token + 1, q)
        return whole * (1 << self.bits) + _ceil_shifted(rest, q, self.bits)

    def pieces(self, queue: int, before: np.ndarray, n: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Cuts of documents of ``n`` tokens that stand behind ``before`` others of their queue: document, start, length, place in the stream.

        A piece ends where the queue's turn ends, and at a window's end; turns
        that follow each other without another queue's between are one piece.
        """
        often = self.quanta[queue] >> self.bits > 0  # a token or more in every round: go by rounds, else by tokens
        first = self.round_of(queue, before) if often else before
        count = self.round_of(queue, before + n - 1) - first + 1 if often else n
        upto = np.cumsum(count)
        found = []
        step = max(1, 400_000 // len(self.tokens))
        for a in range(0, int(upto[-1]), step):
            row = np.arange(a, min(a + step, int(upto[-1])))
            doc = np.searchsorted(upto, row, side="right")
            at = first[doc] + row - (upto[doc] - count[doc])
            rounds = at if often else self.round_of(queue, at)
            old, new = self.given(rounds - 1), self.given(rounds)
            lo, hi = np.maximum(old[:, queue], before[doc]), np.minimum(new[:, queue], (before + n)[doc])
            if not often:
                lo, hi = at, at + 1
            place = old.sum(axis=1) + (new - old)[:, :queue].sum(axis=1) + lo - old[:, queue]
            keep = hi > lo
            found.append((doc[keep], (lo - before[doc])[keep], (hi - lo)[keep], place[keep]))
        doc, start, length, place = map(np.concatenate, zip(*found))
        # join turns that touch, then cut at the windows' ends
        head = np.flatnonzero(np.append(True, (place[1:] != place[:-1] + length[:-1]) | (doc[1:] != doc[:-1])))
        doc, start, place, length = doc[head], start[head], place[head], np.add.reduceat(length, head)
        cuts = (place + length - 1) // window - place // window  # ends of windows inside
        which = np.repeat(np.arange(len(place)), cuts + 1)
        nth = np.arange(len(which)) - np.repeat(np.cumsum(cuts + 1) - cuts - 1, cuts + 1)
        begin = np.where(nth == 0, place[which], (place[which] // window + nth) * window)
        end = np.minimum((place + length)[which], (begin // window + 1) * window)
        return doc[which], start[which] + begin - place[which], end - begin, begin


def _ceil_shifted(rest: np.ndarray, q: int, bits: int) -> np.ndarray:
    """ceil(rest * 2**bits / q) for 0 <= rest < q; exact for products beyond 64 bits."""
    if q.bit_length() + bits < 62:
        return -((-(rest << bits)) // q)
    return np.array([-((-(int(x) << bits)) // q) for x in rest.ravel()], dtype=np.int64).reshape(rest.shape)


def pack(docs: DataFrame, tokenizer_path: str, weights: Mapping[str | None, float] | None = None, length: int = 2_048, end_id: int = 1) -> DataFrame:
    """Every document's pieces: doc_id, source_queue, start, length, ids, doc_tokens, sequence_id, offset.

    ``ids`` are the piece's token ids, little-endian and unsigned of 32 bits,
    cut from the document's ids and ``end_id``; pieces of a sequence lie at
    ``offset`` one after the other, and all sequences but the last hold
    ``length`` tokens.  ``weights`` are the sources' target shares of a window;
    without them a source weighs what tokens it has, so every window has the
    table's own mixture and all queues end together.  Sources that ``weights``
    leaves out weigh 1.  A queue that is empty gives its room to the others, in
    proportion to their weights.

    Each token lies in exactly one piece.  A null text is empty (one token, the
    end), a null source is a source, repeated rows are packed each, an empty
    table gives no rows, columns other than doc_id, text and source are not
    read.  Beyond ``MAX_QUEUES`` sources, sources share queues by hash and a
    queue weighs what its sources weigh together.  Queues follow the order of
    the table's files, so reruns agree as long as the files are split alike.
    """
    if length < 1:
        raise ValueError("length must be at least 1")
    spark = docs.sparkSession
    names = docs.select("source").distinct()
    few = [r[0] for r in names.limit(MAX_QUEUES + 1).collect()]
    if len(few) <= MAX_QUEUES:
        order = sorted(few, key=lambda s: (s is None, s or ""))
        numbered = spark.createDataFrame([(s, i) for i, s in enumerate(order)], "source string, queue int")
        shares = [1.0 if weights is None else float(weights.get(s, 1.0)) for s in order]
        rows = docs.select("doc_id", "text", F.col("source").alias("_source")).join(F.broadcast(numbered), F.col("_source").eqNullSafe(F.col("source")))
        queue = F.col("queue")
    else:
        queue = F.pmod(F.xxhash64("source"), F.lit(MAX_QUEUES)).cast("int")
        shares = _shared_weights(names.select("source", queue.alias("queue")), weights)
        rows = docs.select("doc_id", "text", "source")
    encoded = written(encode_queues(rows, queue, tokenizer_path, end_id), "encoded")

    held = encoded.groupBy("part", "queue").agg(F.sum("n").alias("held"))
    earlier = Window.partitionBy("queue").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = written(held.select("part", "queue", "held", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("offset")), "offsets")
    totals = {r.queue: r.tokens for r in offsets.groupBy("queue").agg(F.sum("held").alias("tokens")).collect()}  # at most MAX_QUEUES
    tokens = [totals.get(i, 0) for i in range(len(shares))]
    service = Service.of(tokens, [max(n, 1) for n in tokens] if weights is None else shares, length) if tokens else None

    small = offsets.count() <= BROADCAST_OFFSETS
    placed = encoded.join(F.broadcast(offsets) if small else offsets, ["part", "queue"]).select(
        "doc_id", "queue", F.col("n").alias("doc_tokens"), (F.col("offset") + F.col("before")).alias("before"), "ids"
    )
    kind = docs.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _cut(whole, 4 * whole.column("doc_tokens").to_numpy(), ID_BYTES):
                yield _piece_batch(batch, service, length)

    out = f"doc_id {kind}, source_queue int, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    return placed.mapInArrow(cut, out)


def _cut(batch: pa.RecordBatch, sizes: np.ndarray, limit: int) -> Iterator[pa.RecordBatch]:
    """The batch's rows in order, about ``limit`` of ``sizes`` at a time and one row at least."""
    edges = np.flatnonzero(np.diff(np.cumsum(sizes.astype(np.int64)) // limit)) + 1
    for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(sizes)]):
        if b > a:
            yield batch.slice(a, b - a)


def _piece_batch(batch: pa.RecordBatch, service: Service, length: int) -> pa.RecordBatch:
    """The pieces of a batch of documents."""
    queue, n, before = (batch.column(c).to_numpy() for c in ("queue", "doc_tokens", "before"))
    found = []
    for k in np.unique(queue):
        own = np.flatnonzero(queue == k)
        doc, *rest = service.pieces(int(k), before[own], n[own], length)
        found.append((own[doc], *rest))
    row, start, size, place = map(np.concatenate, zip(*found))
    column = batch.column("ids")
    texts = [memoryview(x.as_buffer()) for x in column]
    ids = [bytes(texts[i][4 * a : 4 * (a + m)]) for i, a, m in zip(row.tolist(), start.tolist(), size.tolist())]
    take = pa.array(row)
    names = ["doc_id", "source_queue", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id").take(take), batch.column("queue").take(take), pa.array(start), pa.array(size), pa.array(ids, pa.binary()), batch.column("doc_tokens").take(take), pa.array(place // length), pa.array(place % length)],
        names=names,
    )


def _shared_weights(names: DataFrame, weights: Mapping[str | None, float] | None) -> list[float]:
    """Weight of each of the ``MAX_QUEUES`` queues: its sources' sum."""
    counts = {r.queue: r.n for r in names.groupBy("queue").agg(F.count(F.lit(1)).alias("n")).collect()}
    shares = [float(counts.get(i, 0)) or 1.0 for i in range(MAX_QUEUES)]
    if weights:
        given = names.sparkSession.createDataFrame([(s, float(w)) for s, w in weights.items()], "source string, w double")
        own = names.join(F.broadcast(given).withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).groupBy("queue").agg(F.sum(F.col("w") - 1).alias("more"))
        for r in own.collect():
            shares[r.queue] += r.more
    return shares


def window_mixture(pieces: DataFrame) -> DataFrame:
    """Tokens that each sequence has of each queue: sequence_id, source_queue, tokens."""
    return pieces.groupBy("sequence_id", "source_queue").agg(F.sum("length").alias("tokens"))


def sequences(pieces: DataFrame) -> DataFrame:
    """The packed sequences: sequence_id, n_tokens, ids.  A task's group is one sequence."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x["ids"]))
    return pieces.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), joined.alias("ids"))
