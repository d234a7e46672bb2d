"""Near-duplicate join on word shingles: adaptive multi-match prefixes.

Shingles are ordered by a hash, the same for all texts.  A set of n shingles
has the prefix of length ``n - ceil(t n) + 1``: two sets of Jaccard similarity
t or more share a shingle of their prefixes.  With prefixes longer by l - 1
they share at least l.  Every set keeps the pool for its longest allowed
prefix, ``LEVEL_SHARE`` of its size more, and picks its own l:

1. Exact copies (equal shingle sets) are one class, and its row with the
   smallest id stands for it, by the number of the row: ids may be repeated.
2. Pools are counted against each other.  A set that shares fewer than its
   least level of pool shingles with all other sets together has no partner
   and leaves; a second count sees only the sets that are left.
3. A shingle is heavy when ``HEAVY`` or more pools hold it.  A set may pass
   over the heavy shingles of its prefix when its level l is above their
   number: l shared shingles then always hold a light one.  Of the levels that
   allow it, the set takes the one of least cost, ``sum of counts`` rows to
   join plus ``sum of counts / l`` sets to verify.  A set with no such level is
   saturated: it takes its highest one and passes over its heaviest shingles.
4. Light shingles join pairs of sets; a pair goes on when its light matches
   and the heavy shingles it passed over can make up the lower of its levels.
   What is left is verified on whole sets.
5. Two saturated sets may share heavy shingles alone.  Sets joined by a chain
   of heavy shingles are a clump; a clump is cut into blocks by a hash of the
   id, and each pair of blocks is compared in one task, which returns a
   spanning forest of the links that it finds: never all pairs.
6. Links make components.

No row, pair or shingle is dropped unless the bounds above prove that it
makes no link, so the components are exact (up to 64-bit hashes of shingles).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastebud.llm.components import components
from tastebud.llm.rows import among, row_key
from tastebud.llm.scratch import written
from tastebud.llm.words import mixed, shingle_sets

LEVEL_SHARE = 16  # a level is at most a sixteenth of the set, and 8 at least where the set has them
HEAVY = 24
BLOCK = 256
VERIFY_COST = 4.0  # joining one row against verifying one shingle of a candidate


def least_overlap(n, num: int, den: int):
    """Shingles that a set of n shares with any set linked to it."""
    return -(-num * n // den)


def top_level(n):
    return np.maximum(np.minimum(n, 8), -(-n // LEVEL_SHARE))


def pool_length(n, num: int, den: int):
    """Prefix length at the highest level."""
    return np.minimum(n, n - least_overlap(n, num, den) + top_level(n))


def own_level(n, num: int, den: int):
    """Highest level that every possible partner's pool allows too."""
    return top_level(least_overlap(n, num, den))


def choose_level(n: int, pos: np.ndarray, df: np.ndarray, tokens: np.ndarray, num: int, den: int) -> tuple[int, np.ndarray, int]:
    """Level, mask of the shingles that generate candidates, and number of heavy ones passed over.

    ``pos``, ``df`` and ``tokens`` describe the set's shared pool shingles.
    """
    cap = int(own_level(np.int64(n), num, den))
    base = n - int(least_overlap(n, num, den))
    heavy = df >= HEAVY
    best = None
    for level in sorted({1, 2, 3, 4, 6, 8, 12, 16, 24, 32, 48, 64, 96, 128, cap}):
        if level > cap:
            break
        inside = pos < base + level
        if int((heavy & inside).sum()) > level - 1:
            continue
        rows = float(df[inside & ~heavy].sum())
        cost = rows + VERIFY_COST * n * rows / level
        if best is None or cost < best[0]:
            best = (cost, level, inside)
    if best is not None:
        return best[1], best[2] & ~heavy, int((heavy & best[2]).sum())
    keep = np.zeros(len(df), dtype=bool)
    keep[np.lexsort((tokens, df))[: max(0, len(df) - (cap - 1))]] = True
    return cap, keep, int(heavy.sum())


def forest(nodes: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links node -> smallest node that join what the links (x, y), positions in ``nodes``, join."""
    order = np.argsort(nodes, kind="stable")
    place = np.empty(len(nodes), dtype=np.int64)
    place[order] = np.arange(len(nodes))
    x, y = place[x], place[y]
    label = np.arange(len(nodes))
    while len(x):
        low = np.minimum(label[x], label[y])
        before = label.copy()
        np.minimum.at(label, x, low)
        np.minimum.at(label, y, low)
        label = label[label]
        if (label == before).all():
            break
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[order[moved]], nodes[order[label[moved]]]


def block_links(ids: np.ndarray, sides: np.ndarray, sets: list[np.ndarray], num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the links between the sets of side 0 and side 1 (all with all if one side is empty)."""
    left, right = np.flatnonzero(sides == 0), np.flatnonzero(sides == 1)
    if not len(right) or not len(left):
        left = right = np.arange(len(ids))
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    tokens = np.concatenate([sets[k] for k in right])
    owner = np.repeat(np.arange(len(right)), sizes[right])
    order = np.argsort(tokens, kind="stable")
    tokens, owner = tokens[order], owner[order]
    xs, ys = [], []
    for k in left:
        lo, hi = np.searchsorted(tokens, sets[k], "left"), np.searchsorted(tokens, sets[k], "right")
        width = hi - lo
        at = np.repeat(hi - np.cumsum(width), width) + np.arange(int(width.sum()))
        common = np.bincount(owner[at], minlength=len(right))
        hit = den * common >= num * (sizes[k] + sizes[right] - common)
        other = right[np.flatnonzero(hit & (common > 0))]
        other = other[other != k]
        xs.append(np.full(len(other), k))
        ys.append(other)
    return forest(ids, np.concatenate(xs), np.concatenate(ys))


def signatures(docs: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """``(tag, key, doc_id, n, k1, k2, pool)`` of every row: its number, ``row_key`` of id and text, set size, a 128-bit hash of the set, its pool."""

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tag = TaskContext.get().partitionId() << 40
        for whole in batches:
            for lo in range(0, len(whole), 1_000):
                b = whole.iloc[lo : lo + 1_000]
                n, k1, k2, pools = [], [], [], []
                for s in shingle_sets(b["text"].tolist(), width):
                    u = s.view(np.uint64)
                    n.append(len(s))
                    k1.append(int(mixed(u).sum(dtype=np.uint64).view(np.int64)))
                    k2.append(int(mixed(u ^ np.uint64(0x5DEECE66D)).sum(dtype=np.uint64).view(np.int64)))
                    # a copy, so that the pool does not keep the whole set in memory
                    pools.append(s[: int(pool_length(np.int64(len(s)), num, den))].copy())
                yield pd.DataFrame({"tag": np.arange(tag, tag + len(b)), "key": b["key"].to_numpy(), "doc_id": b["doc_id"].to_numpy(), "n": n, "k1": k1, "k2": k2, "pool": pools})
                tag += len(b)

    rows = docs.select(row_key("doc_id", "text").alias("key"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInPandas(sign, "tag long, key string, doc_id long, n long, k1 long, k2 long, pool array<long>")


def generators(live: DataFrame, num: int, den: int) -> DataFrame:
    """``(token, id, n, level, passed, df)``: the shingles by which each set looks for partners."""

    def pick(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            parts = []
            for i, n, pos, df, token in zip(b["id"], b["n"], b["pos"], b["df"], b["token"]):
                pos, df, token = np.asarray(pos), np.asarray(df), np.asarray(token)
                level, keep, passed = choose_level(int(n), pos, df, token, num, den)
                parts.append(pd.DataFrame({"token": token[keep], "id": i, "n": n, "level": level, "passed": passed, "df": df[keep]}))
            if parts:
                yield pd.concat(parts)

    sets = live.groupBy("id", "n").agg(F.collect_list(F.struct("pos", "df", "token")).alias("s")).select("id", "n", F.col("s.pos").alias("pos"), F.col("s.df").alias("df"), F.col("s.token").alias("token"))
    return sets.mapInPandas(pick, "token long, id long, n long, level long, passed long, df long")


def shared_postings(postings: DataFrame, num: int, den: int, name: str) -> DataFrame:
    """Postings of shingles in two or more pools, of the sets that share enough of them (step 2)."""
    counts = postings.groupBy("token").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    met = written(postings.select("token", "id", "n", "pos").join(counts, "token"), f"{name}-met")
    need = F.ceil(F.col("n") * num / F.lit(den))  # least overlap; its top level is what the set must share
    level = F.greatest(F.least(need, F.lit(8)), F.ceil(need / LEVEL_SHARE))
    able = met.groupBy("id").agg(F.count(F.lit(1)).alias("c"), F.min("n").alias("n")).filter(F.col("c") >= level).select("id")
    return met.join(able, "id", "left_semi")


def whole_sets(docs: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """``(id, tokens)``: whole shingle sets of the rows named in ``ids`` (id, key), made again from their texts."""
    texts = among(docs.select("doc_id", "text"), ids, row_key("doc_id", "text")).select("id", F.col("text").cast("string").alias("text")).dropDuplicates(["id", "text"])

    def shingle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in batches:
            for lo in range(0, len(whole), 1_000):
                b = whole.iloc[lo : lo + 1_000]
                yield pd.DataFrame({"id": b["id"].to_numpy(), "tokens": list(shingle_sets(b["text"].tolist(), width))})

    return texts.mapInPandas(shingle, "id long, tokens array<long>")


def light_pairs(gens: DataFrame, num: int, den: int) -> DataFrame:
    """``(a, b)``: pairs that share light shingles enough for the lower of their levels (step 4)."""
    light = gens.filter(F.col("df") < HEAVY)
    a = light.select("token", *[F.col(c).alias(f"{c}_a") for c in ("id", "n", "level", "passed")])
    b = light.select("token", *[F.col(c).alias(f"{c}_b") for c in ("id", "n", "level", "passed")])
    smaller = (F.col("n_a") < F.col("n_b")) | ((F.col("n_a") == F.col("n_b")) & (F.col("id_a") < F.col("id_b")))
    met = a.join(b, "token").filter(smaller & (F.col("n_a") * den >= F.col("n_b") * num))
    same = met.groupBy("id_a", "id_b").agg(F.count(F.lit(1)).alias("c"), *[F.first(x).alias(x) for x in ("level_a", "level_b", "passed_a", "passed_b")])
    enough = F.col("c") + F.least("passed_a", "passed_b") >= F.least("level_a", "level_b")
    return same.filter(enough).select(F.col("id_a").alias("a"), F.col("id_b").alias("b"))


def verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs whose whole sets reach the threshold."""
    left = pairs.join(sets.select(F.col("id").alias("a"), F.col("tokens").alias("ta")), "a")
    both = left.join(sets.select(F.col("id").alias("b"), F.col("tokens").alias("tb")), "b")

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            hit = []
            for x, y in zip(b["ta"], b["tb"]):
                common = len(np.intersect1d(x, y, assume_unique=True))
                hit.append(common > 0 and den * common >= num * (len(x) + len(y) - common))
            yield b.loc[np.array(hit, dtype=bool), ["a", "b"]]

    return both.select("a", "b", "ta", "tb").mapInPandas(check, "a long, b long")


def clump_links(clumps: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Links inside clumps ``(id, clump)``, block by block (step 5), as spanning forests."""
    blocks = clumps.groupBy("clump").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    placed = clumps.join(blocks, "clump").withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    # block i meets every block j >= i once: a set goes to all pairs of blocks that hold its own
    spread = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "id", "clump", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).cast("int").alias("side")
    )
    members = spread.join(sets, "id")

    def compare(key: tuple, b: pd.DataFrame) -> pd.DataFrame:
        x, y = block_links(b["id"].to_numpy(), b["side"].to_numpy(), [np.asarray(t) for t in b["tokens"]], num, den)
        return pd.DataFrame({"a": x, "b": y})

    return members.groupBy("clump", "i", "j").applyInPandas(compare, "a long, b long")


def near_duplicates(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id.

    Linked are texts whose sets of ``width``-word shingles (A-Z lower-cased) have
    ``den * intersection >= num * union``; component_id is the smallest doc_id
    reachable by links, itself included.  A text of fewer words is one shingle
    as a whole.  Null texts and texts without words have no shingles and link
    with nothing.  Repeated rows are copies of each other.  A row with a null
    doc_id links with nothing and its component is null.  Ids should be unique;
    rows that repeat an id with another text go by their own text.  Columns
    other than the two are not read.
    """
    return groups(docs, width, num, den).select("doc_id", "n_shingles", "component_id")


def groups(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``near_duplicates`` with each row's ``key`` (``row_key`` of doc_id and text) and ``group``.

    Rows are of one group exactly if links join them; groups may share a
    component_id where rows repeat an id.  The group is null where the row
    links with nothing by definition.
    """
    sig = written(signatures(docs, width, num, den), "signatures")
    named = sig.select("tag", "key", "doc_id", "n", "k1", "k2").filter("n > 0 and doc_id is not null")
    classes = written(named.groupBy("n", "k1", "k2").agg(F.min(F.struct("doc_id", "tag", "key")).alias("first")).select("n", "k1", "k2", F.col("first.doc_id").alias("doc_id"), F.col("first.tag").alias("tag"), F.col("first.key").alias("key")), "classes")
    copies = written(named.join(classes.select("tag"), "tag", "left_anti").select("tag"), "copies")
    postings = (
        sig.filter("n > 0 and doc_id is not null")
        .join(copies, "tag", "left_anti")
        .select(F.col("tag").alias("id"), "n", F.posexplode("pool").alias("pos", "token"))
    )
    once = shared_postings(postings, num, den, "first")
    live = shared_postings(once.select("token", "id", "n", "pos"), num, den, "second")
    gens = written(generators(live, num, den), "generators")
    pairs = written(light_pairs(gens, num, den), "pairs")
    heavy = gens.filter(F.col("df") >= HEAVY).select("token", "id")
    hubs = heavy.groupBy("token").agg(F.min("id").alias("hub"))
    clumps = components(heavy.join(hubs, "token").select(F.col("id").alias("a"), F.col("hub").alias("b"))).select(F.col("node").alias("id"), F.col("component").alias("clump"))
    wanted = written(pairs.select(F.explode(F.array("a", "b")).alias("id")).union(clumps.select("id")).distinct().join(classes.select(F.col("tag").alias("id"), "key"), "id"), "wanted")
    sets = written(whole_sets(docs, wanted, width), "sets")
    links = verified(pairs, sets, num, den).union(clump_links(clumps, sets, num, den))
    found = components(links).select(F.col("node").alias("tag"), F.col("component").alias("group"))
    joined = written(classes.join(found, "tag", "left").select("n", "k1", "k2", "doc_id", F.coalesce("group", "tag").alias("group"), F.col("group").isNotNull().alias("linked")), "joined")
    low = written(joined.filter("linked").groupBy("group").agg(F.min("doc_id").alias("low")), "low")
    linked = joined.filter("linked").join(low, "group").select("n", "k1", "k2", "group", F.col("low").alias("component"))
    of_class = linked.union(joined.filter("not linked").select("n", "k1", "k2", "group", F.col("doc_id").alias("component")))
    rows = sig.select("key", "doc_id", "n", "k1", "k2").join(of_class, ["n", "k1", "k2"], "left")
    known = F.col("doc_id").isNotNull()
    return rows.select("key", "doc_id", F.col("n").alias("n_shingles"), F.when(known, F.coalesce("component", "doc_id")).alias("component_id"), F.when(known, F.col("group")).alias("group"))
