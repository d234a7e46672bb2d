"""Near-duplicate vectors by product quantisation.

Vectors are scaled to length 1, so a cosine of at least t means a distance of
at most ``reach = sqrt(2 - 2 t)``.

* Inverted lists: k-means centres fitted on a bounded sample; every vector is
  put into the list of its nearest centre.
* Residual codes: the difference to the centre is cut into ``PARTS`` subspaces
  and each part named by its nearest of 256 codewords.  The length of what the
  code misses is kept with it.
* Sufficient probes: take a link between y, of list b, and x, of list c.  Both are
  on their own side of the plane between the two centres, and their distances to
  it add up to their distance along its normal, at most ``reach``.  So one of the
  two is within ``reach / 2`` of the plane, and each vector searches the lists
  whose plane is that near: every link is found, from one end at least.  An end
  that does not search the other's list is counted by the end that found it.
* Table lookups: distances from y's residual to all codewords make a table; a
  code's distance is a sum of ``PARTS`` entries.  It differs from the true one
  by at most what the code misses, so codes farther than ``reach`` plus that
  are no links.
* The rest is settled by the cosine of the vectors in double precision.

Equal vectors are one entry with a weight.  Lists are dealt into ``groups`` of
about equal many entries, and a vector goes once to each group that holds a
list it searches, whichever lists these are, packed with the others of its
batch.  A group's entries meet the seeking vectors part by part, as many parts
as groups; such a meeting returns counts and a spanning forest of its links,
never pairs.  So a vector is shuffled about twice as often as there are groups,
and not once for each of the lists it searches.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastebud.llm.components import components
from tastebud.llm.jaccard import forest
from tastebud.llm.scratch import written
from tastebud.operators.skew import salted_join

#: Vectors that centres and codewords are fitted on at most: the fit's documented bound.
SAMPLE = 20_000
LIST_SIZE = 200  # vectors a list, as far as MAX_LISTS goes
MAX_LISTS = 4_096
PARTS = 8
CODES = 256
#: Vectors that a task compares at once from either side.
BLOCK = 1_024
#: Entries of a group; groups at least, so that their square fills the tasks.
GROUP, MIN_GROUPS = 1 << 17, 6
#: Vectors of a packed row.
PACK = 500
_SLACK = 1e-6  # for rounding, in distances


def kmeans(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Centres by Lloyd's iterations from evenly spaced rows of ``x``; an empty centre moves to a far row."""
    centres = x[np.linspace(0, len(x) - 1, k).astype(np.int64)].copy()
    for _ in range(rounds):
        near, least = nearest(x, centres)
        n = np.bincount(near, minlength=k)
        order = np.argsort(near, kind="stable")
        filled = np.flatnonzero(n)
        sums = np.add.reduceat(x[order], (np.cumsum(n) - n)[filled], axis=0)
        centres[filled] = sums / n[filled, None]
        empty = np.flatnonzero(n == 0)
        if len(empty):
            centres[empty] = x[np.argsort(-least, kind="stable")[: len(empty)]]
    return centres


def nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centre of every row and the squared distance to it, some rows at a time."""
    near, least = np.empty(len(x), np.int64), np.empty(len(x))
    step = max(1, 2_000_000 // len(centres))
    for lo in range(0, len(x), step):
        d = squared(x[lo : lo + step], centres)
        near[lo : lo + step] = own = d.argmin(axis=1)
        least[lo : lo + step] = d[np.arange(len(d)), own]
    return near, least


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None, :] - 2 * x @ y.T, 0.0)


@dataclass
class Quantiser:
    reach: float
    cuts: list[int]  # where the subspaces start, and the dimension
    centres: np.ndarray
    codebooks: list[np.ndarray]

    @classmethod
    def fit(cls, unit: np.ndarray, total: int, threshold: float) -> Quantiser:
        lists = int(min(MAX_LISTS, max(1, total // LIST_SIZE), len(unit)))
        centres = kmeans(unit, lists)
        rest = unit - centres[nearest(unit, centres)[0]]
        cuts = [round(unit.shape[1] * i / PARTS) for i in range(PARTS + 1)]
        books = [kmeans(np.ascontiguousarray(rest[:, a:b]), min(CODES, len(unit)), 8) for a, b in zip(cuts, cuts[1:]) if b > a]
        return cls(float(np.sqrt(2 - 2 * threshold)), sorted(set(cuts)), centres, books)

    def apart(self) -> np.ndarray:
        """Distances between the centres."""
        return np.sqrt(squared(self.centres, self.centres))

    def encode(self, unit: np.ndarray, apart: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
        """List, codes, what the codes miss, and the lists to search, of each vector."""
        d = squared(unit, self.centres)
        near = d.argmin(axis=1)
        rest = unit - self.centres[near]
        codes = np.empty((len(unit), len(self.codebooks)), dtype=np.uint8)
        miss = np.zeros(len(unit))
        for p, (a, b, book) in enumerate(zip(self.cuts, self.cuts[1:], self.codebooks)):
            part = squared(rest[:, a:b], book)
            codes[:, p] = part.argmin(axis=1)
            miss += ((rest[:, a:b] - book[codes[:, p]]) ** 2).sum(axis=1)
        plane = (d - d[np.arange(len(unit)), near][:, None]) / np.maximum(2 * apart[near], 1e-12)
        probes = [np.flatnonzero(row <= self.reach / 2 + _SLACK) for row in plane]
        return near, codes, np.sqrt(miss), probes

    def lookups(self, unit: np.ndarray, centre: int, codes: np.ndarray) -> np.ndarray:
        """Distances from whole vectors to the coded vectors of one list, by tables."""
        rest = unit - self.centres[centre]
        out = np.zeros((len(unit), len(codes)))
        for p, (a, b, book) in enumerate(zip(self.cuts, self.cuts[1:], self.codebooks)):
            out += squared(rest[:, a:b], book)[:, codes[:, p]]
        return np.sqrt(out)


def stacked(vectors: pd.Series, dim: int) -> np.ndarray:
    """Vectors as rows of ``dim`` numbers, shorter ones filled up with zeros."""
    out = np.zeros((len(vectors), dim))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def units(x: np.ndarray) -> np.ndarray:
    big = np.abs(x).max(axis=1, keepdims=True)  # first, so that squares neither overflow nor vanish
    x = x / big
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


#: Columns of a packed row of entries; a seeking vector has all but codes and miss, and of its probes those of the group.
_FIELDS = ("ids", "weight", "data", "home", "codes", "miss", "n_probes", "probes")
_PACKED = "n int, " + ", ".join(f"{c} binary" for c in _FIELDS)
_TYPES = {"ids": np.int64, "weight": np.int64, "home": np.int32, "miss": np.float64, "n_probes": np.int32, "probes": np.uint16}


@dataclass
class Side:
    """Vectors of one side of a meeting; ``probes`` of vector i are those from ``first[i]`` to ``first[i + 1]``, ascending."""

    ids: np.ndarray
    weight: np.ndarray
    data: np.ndarray
    home: np.ndarray
    codes: np.ndarray
    miss: np.ndarray
    n_probes: np.ndarray
    probes: np.ndarray

    @classmethod
    def unpacked(cls, rows: pd.DataFrame, dim: int, real: str) -> Side:
        flat = {c: np.frombuffer(b"".join(rows[c]), _TYPES.get(c, np.uint8)) for c in _FIELDS if c != "data"}
        data = np.frombuffer(b"".join(rows["data"]), real).reshape(-1, dim)
        return cls(**flat | {"data": data, "codes": flat["codes"].reshape(len(flat["miss"]), -1) if len(flat["miss"]) else flat["codes"].reshape(0, 1)})

    @property
    def first(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(self.n_probes)])

    def packed(self, at: np.ndarray, probes: np.ndarray, n_probes: np.ndarray, entry: bool) -> dict:
        """The vectors ``at`` as one row, with the given probes."""
        row = {"n": len(at), "ids": self.ids[at], "weight": self.weight[at], "data": self.data[at], "home": self.home[at], "n_probes": n_probes.astype(np.int32), "probes": probes}
        row |= {"codes": self.codes[at], "miss": self.miss[at]} if entry else {"codes": np.zeros(0, np.uint8), "miss": np.zeros(0)}
        return {k: v if k == "n" else v.tobytes() for k, v in row.items()}


def groups_of_lists(counts: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each list the first group that holds its entries, and how many do; a list longer than a group is in several."""
    size = max(1, -(-int(counts.sum()) // groups))
    before = np.cumsum(counts) - counts
    first = np.minimum(before // size, groups - 1)
    last = np.minimum(np.maximum(before + counts - 1, 0) // size, groups - 1)
    # a list of less than a group stays whole
    last = np.where(counts <= size, first, np.maximum(first, last))
    return first, last - first + 1


def deal(side: Side, first: np.ndarray, span: np.ndarray, groups: int) -> Iterator[tuple[int, bool, dict]]:
    """Packed rows by group: its own entries, and the vectors that search a list of it with their probes there."""
    turn = (side.ids * 2_654_435_761 >> 7) % span[side.home]  # any fixed spread over the groups of one list
    own = first[side.home] + turn
    starts = side.first
    owner = np.repeat(np.arange(len(side.ids)), side.n_probes)
    low, high = first[side.probes], first[side.probes] + span[side.probes] - 1
    for g in range(groups):
        at = np.flatnonzero(own == g)
        if len(at):
            marks = np.zeros(len(side.ids), dtype=bool)
            marks[at] = True
            yield g, False, side.packed(at, side.probes[marks[owner]], side.n_probes[at], True)
        there = np.flatnonzero((low <= g) & (g <= high))
        if len(there):
            n = np.bincount(owner[there], minlength=len(starts) - 1)
            at = np.flatnonzero(n)
            yield g, True, side.packed(at, side.probes[there], n[at], False)


def link_counts(q: Quantiser, threshold: float, own: Side, ask: Side) -> tuple[np.ndarray, np.ndarray, tuple[np.ndarray, np.ndarray]]:
    """Links between a group's entries and the vectors that search its lists, as weights to count, and a spanning forest.

    Of each seeking vector, the weight of the entries linked to it; of each entry,
    the weight of the seeking vectors linked to it whose lists it does not search.
    """
    n = len(q.centres)
    by_list = np.argsort(own.home, kind="stable")
    lists, starts = np.unique(own.home[by_list], return_index=True)
    asked = np.argsort(ask.probes, kind="stable")
    askers, wanted = np.repeat(np.arange(len(ask.ids)), ask.n_probes)[asked], ask.probes[asked]
    first = own.first
    found, back = np.zeros(len(ask.ids), np.int64), np.zeros(len(own.ids), np.int64)
    nodes, ups = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for centre, start, end in zip(lists, starts, [*starts[1:], len(by_list)]):
        seekers = askers[np.searchsorted(wanted, centre, "left") : np.searchsorted(wanted, centre, "right")]
        for a in range(start, end if len(seekers) else start, BLOCK):
            held = by_list[a : min(a + BLOCK, end)]
            codes, miss, ids, weight, vectors = own.codes[held], own.miss[held], own.ids[held], own.weight[held], units(own.data[held].astype(np.float64))
            # pairs (entry, list that it searches) as sorted numbers; an entry always searches its own list
            searched = np.concatenate([k * n + own.probes[first[h] : first[h + 1]].astype(np.int64) for k, h in enumerate(held)])
            for b in range(0, len(seekers), BLOCK):
                who = seekers[b : b + BLOCK]
                x = units(ask.data[who].astype(np.float64))
                maybe = q.lookups(x, int(centre), codes) <= q.reach + miss[None, :] + _SLACK
                s, e = np.nonzero(maybe & (ask.ids[who][:, None] != ids[None, :]))
                keep = np.zeros(len(s), dtype=bool)
                for lo in range(0, len(s), 1 << 16):
                    keep[lo : lo + (1 << 16)] = np.einsum("ij,ij->i", x[s[lo : lo + (1 << 16)]], vectors[e[lo : lo + (1 << 16)]]) >= threshold
                s, e = s[keep], e[keep]
                if not len(s):
                    continue
                found[who] += np.bincount(s, weights=weight[e], minlength=len(who)).astype(np.int64)
                pair = e * n + ask.home[who][s]
                one_way = searched[np.minimum(np.searchsorted(searched, pair), len(searched) - 1)] != pair
                back[held] += np.bincount(e[one_way], weights=ask.weight[who][s[one_way]], minlength=len(held)).astype(np.int64)
                names, place = np.unique(np.concatenate([ask.ids[who], ids]), return_inverse=True)
                node, up = forest(names, place[s], place[len(who) + e])
                nodes.append(node)
                ups.append(up)
    node, up = np.concatenate(nodes), np.concatenate(ups)
    names, place = np.unique(np.concatenate([node, up]), return_inverse=True)
    return found, back, forest(names, place[: len(node)], place[len(node) :])


def near_vectors(vectors: DataFrame, threshold: float = 0.95, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id, kept.

    Links join rows whose cosine is at least ``threshold``; equal vectors are
    linked.  A vector that is null, empty, zero or holds a null or non-finite
    component links with nothing, and so does a row with a null id, whose
    component is null.  Shorter vectors count as filled up with zeros.  A
    repeated id counts as another vector where its row is another row.  Other
    columns are not read.
    """
    spark = vectors.sparkSession
    v = F.col("v")
    # single precision travels as such
    real = "float" if dict(vectors.dtypes)[vec_col] == "array<float>" else "double"
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    fine = F.coalesce(
        (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0), F.lit(False)
    )
    rows = rows.withColumn("fine", fine & F.col("id").isNotNull())
    rows = rows.withColumns({"k1": F.xxhash64("v"), "k2": F.xxhash64(F.lit("second"), "v"), "v": v.cast(f"array<{real}>")})
    # an entry is a vector, whichever ids hold it; its number stands for it until the end
    alike = rows.filter("fine").groupBy("k1", "k2").agg(F.min("id").alias("low"), F.count(F.lit(1)).alias("weight"), F.first("v").alias("v"))
    entries = written(alike.withColumn("id", F.monotonically_increasing_id()), "entries")
    sample = entries.orderBy("k1", "k2").limit(SAMPLE).select("v").toPandas()
    whole = rows.select("id", "k1", "k2", "fine")
    if not len(sample):
        return whole.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.col("id").isNotNull().alias("kept"))
    size = entries.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("dim")).first()
    dim = size["dim"]
    quantiser = Quantiser.fit(units(stacked(sample["v"], dim)), size["n"], threshold)
    state = spark.sparkContext.broadcast(vars(quantiser))

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        q = Quantiser(**state.value)
        apart, step = q.apart(), max(64, min(PACK, 1_000_000 // len(q.centres)))
        for b in batches:
            for lo in range(0, len(b), step):
                part = b.iloc[lo : lo + step]
                x = stacked(part["v"], dim)
                near, codes, miss, probes = q.encode(units(x), apart)
                n_probes = np.array([len(p) for p in probes], dtype=np.int32)
                side = Side(part["id"].to_numpy(np.int64), part["weight"].to_numpy(np.int64), x.astype(real), near.astype(np.int32), codes, miss, n_probes, np.concatenate(probes).astype(np.uint16))
                yield pd.DataFrame([side.packed(np.arange(len(part)), side.probes, n_probes, True)])

    coded = written(entries.select("id", "weight", "v").mapInPandas(encode, _PACKED), "coded")

    def tally(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = np.zeros(MAX_LISTS, np.int64)
        for b in batches:
            for home in b["home"]:
                n += np.bincount(np.frombuffer(home, np.int32), minlength=MAX_LISTS)
        yield pd.DataFrame({"list": np.flatnonzero(n), "n": n[n > 0]})

    in_list = np.zeros(len(quantiser.centres), np.int64)
    for r in coded.select("home").mapInPandas(tally, "list long, n long").groupBy("list").agg(F.sum("n").alias("n")).collect():
        in_list[r["list"]] = r["n"]
    groups = max(MIN_GROUPS, -(-size["n"] // GROUP))
    first, span = groups_of_lists(in_list, groups)

    def dealt(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in range(len(b)):
                for g, seeks, row in deal(Side.unpacked(b.iloc[r : r + 1], dim, real), first, span, groups):
                    yield pd.DataFrame([row | {"g": g, "seeks": seeks}])

    sides = coded.mapInPandas(dealt, f"g int, seeks boolean, {_PACKED}")
    # a group's entries meet every part of the vectors that search it
    part = F.when(F.col("seeks"), F.array(F.pmod(F.xxhash64("ids"), F.lit(groups)).cast("int"))).otherwise(F.array(*[F.lit(j) for j in range(groups)]))
    met = sides.withColumn("j", F.explode(part))

    def search(key: tuple, b: pd.DataFrame) -> pd.DataFrame:
        q = Quantiser(**state.value)
        seeks = b["seeks"].to_numpy(bool)
        if seeks.all() or not seeks.any():
            return pd.DataFrame({"id": [], "links": [], "up": []}).astype({"id": "int64", "links": "int64", "up": "int64"})
        own, ask = Side.unpacked(b[~seeks], dim, real), Side.unpacked(b[seeks], dim, real)
        found, back, (node, up) = link_counts(q, threshold, own, ask)
        seek_ids, ids = ask.ids[found > 0], own.ids[back > 0]
        return pd.DataFrame(
            {
                "id": np.concatenate([seek_ids, ids, node]),
                "links": np.concatenate([found[found > 0], back[back > 0], np.zeros(len(node), np.int64)]),
                "up": np.concatenate([seek_ids, ids, up]),
            }
        )

    out = written(met.groupBy("g", "j").applyInPandas(search, "id long, links long, up long"), "links")
    counts = out.groupBy("id").agg(F.sum("links").alias("links"))
    found = components(out.filter("id <> up").select(F.col("id").alias("a"), F.col("up").alias("b"))).select(F.col("node").alias("id"), "component")
    known = written(
        entries.select("k1", "k2", "id", "low", "weight").join(counts, "id", "left").join(found, "id", "left").withColumn("component", F.coalesce("component", "id")), "labelled"
    )
    # the smallest id of a component, where it has several entries
    lowest = known.groupBy("component").agg(F.min("low").alias("least"), F.count(F.lit(1)).alias("entries")).filter("entries > 1").drop("entries")
    of_entry = salted_join(known, lowest, ["component"], ["id"], how="left").select(
        "k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n"), F.coalesce("least", "low").alias("c"), F.lit(True).alias("fine")
    )
    return whole.join(of_entry, ["k1", "k2", "fine"], "left").select(
        F.col("id").alias(id_col),
        F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("c", "id").alias("component_id"),
        (F.col("id") == F.coalesce("c", "id")).alias("kept"),
    )
