"""What each filter of a set does in every order in which the filters could run.

Documents are counted once into cells: part (a source, say) and the set of
filters that the document fails, as bits of a mask.  From then on only cells
count, at most 2**k of them a part.  A part's cells are walked through all 2**k
sets of active filters in Gray-code order, one filter switched at a time: a
cell's counter of active failures goes up or down by one where the switched
filter is in its mask, and the running survivors change by the cells whose
counter leaves or reaches zero.  The survivors of all 2**k sets are kept, and a
step of any order is the difference of two of them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import permutations
from math import factorial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastebud.operators.skew import salted_join

#: Beyond this many filters the orders alone (k!) would be the larger table.
MAX_FILTERS = 8
#: Words are runs of anything but these characters: fixed values.
WORD = r"[^\x20\x09-\x0D]+"
#: Parts that the rows of one text are spread over where they meet the text's first id.
COPY_PARTS = 16


def words(text: Column) -> Column:
    """The words of a text, in order."""
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def content_failures(text: Column) -> dict[str, Column]:
    """Filters A to D on one text: few words, few distinct words, capitals, marks."""
    found = words(text)
    n = F.size(found)
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]", ""))
    return {
        "A": n < 50,
        "B": F.size(F.array_distinct(found)) * 100 < n * 65,
        "C": capitals * 100 > F.length(text) * 5,
        "D": text.rlike("[#$%&*|]"),
    }


def mark_copies(rows: DataFrame, id_col: str, keys: Sequence[str], name: str) -> DataFrame:
    """Add ``name``: another row of equal ``keys`` has a smaller ``id_col``.

    Rows without an id neither fail nor stand before others; rows that repeat
    the smallest id do not fail.  Only keys held by several rows are joined, a
    hot key's rows in ``COPY_PARTS`` parts, each of which adaptive execution may
    split again.
    """
    firsts = rows.groupBy(*keys).agg(F.min(id_col).alias("_first"), F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n")
    joined = salted_join(rows, firsts, keys, [id_col], how="left", salts=COPY_PARTS)
    return joined.withColumn(name, F.coalesce(F.col(id_col) > F.col("_first"), F.lit(False))).drop("_first")


def failure_mask(failures: Mapping[str, Column]) -> Column:
    """Bit i is set where filter i fails; a failure that is null counts as passed."""
    mask = F.lit(0)
    for i, failed in enumerate(failures.values()):
        mask = mask.bitwiseOR(F.when(failed, F.lit(1 << i)).otherwise(0))
    return mask


def cells(rows: DataFrame, count: str, measures: Mapping[str, Column]) -> DataFrame:
    """Sums per ``part`` and ``mask``: of ``count``, and of it over the rows where each measure holds (null: it does not)."""
    sums = [F.sum(F.when(c, F.col(count)).otherwise(0)).alias(m) for m, c in measures.items()]
    return rows.groupBy("part", "mask").agg(F.sum(count).alias(count), *sums)


def gray_walk(masks: np.ndarray, values: np.ndarray, k: int) -> np.ndarray:
    """Survivors' sums for each of the 2**k sets of active filters.

    ``masks`` are the cells' failure masks, ``values`` (cells, measures) their
    sums; entry S of the result holds what passes all filters in S.
    """
    state = np.zeros((1 << k, values.shape[1]), dtype=np.int64)
    running = values.sum(axis=0)
    active = np.zeros(len(masks), dtype=np.int64)  # per cell: active filters that it fails
    state[0] = running
    seen = 0
    for step in range(1, 1 << k):
        code = step ^ (step >> 1)
        switched = code ^ seen
        fails = (masks & switched) != 0
        if code & switched:  # switched on: cells that survived until now go
            running = running - values[fails & (active == 0)].sum(axis=0)
            active[fails] += 1
        else:  # switched off: cells with no failure left come back
            active[fails] -= 1
            running = running + values[fails & (active == 0)].sum(axis=0)
        state[code] = running
        seen = code
    return state


def order_report(names: Sequence[str], masks: np.ndarray, values: np.ndarray) -> list[tuple]:
    """Rows (filter_order, step, kept, removed, redundant, unique_fails, shapley, lost...) of one part; column 0 of ``values`` counts documents."""
    k = len(names)
    state = gray_walk(masks, values, k)
    everything = (1 << k) - 1
    failing = [int(values[(masks >> i) & 1 == 1, 0].sum()) for i in range(k)]
    unique = [int(state[everything ^ (1 << i), 0] - state[everything, 0]) for i in range(k)]
    shapley = [0] * k
    for before in range(1 << k):
        done = bin(before).count("1")
        for i in range(k):
            if not before >> i & 1:  # orders in which exactly the filters of ``before`` come earlier
                shapley[i] += factorial(done) * factorial(k - done - 1) * int(state[before, 0] - state[before | 1 << i, 0])
    out = []
    for order in permutations(range(k)):
        name, on = "".join(names[i] for i in order), 0
        for step, i in enumerate(order, 1):
            gone = state[on] - state[on | 1 << i]
            on |= 1 << i
            out.append((name, step, int(state[on, 0]), int(gone[0]), failing[i] - int(gone[0]), unique[i], shapley[i], *map(int, gone[1:])))
    return out


def walk_orders(counted: DataFrame, names: Sequence[str], lost: Mapping[str, str], count: str = "documents") -> DataFrame:
    """One row per part, order of the filters and step.

    ``counted`` is what ``cells`` returns; ``count`` is its column of documents
    and ``lost`` names further measures and the column that says how much of
    each goes at a step.  Columns: part, filter_order, step, kept, removed,
    redundant (fail this filter, but went earlier), unique_fails (fail this
    filter alone), shapley (removed by this filter, summed over all orders),
    and one for each of ``lost``.  Parts without rows have none, so an empty
    table gives no row.  A task holds a part's cells, at most 2**k.
    """
    if not 1 <= len(names) <= MAX_FILTERS or len(set(names)) != len(names):
        raise ValueError(f"1 to {MAX_FILTERS} filters of different names")
    kind = dict(counted.dtypes)["part"]
    wanted, columns = [count, *lost], ["filter_order", "step", "kept", "removed", "redundant", "unique_fails", "shapley", *lost.values()]

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = order_report(names, pdf["mask"].to_numpy(np.int64), pdf[wanted].to_numpy(np.int64))
        out = pd.DataFrame(rows, columns=columns)
        out.insert(0, "part", pdf["part"].iloc[0])
        return out

    longs = ", ".join(f"{c} long" for c in columns[2:])
    return counted.groupBy("part").applyInPandas(walk, f"part {kind}, filter_order string, step int, {longs}")


def audit_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The five filters A to E on whole documents, per source: part, filter_order, step and counts (see ``walk_orders``).

    A to D look at the text (null: empty), E fails a text that a smaller doc_id
    of the table holds too, removed or not.  A null source is the part ''.  A
    document counts as good or toxic where any label row of its doc_id says so;
    rows without a doc_id have no label.  Repeated rows count each.  Columns
    other than doc_id, text and source are not read.

    Texts do not travel: a row goes on as its source, id, four flags and 128
    bits of its text.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    flags = content_failures(F.col("_text"))
    rows = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), text.alias("_text")).select(
        "doc_id", "part", F.xxhash64("_text").alias("_h1"), F.xxhash64(F.lit("second"), F.col("_text")).alias("_h2"), *[c.alias(n) for n, c in flags.items()]
    )
    marked = mark_copies(rows, "doc_id", ["_h1", "_h2"], "E")
    names = [*flags, "E"]
    # an id that many rows share, or lack, is a few rows before it meets the labels
    alike = marked.select("doc_id", "part", failure_mask({n: F.col(n) for n in names}).alias("mask")).groupBy("doc_id", "part", "mask").agg(F.count(F.lit(1)).alias("documents"))
    known = labels.filter("doc_id is not null").groupBy("doc_id").agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    counted = cells(alike.join(known, "doc_id", "left"), "documents", {"good": F.col("good"), "toxic": F.col("toxic")})
    return walk_orders(counted, names, {"good": "good_lost", "toxic": "toxic_lost"})
