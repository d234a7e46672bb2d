"""Counting of co-ratings by short codes, before any of them becomes a row."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import columns as C
from ..session import cut_lineage

# functions that run inside tasks travel with the job
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Read inside tasks: a name, as the module that holds it need not be there.
USER = C.USER_ID
#: Values of a code: two bytes.
CODES = 65_536
#: Codes that a task counts at a time, and codes of one item beyond which all of it passes uncounted: so many on so few values are frequent anyway.
COUNTED, PASSED = 2_000_000, 8_000_000


def place_code(place: Column) -> Column:
    return (F.pmod(place, F.lit(CODES)) - CODES // 2).cast("smallint")


def frequent_codes(batches: Iterator[pa.RecordBatch], at_least: int) -> Iterator[pa.RecordBatch]:
    """Rows (USER_ID, _i, _codes), sorted by _i -> the distinct (USER_ID, _i, _code) whose (_i, _code) occurs ``at_least`` times."""

    def hits(rows: pa.Table, counted: bool = True) -> Iterator[pa.RecordBatch]:
        lists = rows.column("_codes").combine_chunks()
        lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
        codes, item = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), rows.column("_i").to_numpy()
        row = np.repeat(np.arange(len(item)), lists.value_lengths().to_numpy(zero_copy_only=False))
        key = np.cumsum(np.r_[0, item[1:] != item[:-1]])[row] * CODES + codes + CODES // 2
        if counted:
            ordered = np.sort(key)
            often = np.unique(ordered[at_least - 1 :][ordered[at_least - 1 :] == ordered[: len(ordered) - at_least + 1]])
            if not len(often):
                return
            kept = often[np.minimum(np.searchsorted(often, key), len(often) - 1)] == key
            row, codes, key = row[kept], codes[kept], key[kept]
        # a rating that the table repeats meets once
        user = rows.column(USER).combine_chunks().dictionary_encode()
        user = (user.chunk(0) if isinstance(user, pa.ChunkedArray) else user).indices.to_numpy(zero_copy_only=False)[row]
        order = np.lexsort((user, key))
        first = np.r_[True, (key[order][1:] != key[order][:-1]) | (user[order][1:] != user[order][:-1])]
        taken = order[first]
        for a in range(0, len(taken), 1_000_000):
            t = taken[a : a + 1_000_000]
            users = rows.column(USER).take(pa.array(row[t])).combine_chunks()
            users = users.chunk(0) if isinstance(users, pa.ChunkedArray) else users
            yield pa.RecordBatch.from_arrays([users, pa.array(item[row[t]]), pa.array(codes[t].astype(np.int16))], [USER, "_i", "_code"])

    held, n, most, passing = [], 0, COUNTED, None
    for batch in batches:
        held.append(batch)
        n += int(np.asarray(batch.column("_codes").value_lengths()).sum())
        if n < most:
            continue
        rows = pa.Table.from_batches(held)
        item = rows.column("_i").to_numpy()
        # whole items only: the last one may go on in the next batch
        whole = int(np.searchsorted(item, item[-1]))
        if whole:
            going = int(np.searchsorted(item, passing, side="right")) if passing is not None else 0
            yield from hits(rows.slice(0, going), counted=False) if going else ()
            yield from hits(rows.slice(going, whole - going)) if whole > going else ()
            rows, passing = rows.slice(whole), None
        held = rows.to_batches()
        n = sum(int(np.asarray(b.column("_codes").value_lengths()).sum()) for b in held)
        if n >= PASSED or passing is not None:
            passing = item[-1]
            yield from hits(rows, counted=False)
            held, n = [], 0
        most = n + COUNTED
    if n:
        rows = pa.Table.from_batches(held)
        going = int(np.searchsorted(rows.column("_i").to_numpy(), passing, side="right")) if passing is not None else 0
        yield from hits(rows.slice(0, going), counted=False) if going else ()
        yield from hits(rows.slice(going)) if going < len(rows) else ()


def often_met(placed: DataFrame, at_least: int, parts: int) -> DataFrame:
    """Who meets whom in ``placed`` (USER_ID, _place, _blocks), for places met ``at_least`` times: USER_ID, _i, _code; written.

    Places number the items from the most rated on.  A rating's row carries the
    codes (place mod ``CODES``) of the user's items of smaller place, two bytes
    each, to its item, where equal codes are counted.  So a pair's co-raters are
    counted at the item with fewer raters, and the ``CODES`` most rated items
    have codes of their own; a code that others share only counts too much.  A
    user of several blocks joins them by (user, a, b), at most a block's square
    of pairs a task.
    """
    home = F.pmod(F.xxhash64("_place"), F.col("_blocks")).cast("int")
    baskets = placed.groupBy(C.USER_ID, "_blocks", home.alias("_a")).agg(F.sort_array(F.collect_list("_place")).alias("_held"))
    light = baskets.filter("_blocks = 1").withColumn("_codes", F.transform("_held", place_code)).select(C.USER_ID, "_codes", F.posexplode("_held").alias("_p", "_i"))
    lists = light.filter("_p > 0").select(C.USER_ID, "_i", F.slice("_codes", F.lit(1), F.col("_p")).alias("_codes"))
    if (placed.agg(F.max("_blocks")).first()[0] or 0) > 1:
        key, every = [C.USER_ID, "_a", "_b"], F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))
        heavy = baskets.filter("_blocks > 1")
        left = heavy.select(C.USER_ID, "_held", "_a", every.alias("_b")).repartition(parts, *key)
        right = heavy.select(C.USER_ID, F.col("_held").alias("_other"), every.alias("_a"), F.col("_a").alias("_b")).repartition(parts, *key)
        met = left.join(right, key).select(C.USER_ID, "_other", F.explode("_held").alias("_i"))
        codes = F.transform(F.filter("_other", lambda x: x < F.col("_i")), place_code)
        lists = lists.unionByName(met.select(C.USER_ID, "_i", codes.alias("_codes")).filter(F.size("_codes") > 0))
    kind = placed.schema[C.USER_ID].dataType.simpleString()
    dealt = lists.repartition(parts, "_i").sortWithinPartitions("_i")
    return cut_lineage(dealt.mapInArrow(lambda batches: frequent_codes(batches, at_least), f"{C.USER_ID} {kind}, _i long, _code smallint"), "often-met")
