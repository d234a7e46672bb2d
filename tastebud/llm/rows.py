"""Keeping or dropping whole rows of a table by a key, without shuffling the rows that are not concerned."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A filter of keys: blocks of WORDS 64-bit words, one row each, 1 MiB of bits in all, however many keys there are.
BLOCKS, WORDS = 1 << 15, 4


def row_key(*cols: str) -> Column:
    """128 bits of the named columns' values, never null; which of them are null counts too."""
    values = [*cols, *[F.col(c).isNull() for c in cols]]
    return F.concat_ws(":", F.hex(F.xxhash64(*values)), F.hex(F.xxhash64(F.lit("second"), *values)))


def packed(df: DataFrame, key: Column) -> DataFrame:
    """``row``, the whole row as a struct, and its ``key``: no name of the table meets a helper's."""
    return df.select(F.struct("*").alias("row"), key.alias("key"))


def _place(key: Column) -> tuple[Column, Column, Column]:
    """Where a key's bit lies in the filter: the block, the word in it, the word's value with that bit alone."""
    h = F.xxhash64(key)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, 32).bitwiseAND(F.lit(63)).cast("int"))
    return F.pmod(h, F.lit(BLOCKS)).cast("int"), F.shiftrightunsigned(h, 40).bitwiseAND(F.lit(WORDS - 1)), bit


def key_filter(keys: DataFrame) -> DataFrame:
    """``(_block, _w0, ...)``: one bit a key (column ``key``), ``BLOCKS`` rows at most, so the driver holds as little of many keys as of few."""
    block, word, bit = _place(F.col("key"))
    return keys.groupBy(block.alias("_block")).agg(*[F.bit_or(F.when(word == w, bit).otherwise(F.lit(0).cast("long"))).alias(f"_w{w}") for w in range(WORDS)])


def maybe(own: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """The rows of ``own`` (column ``key``) whose key may be in ``keys`` (``how`` left_semi), or is surely not (left_anti)."""
    block, word, bit = _place(own["key"])
    bits = F.broadcast(key_filter(keys))
    held = bits[f"_w{WORDS - 1}"]
    for w in range(WORDS - 1):
        held = F.when(word == w, bits[f"_w{w}"]).otherwise(held)
    return own.join(bits, (block == bits["_block"]) & (held.bitwiseAND(bit) != 0), how)


def without(df: DataFrame, keys: DataFrame, key: Column) -> DataFrame:
    """The rows of ``df`` whose ``key`` is not in ``keys`` (column ``key``); repeated rows stay repeated.

    A filter of bounded size is broadcast; rows that it stops go out as they
    are, and only the others meet the exact anti join.
    """
    own = packed(df, key)
    rest = maybe(own, keys, "left_semi").join(keys.select("key"), "key", "left_anti")
    return maybe(own, keys, "left_anti").select("row.*").unionByName(rest.select("row.*"))


def among(df: DataFrame, keys: DataFrame, key: Column) -> DataFrame:
    """The rows of ``df`` whose ``key`` is in ``keys`` (column ``key``, each once), with the columns of ``keys``."""
    return maybe(df.withColumn("key", key), keys, "left_semi").join(keys, "key")


def packed_among(df: DataFrame, keys: DataFrame, key: Column) -> DataFrame:
    """The rows of ``df`` whose ``key`` is in ``keys`` (column ``key``, each once), packed as ``row``, with the columns of ``keys``."""
    return maybe(packed(df, key), keys, "left_semi").join(keys, "key")


def bounded_sample(rows: DataFrame, group: str, key: str, n: int) -> DataFrame:
    """At most ``n`` rows of each ``group``, those of the smallest hashes of ``key``; adds their rank ``r`` and the group's count ``n``.

    Groups are few (labels, languages): one row each is broadcast.  A threshold
    on the hash lets about 1.2 n rows of a group through, and only these are
    ranked, so no task holds a group as a whole.
    """
    place = F.pmod(F.xxhash64(key), F.lit(1 << 30))
    counts = rows.groupBy(group).agg(F.count(F.lit(1)).alias("n"))
    near = rows.join(F.broadcast(counts), group).filter(place < F.least(F.lit(1.0), F.lit(1.2 * n) / F.col("n")) * (1 << 30))
    order = Window.partitionBy(group).orderBy(place, key)
    return near.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= n)
