"""Full dumps side by side, one folder a day and hour, found by the layout and not by the data."""

from __future__ import annotations

import os
from collections.abc import Iterator, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from ..storage import exists, folders

MARKER = "_SUCCESS"


def _order(value: str) -> tuple:
    return (1, int(value), value) if value.isdigit() else (0, 0, value)


def snapshot_folder(root: str, values: Mapping[str, str]) -> str:
    """``root/DAY=2017-03-20/HOUR=05`` for the keys and values, in order."""
    return os.path.join(root, *[f"{k}={v}" for k, v in values.items()])


def write_snapshot(df: DataFrame, root: str, values: Mapping[str, str]) -> str:
    """Write one snapshot; its marker comes with the commit of the write, so a write that fails leaves none."""
    path = snapshot_folder(root, values)
    df.write.mode("overwrite").parquet(path)
    return path


def _newest_first(spark: SparkSession, path: str, keys: Sequence[str], as_of: Sequence[str] | None) -> Iterator[str]:
    if not keys:
        yield path
        return
    prefix = f"{keys[0]}="
    values = sorted((n[len(prefix) :] for n in folders(spark, path) if n.startswith(prefix)), key=_order, reverse=True)
    for value in values:
        if as_of and _order(value) > _order(as_of[0]):
            continue
        # below an equal value the next key is bounded too; below a smaller one it is free
        rest = as_of[1:] if as_of and value == as_of[0] else None
        yield from _newest_first(spark, os.path.join(path, prefix + value), keys[1:], rest)


def newest_complete(spark: SparkSession, root: str, keys: Sequence[str], *, as_of: Sequence[str] | None = None, marker: str = MARKER) -> str | None:
    """Folder of the newest snapshot that has its marker, at or before ``as_of`` (a value for each key, or for the first ones).

    Lists folder names from the newest on and stops at the first that is whole,
    so a half-written snapshot is passed over for the one before it.  Values
    of digits count as numbers, others as text.  None if there is no such one.
    """
    for path in _newest_first(spark, root, keys, as_of):
        if exists(spark, os.path.join(path, marker)):
            return path
    return None


def read_newest(spark: SparkSession, root: str, keys: Sequence[str], *, as_of: Sequence[str] | None = None, marker: str = MARKER) -> DataFrame:
    """The newest complete snapshot, its keys as columns; only its files are read."""
    path = newest_complete(spark, root, keys, as_of=as_of, marker=marker)
    if path is None:
        raise FileNotFoundError(f"no complete snapshot below {root}" + (f" at or before {'/'.join(as_of)}" if as_of else ""))
    return spark.read.option("basePath", root).parquet(path)
