"""Scans: behaviour-log reads, latest snapshot, read-back of written products."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sinks import NO_ELEMENTS, unescaped


def scan_log(
    spark: SparkSession,
    path: str | Sequence[str],
    *,
    fmt: str = "parquet",
    schema: T.StructType | None = None,
    columns: Sequence[str] | None = None,
    time_col: str | None = None,
    since: datetime | str | None = None,
    until: datetime | str | None = None,
    partition_filter: Column | None = None,
) -> DataFrame:
    """Read a behaviour log.

    ``path`` may be a folder of a date-partitioned layout or a list of paths.
    The time range and ``partition_filter`` are plain predicates: Catalyst
    pushes them to the file scan (row-group statistics, partition pruning),
    which replaces the reference's "read every hourly folder" wildcard.  With
    ``schema``, columns that the files lack or hold in another type are an
    error (partition columns included), not silent nulls.
    """
    reader = spark.read.format(fmt)
    paths = [path] if isinstance(path, str) else list(path)
    if schema is not None:
        if fmt in ("parquet", "orc", "avro"):  # formats that name their columns
            _check_schema(reader.load(paths).schema, schema)
        reader = reader.schema(schema)
    df = reader.load(paths)
    if partition_filter is not None:
        df = df.filter(partition_filter)
    if time_col is not None and since is not None:
        df = df.filter(F.col(time_col) >= _ntz(since))
    if time_col is not None and until is not None:
        df = df.filter(F.col(time_col) < _ntz(until))
    if columns is not None:
        df = df.select(*columns)
    return df


def _check_schema(found: T.StructType, wanted: T.StructType) -> None:
    types = {f.name: f.dataType for f in found}
    wrong = [
        f"{f.name}: {types[f.name].simpleString()}, not {f.dataType.simpleString()}" if f.name in types else f"{f.name} is missing"
        for f in wanted
        if types.get(f.name) != f.dataType
    ]
    if wrong:
        raise ValueError("the log does not have the expected columns: " + "; ".join(wrong))


def _ntz(t: datetime | str) -> Column:
    text = t.strftime("%Y-%m-%d %H:%M:%S") if isinstance(t, datetime) else str(t)
    return F.lit(text).cast("timestamp_ntz")


def latest_snapshot(df: DataFrame, *, snapshot_col: str, as_of: datetime | str | None = None) -> DataFrame:
    """Rows of the newest snapshot (at or before ``as_of``).

    Full daily / hourly dumps are stored side by side; this keeps the last
    one.  The maximum is a scalar subquery, known before the second scan
    starts, so it prunes there like a literal.
    """
    scoped = df
    if as_of is not None:
        bound = _ntz(as_of) if _is_time(df, snapshot_col) else F.lit(str(as_of))
        scoped = df.filter(F.col(snapshot_col) <= bound)
    newest = scoped.agg(F.max(snapshot_col).alias("_newest"))
    return scoped.filter(F.col(snapshot_col) == newest.scalar())


def _is_time(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (T.TimestampNTZType, T.TimestampType))


def read_results(spark: SparkSession, path: str, names: Sequence[str], *, sep: str = "#", types: dict[str, str] | None = None) -> DataFrame:
    """Read back a header-less delimited product written by ``sinks.write_delimited``.

    Columns are positional, as in the written files; ``names`` labels them.
    ``types`` may name arrays (``array<string>``): their elements come back
    apart, whatever characters they hold.
    """
    types = types or {}
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    keep = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    df = spark.read.schema(schema).options(**keep).option("sep", sep).option("header", "false").csv(path)

    def value(n: str) -> Column:
        kind = types.get(n, "string")
        if not kind.startswith("array"):
            return unescaped(F.col(n), sep).cast(kind).alias(n)
        parts = F.when(F.col(n) == NO_ELEMENTS, F.array().cast("array<string>")).otherwise(F.split(n, ","))
        return F.transform(parts, lambda x: unescaped(x, sep, element=True)).cast(kind).alias(n)

    return df.select(*[value(n) for n in names])
