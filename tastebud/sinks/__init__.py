"""Product writers.  Every write overwrites its target.

Layout of one run's products: ``<root>/<model>/<sub_type>/<yyyy-MM-dd-00>/<product>``
(``write_product``), or one partitioned table per product with the run keys
as partition columns (``write_partitioned``, dynamic partition overwrite).
"""

from __future__ import annotations

import os
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A handful of rows each: one file, no run stamp.
SMALL_PRODUCTS = ("Recommendation-metrics", "cvResult")
# Products whose columns are fixed without the stamp.
UNSTAMPED = (*SMALL_PRODUCTS, "User-history-logs")


def run_folder(root: str, model: str, sub_type: str | None, op_time: str) -> str:
    """``yyyyMMdd00`` run stamp -> ``<root>/<model>/<sub_type>/yyyy-MM-dd-00``."""
    day = f"{op_time[0:4]}-{op_time[4:6]}-{op_time[6:8]}-00"
    parts = [root, model] + ([sub_type] if sub_type else []) + [day]
    return os.path.join(*parts)


#: What stands for the characters that would part or quote fields, the escape's own first: fixed values of the text format.
ESCAPES = (("%", "%25"), ("\\", "%5C"), ('"', "%22"), ("\n", "%0A"), ("\r", "%0D"))
_EMPTY, _NULL, NO_ELEMENTS = "%00", "%FF", "%E0"


def escaped(c: Column, sep: str, *, element: bool = False) -> Column:
    """Text without the separator, quotes, backslashes and line ends, and never empty; in elements of an array also without ','."""
    for plain, code in (*ESCAPES, (sep, f"%{ord(sep):02X}")) + (((",", "%2C"),) if element else ()):
        c = F.replace(c, F.lit(plain), F.lit(code))
    c = F.when(c == "", F.lit(_EMPTY)).otherwise(c)
    return F.coalesce(c, F.lit(_NULL)) if element else c


def unescaped(c: Column, sep: str, *, element: bool = False) -> Column:
    """The text again."""
    out = c
    for plain, code in reversed((*ESCAPES, (sep, f"%{ord(sep):02X}"), (",", "%2C"))):
        out = F.replace(out, F.lit(code), F.lit(plain))
    out = F.when(c == _EMPTY, F.lit("")).otherwise(out)
    return F.when(c != _NULL, out) if element else out


def _flat(df: DataFrame, sep: str) -> DataFrame:
    """Text formats hold no arrays: their elements are joined with ','; what would part fields or elements is escaped."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.ArrayType):
            joined = F.array_join(F.transform(c, lambda x: escaped(x.cast("string"), sep, element=True)), ",")
            c = F.when(F.size(c) == 0, F.lit(NO_ELEMENTS)).otherwise(joined)
        elif isinstance(f.dataType, T.StringType):
            c = escaped(c, sep)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def write_delimited(df: DataFrame, path: str, *, sep: str = "#") -> None:
    """Header-less delimited text (the reference's default product format).

    Every value is read back as it was (``sources.read_results``), blanks at
    either end included; a null is an empty field.
    """
    keep = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    _flat(df, sep).write.mode("overwrite").options(**keep).option("sep", sep).option("header", "false").csv(path)


def write_text(df: DataFrame, path: str) -> None:
    """One string column per line."""
    df.write.mode("overwrite").text(path)


def write_libsvm(df: DataFrame, path: str) -> None:
    """``label double, features vector`` rows in libsvm format."""
    df.write.mode("overwrite").format("libsvm").save(path)


def write_avro(df: DataFrame, path: str) -> None:
    """Avro; an error when the external data source is not deployed."""
    df.write.mode("overwrite").format("avro").save(path)


def write_product(
    df: DataFrame,
    root: str,
    *,
    model: str,
    sub_type: str | None,
    product: str,
    op_time: str,
    fmt: str = "csv",
    sep: str = "#",
    stamp: bool = True,
) -> str:
    """Write one product under the run layout.

    With ``stamp`` every product but those in ``UNSTAMPED`` gets the run stamp as a last
    ``op_time`` column (a literal, no extra pass over the data).
    """
    path = os.path.join(run_folder(root, model, sub_type, op_time), product)
    if stamp and product not in UNSTAMPED and "op_time" not in df.columns:
        df = df.withColumn("op_time", F.lit(op_time))
    if product in SMALL_PRODUCTS:
        # A handful of metric rows: one file.
        df = df.coalesce(1)
    if fmt == "csv":
        write_delimited(df, path, sep=sep)
    elif fmt == "parquet":
        df.write.mode("overwrite").parquet(path)
    elif fmt == "avro":
        write_avro(df, path)
    else:
        raise ValueError(f"unknown product format {fmt!r}")
    return path


def write_products(
    products: Mapping[str, DataFrame],
    root: str,
    *,
    model: str,
    sub_type: str | None,
    op_time: str,
    fmt: str = "csv",
    stamp: bool = True,
) -> dict[str, str]:
    return {
        name: write_product(df, root, model=model, sub_type=sub_type, product=name, op_time=op_time, fmt=fmt, stamp=stamp)
        for name, df in products.items()
    }


def write_partitioned(df: DataFrame, path: str, *, model: str, sub_type: str, op_time: str) -> None:
    """Append one run to a product table partitioned by (model, sub_type, op_time).

    Dynamic partition overwrite replaces only this run's partition, so
    reruns are idempotent and other runs stay untouched.
    """
    tagged = df.withColumns({"model": F.lit(model), "sub_type": F.lit(sub_type), "op_time": F.lit(op_time)})
    (
        tagged.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("model", "sub_type", "op_time")
        .parquet(path)
    )
