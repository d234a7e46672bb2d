"""Folders and small files through Hadoop's file systems, so that any store Spark reads will do."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path``; none where it does not exist."""
    fs, p = _open(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()] if fs.exists(p) else []


def files(spark: SparkSession, path: str) -> list[str]:
    """Names of the files in ``path``; none where it does not exist."""
    fs, p = _open(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isFile()] if fs.exists(p) else []


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _open(spark, path)
    return fs.exists(p)


def write_small(spark: SparkSession, path: str, text: str) -> None:
    """A small file that appears whole or not at all: written beside, then renamed."""
    fs, p = _open(spark, path)
    beside = spark._jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}.part")
    out = fs.create(beside, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    if not fs.rename(beside, p):
        fs.delete(beside, False)
        raise FileExistsError(path)


def read_small(spark: SparkSession, path: str) -> str:
    fs, p = _open(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()
