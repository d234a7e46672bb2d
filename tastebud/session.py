"""Session construction and lineage helpers.

Library code never creates its own session: every operator takes DataFrames
and lets the caller's session decide.  ``local_session`` exists for tests and
the benchmark only.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SCRATCH: list[str] = []

_LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.driver.memory": "16g",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tastebud") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in _LOCAL_CONF.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting names a shared filesystem folder and is used as
    is.  Only a local master (unit tests) may go without: it gets a scratch
    folder of its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="tastebud-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A folder below the shared checkpoint location (for written tables)."""
    return os.path.join(ensure_checkpoint_dir(spark), *parts)


def cut_lineage(df: DataFrame, name: str = "table", by: tuple[str, ...] = ()) -> DataFrame:
    """Write as Parquet into the shared checkpoint folder and read back.

    Survives executor loss, and later reads take only the columns and rows
    they need; of a table with a folder per value of ``by``, only the folders.
    """
    spark = df.sparkSession
    path = shared_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.partitionBy(*by).parquet(path)
    _SCRATCH.append(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_scratch(spark: SparkSession) -> int:
    """Remove the tables written by ``cut_lineage``; frames that read them are no longer usable."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    n = len(_SCRATCH)
    while _SCRATCH:
        path = jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        path.getFileSystem(conf).delete(path, True)
    return n
