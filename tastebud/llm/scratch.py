"""Tables written once and read several times, in the session's shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tastebud.session import cut_lineage


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below ``spark.checkpoint.dir`` and read it back.

    Every executor reads the files from the shared folder, so a lost executor
    costs a task and not the lineage above the table.
    ``tastebud.session.drop_scratch`` removes them.
    """
    return cut_lineage(df, f"llm-{name}")
