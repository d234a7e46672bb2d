"""Publishing a run's products as a whole: written aside, then committed by a manifest.

``<root>/<model>/<sub_type>/_runs/<run id>/<product>`` holds the products of
one run and is never overwritten; ``_manifests/<stamp>-<time>.json`` names a run
that is whole.  Readers go by the newest manifest, so a run that fails on its
way leaves files that nobody reads, and the former run in place.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from ..storage import files, read_small, write_small


def _home(root: str, model: str, sub_type: str | None) -> str:
    return os.path.join(root, model, *([sub_type] if sub_type else []))


def publish_run(products: Mapping[str, DataFrame], root: str, *, model: str, sub_type: str | None, op_time: str) -> str:
    """Write all products and commit them; returns the manifest's path."""
    spark = next(iter(products.values())).sparkSession
    home, run = _home(root, model, sub_type), uuid.uuid4().hex
    paths = {}
    for name, df in products.items():
        paths[name] = os.path.join("_runs", run, name)
        df.write.parquet(os.path.join(home, paths[name]))
    manifest = os.path.join(home, "_manifests", f"{op_time}-{time.time_ns():020d}.json")
    write_small(spark, manifest, json.dumps({"op_time": op_time, "products": paths}, sort_keys=True))
    return manifest


def committed_runs(spark: SparkSession, root: str, *, model: str, sub_type: str | None) -> list[str]:
    """Names of the manifests, the newest last: by run stamp, then by time of commit."""
    return sorted(n for n in files(spark, os.path.join(_home(root, model, sub_type), "_manifests")) if n.endswith(".json") and not n.startswith("."))


def read_published(spark: SparkSession, root: str, product: str, *, model: str, sub_type: str | None, op_time: str | None = None) -> DataFrame:
    """A product of the last committed run (of that stamp, if given)."""
    home = _home(root, model, sub_type)
    names = [n for n in committed_runs(spark, root, model=model, sub_type=sub_type) if op_time is None or n.startswith(f"{op_time}-")]
    if not names:
        raise FileNotFoundError(f"no committed run below {home}")
    held = json.loads(read_small(spark, os.path.join(home, "_manifests", names[-1])))["products"]
    if product not in held:
        raise KeyError(f"the run has no product {product!r}")
    return spark.read.parquet(os.path.join(home, held[product]))
