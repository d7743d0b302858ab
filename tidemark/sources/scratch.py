"""The shared folder for tables that cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in spark.checkpoint.dir. Where that is unset: in a temporary folder on one machine, else an error."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        known = spark.sparkContext._jsc.sc().getCheckpointDir()
        if not known.isDefined() and not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = known.get() if known.isDefined() else tempfile.mkdtemp(prefix="tidemark-")
        if not known.isDefined():
            spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/tidemark/{name}-{uuid.uuid4().hex}"
