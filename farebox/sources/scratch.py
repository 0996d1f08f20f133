"""Where intermediate tables are written."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder named by ``spark.checkpoint.dir``.

    Only a local session may fall back to this machine's temporary folder;
    executors of a cluster could not see it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.gettempdir()
    return f"{base.rstrip('/')}/farebox/{label}-{uuid.uuid4().hex}"
