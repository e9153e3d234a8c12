"""Where jobs may put intermediate tables."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import SparkSession


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path in the folder named by ``spark.checkpoint.dir``, else in the checkpoint folder set on the context.

    A machine-local temporary folder is only used where that is unset and Spark runs in local mode.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="assayer-")
    return f"{shared.rstrip('/')}/{purpose}-{uuid4().hex}"
