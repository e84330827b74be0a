"""Where intermediate tables go."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import SparkSession


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new address in the shared folder named by ``spark.checkpoint.dir``.

    Every executor can reach that folder and it outlives each of them. A
    temporary folder of this machine stands in only where Spark itself runs
    inside this machine and no shared folder is configured.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.gettempdir()
    return f"{shared.rstrip('/')}/shaftline-{name}-{uuid4().hex}"
