"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

# Settings the library is tuned for; anything set on the cluster wins over them.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # lets partitioned writes keep a few writers open instead of sorting each task
    "spark.sql.maxConcurrentOutputFileWriters": "64",
    # plans here are built from many small expressions; recording a call site for each costs more
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def builder(app_name: str = "headrace") -> SparkSession.Builder:
    """A session builder with the library's settings applied."""
    configured = SparkSession.builder.appName(app_name)
    for key, value in DEFAULTS.items():
        configured = configured.config(key, value)
    return configured


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="headrace-")


def scratch(spark: SparkSession, purpose: str) -> str:
    """A fresh folder every executor can see, for intermediate tables and stream checkpoints.

    It lies under ``spark.checkpoint.dir``, in one folder per application, so that all of an
    application's scratch can be dropped together once it has ended. Only a local session may run
    without that setting; on a cluster a machine-local folder would lose rows with its machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = _local_root()
    app = spark.conf.get("spark.app.id", "app")
    return f"{root.rstrip('/')}/headrace/{app}/{purpose}-{uuid.uuid4().hex}"
