"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Everything here is decided at run time from measured sizes: how many reduce tasks to keep,
# which joins to broadcast, and which partitions are so large that they must be split.
RUNTIME_PLANNING = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
}


def build_session(app_name: str = "wardline", **settings: str) -> SparkSession:
    """A session with run-time planning on; ``settings`` use ``__`` for dots in names."""
    builder = SparkSession.builder.appName(app_name)
    for name, value in RUNTIME_PLANNING.items():
        builder = builder.config(name, value)
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name under the shared folder the cluster names in ``spark.checkpoint.dir``.

    A folder of this machine serves only a local session: other executors could not see it.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        shared = tempfile.mkdtemp(prefix="wardline-")
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
