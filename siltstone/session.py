"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every entry point relies on. Timestamps are compared and hashed as
# UTC text; bad casts raise unless the code says try_*; AQE splits skewed
# partitions of joins and merges small ones.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = 8, name: str = "siltstone", **conf: str) -> SparkSession:
    """A session for tests and the benchmark; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="siltstone-wh-"))
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = configure(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


# Scratch folders of local sessions that name none, by application id.
_LOCAL_ROOTS: dict[str, str] = {}


def shared_dir(spark: SparkSession, label: str) -> str:
    """A new folder name below the cluster's `spark.checkpoint.dir`.

    Every executor must see the folder, so a machine-local one is used only
    where the whole Spark application is one local process.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        # `local-cluster` runs executors of their own and counts as a cluster.
        if context.master != "local" and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        if context.applicationId not in _LOCAL_ROOTS:
            _LOCAL_ROOTS[context.applicationId] = tempfile.mkdtemp(prefix="siltstone-")
        root = _LOCAL_ROOTS[context.applicationId]
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
